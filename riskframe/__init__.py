"""riskframe: a Spark-native engine for tabular risk prediction.

Load and clean event tables, derive time / category / customer features,
describe them (statistics, distributions, histograms, box plots), train and
apply a logistic-regression model, and evaluate it (confusion counts, rates,
exact AUC, ROC, calibration) - every step a DataFrame or MLlib operation.
"""

__version__ = "0.1.0"
