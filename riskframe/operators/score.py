"""Batch scoring from saved weights (M8-M10): a pure column projection.

z = sum_j w_j * (x_j - mean_j) / std_j + b (std 0 treated as 1),
p = 1 / (1 + e^-z), class 1 when p >= threshold, plus a caption.
The coefficient table is bounded by the number of features, so it is
read once and compiled into one codegen-friendly expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import col, sigmoid
from ..spec import CLASS_CAPTIONS


def score_expr(coefs: Sequence[tuple[str, float, float, float]], intercept: float):
    z = F.lit(float(intercept))
    for feature, w, mean, std in coefs:
        s = std if std else 1.0
        z = z + F.lit(float(w)) * ((col(feature).cast("double") - F.lit(float(mean))) / F.lit(float(s)))
    return z


def score_batch(df: DataFrame, coefficients: DataFrame | Sequence, intercept: float | None = None,
                threshold: float = 0.5, captions: Sequence[str] = CLASS_CAPTIONS) -> DataFrame:
    """Add ``z``, ``probability`` (double), ``prediction`` (int) and ``caption``.

    ``coefficients`` is a coefficient table (position, feature, coefficient,
    mean, std; intercept at position -1) or a list of (feature, w, mean, std).
    """
    if isinstance(coefficients, DataFrame):
        rows = coefficients.orderBy("position").collect()
        coefs = [(r["feature"], r["coefficient"], r["mean"], r["std"]) for r in rows if r["position"] >= 0]
        if intercept is None:
            intercept = next((r["coefficient"] for r in rows if r["position"] < 0), 0.0)
    else:
        coefs = list(coefficients)
    z = score_expr(coefs, intercept or 0.0)
    p = sigmoid(F.col("z"))
    return (df.withColumn("z", z).withColumn("probability", p)
              .withColumn("prediction", F.when(F.col("probability") >= F.lit(threshold), 1).otherwise(0))
              .withColumn("caption", F.when(F.col("prediction") == 1, F.lit(captions[1]))
                          .otherwise(F.lit(captions[0]))))
