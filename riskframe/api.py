"""Step-by-step API with the original pipeline's step names.

Each function keeps the original call shape (DataFrame in, DataFrame or
small dict out) but runs the distributed operators of this package. Outputs
that were printed or drawn are returned as DataFrames instead. Report files
are written with Spark (one CSV file per report).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession

from .operators import clean, encode, evaluate, features, model, stats
from .sources import files, reports
from .sources.models import save_model
from .spec import (ACCIDENT_CATEGORIES, ACCIDENT_COLUMNS, ACCIDENT_DESCRIBE_COLUMNS, ACCIDENT_FEATURES,
                   FORM_CATEGORY_MAP, STATS_EXCLUDED, accident_schema)


# ------------------------------------------------------------ preprocessing ---

def load_data(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """CSV with header; explicit schema by default (no inference pass)."""
    return files.read_csv(spark, path, schema if schema is not None else accident_schema())


def clean_data(df: DataFrame, keep: Sequence[str] = ACCIDENT_COLUMNS) -> DataFrame:
    """Keep the wanted columns that exist, drop rows with nulls, dedupe."""
    return clean.clean_data(df, keep)


def feature_engineering(df: DataFrame, ts: str = "Start_Time") -> DataFrame:
    """Hour, Weekday (1 = Sunday), Month; no-op without the time column."""
    return features.time_features(df, ts)


def encode_categorical_cols(df: DataFrame, cat_cols: Sequence[str] = ACCIDENT_CATEGORIES
                            ) -> tuple[DataFrame, list[str]]:
    """M1: ``<col>_idx`` by frequency; absent columns skipped; errors raise."""
    return encode.string_index(df, cat_cols)


def lookup_form_categories(df: DataFrame, maps: dict | None = None) -> DataFrame:
    """``<col>_idx`` from the form scorer's fixed category map (unknown -> 0.0).
    Prefer the map fitted by ``encode_categorical_cols`` (``encode.index_table``),
    which follows the data's frequency order."""
    for c, m in (maps or FORM_CATEGORY_MAP).items():
        if c in df.columns:
            df = encode.category_lookup(df, c, m)
    return df


def save_output(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """S3: overwrite a folder of part files."""
    return files.write_table(df, path, fmt=fmt)


def preprocess(spark: SparkSession, path: str, output_path: str | None = None,
               fmt: str = "csv") -> tuple[DataFrame, list[str]]:
    """Load -> clean -> time features -> category index (-> save).

    The index is fitted on all rows, as in the original preprocessing. For a
    leakage-free model, list ``<col>_idx`` features in ``train_model``: the
    indexer is then fitted inside the pipeline on the training split only.
    """
    df = feature_engineering(clean_data(load_data(spark, path)))
    df, cols = encode_categorical_cols(df)
    if output_path:
        save_output(df, output_path, fmt)
    return df, cols


# ---------------------------------------------------------------- describe ---

def add_label(df: DataFrame, target: str = "Severity", threshold: int = 3) -> DataFrame:
    """Trim names, require the target, integer cast, label = target >= 3."""
    return features.binary_label(df, target, threshold)


def descriptive_statistics(df: DataFrame, as_strings: bool = False) -> tuple[DataFrame, DataFrame]:
    """A2-A4: describe of the preferred columns (typed, or Spark's string layout),
    and the target distribution."""
    describe = stats.describe_strings if as_strings else stats.describe_core
    return (describe(df, preferred=ACCIDENT_DESCRIBE_COLUMNS), stats.severity_distribution(df))


def save_descriptive_to_file(df: DataFrame, result_dir: str) -> dict[str, str]:
    """A5-A7 + A3: per-feature statistics and the target distribution as reports."""
    desc = stats.column_stats(df, exclude=STATS_EXCLUDED)
    dist = stats.severity_distribution(df)
    base = result_dir.rstrip("/")
    return {"descriptive_statistics": reports.write_report(desc, f"{base}/descriptive_statistics"),
            "severity_distribution": reports.write_report(dist, f"{base}/severity_distribution")}


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Data of the label bar chart."""
    return stats.distribution(df, label)


def feature_histogram(df: DataFrame, feature: str, bins: int = 30) -> DataFrame:
    """Data of a 30-bin histogram."""
    return stats.histogram(df, feature, bins)


def boxplot(df: DataFrame, feature: str, label: str = "label") -> DataFrame:
    """A10: data of the per-class box plot."""
    return stats.boxplot_stats(df, feature, label)


# ------------------------------------------------------------------- model ---

def prepare_features(train_df: DataFrame, test_df: DataFrame, feature_cols: Sequence[str]):
    """M2 + M3: both tables through the preparing stages of the training pipeline, which are
    fitted on the training table; the fitted scaler comes with them."""
    stages = model.build_pipeline(feature_cols).getStages()[:-1]
    prepared = Pipeline(stages=stages).fit(train_df)
    return prepared.transform(train_df), prepared.transform(test_df), prepared.stages[-1]


def train_model(df: DataFrame, feature_cols: Sequence[str] = ACCIDENT_FEATURES,
                label: str = "label", key_cols: Sequence[str] | None = None):
    """M4-M6: 80/20 hash split, pipeline fit on train, test predictions.
    Returns (pipeline_model, predictions, scaler_model)."""
    fitted, _, test = model.train_model(df, feature_cols, label, key_cols)
    return fitted, model.predict(fitted, test), fitted.stages[-2]


def save_model_files(fitted, feature_cols: Sequence[str], path: str) -> str:
    """MLlib pipeline + Parquet coefficient table."""
    return save_model(fitted, feature_cols, path)


def feature_importance(fitted, feature_cols: Sequence[str]) -> DataFrame:
    """O2 + M7: coefficients ranked by absolute weight."""
    return model.feature_importance(model.coefficient_table(fitted, feature_cols))


# -------------------------------------------------------------- evaluation ---

def evaluate_model(pred: DataFrame, label: str = "label") -> tuple[dict, DataFrame]:
    """The 16 metrics (a small dict) and the confusion counts."""
    summary = evaluate.evaluation_summary(pred, label, "prediction", "p1")
    metrics = {r["Metric"]: r["Value"] for r in evaluate.metrics_long(summary, digits=None).collect()}
    return metrics, evaluate.confusion_counts(pred, label)


def save_evaluation_to_file(metrics: dict, cm: DataFrame, result_dir: str) -> dict[str, str]:
    """Metrics (rounded to 6) and confusion counts as one-file CSV reports."""
    spark = cm.sparkSession
    rows = [(k, None if v is None else round(float(v), 6)) for k, v in metrics.items()]
    mdf = spark.createDataFrame(rows, "Metric string, Value double")
    base = result_dir.rstrip("/")
    return {"model_evaluation": reports.write_report(mdf, f"{base}/model_evaluation"),
            "confusion_matrix": reports.write_report(cm, f"{base}/confusion_matrix")}


def extract_roc_points(pred: DataFrame, label: str = "label", bins: int | None = None,
                       drop_intermediate: bool = True) -> DataFrame:
    """(threshold, fpr, tpr) as the usual ``roc_curve`` returns them by
    default: collinear points dropped, (inf, 0, 0) first."""
    return evaluate.roc_points(pred, label, "p1", bins, drop_intermediate=drop_intermediate,
                               with_origin=True)
