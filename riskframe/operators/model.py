"""Split, assemble, scale, train, predict, coefficient table.

Training uses MLlib's ``Pipeline``: VectorAssembler -> StandardScaler
(mean and sample std from the training rows only) -> LogisticRegression.
Each optimizer iteration is one distributed aggregation (treeAggregate);
the training rows are persisted for the fit and released.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import BUCKETS, col, hash_bucket
from .evaluate import positive_probability


def hash_split(df: DataFrame, key_cols: Sequence[str] | None = None,
               train_fraction: float = 0.8, out: str = "is_train") -> DataFrame:
    """M4: deterministic train/test flag from an md5 bucket of the row key.

    Unlike ``randomSplit(seed)``, the result does not depend on how the
    input is partitioned, and it is reproducible in SQL.
    """
    keys = list(key_cols) if key_cols else df.columns
    cut = int(round(train_fraction * BUCKETS))
    return df.withColumn(out, hash_bucket(keys) < F.lit(cut).cast("bigint"))


def split_sizes(flagged: DataFrame, flag: str = "is_train") -> DataFrame:
    """Train / test / total counts and percentages from one grouped count."""
    g = flagged.agg(F.count(F.when(col(flag), F.lit(1))).alias("train_rows"),
                    F.count(F.when(~col(flag), F.lit(1))).alias("test_rows"),
                    F.count(F.lit(1)).alias("total_rows"))
    return g.select(
        *[F.col(c).cast("bigint").alias(c) for c in ("train_rows", "test_rows", "total_rows")],
        F.try_divide(F.col("train_rows") * 100.0, F.col("total_rows")).alias("train_pct"),
        F.try_divide(F.col("test_rows") * 100.0, F.col("total_rows")).alias("test_pct"))


def build_pipeline(features: Sequence[str], label: str = "label", max_iter: int = 50,
                   reg_param: float = 0.01, elastic_net: float = 0.0,
                   threshold: float = 0.5, indexed: Sequence[str] = ()) -> Pipeline:
    """M1 + M2 + M3 + M5 as one estimator: category indexer (for ``indexed``
    columns, producing ``<col>_idx``), assembler, scaler, logistic regression.
    Every statistic (category order, mean, std) is fitted on the rows passed
    to ``fit`` only - the training split."""
    stages = []
    if indexed:
        stages.append(StringIndexer(inputCols=list(indexed), outputCols=[c + "_idx" for c in indexed],
                                    handleInvalid="keep", stringOrderType="frequencyDesc"))
    return Pipeline(stages=stages + [
        VectorAssembler(inputCols=list(features), outputCol="raw_features", handleInvalid="error"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter,
                           regParam=reg_param, elasticNetParam=elastic_net, threshold=threshold),
    ])


def train_model(df: DataFrame, features: Sequence[str], label: str = "label",
                key_cols: Sequence[str] | None = None, train_fraction: float = 0.8,
                **lr) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """M4 + M5: split, fit the pipeline on the training rows, return (model, train, test)."""
    flagged = hash_split(df, key_cols, train_fraction)
    train = flagged.where(F.col("is_train")).drop("is_train").withColumn(label, col(label).cast("double"))
    test = flagged.where(~F.col("is_train")).drop("is_train").withColumn(label, col(label).cast("double"))
    # features named <col>_idx for an existing <col> are indexed inside the pipeline
    require_features(df, features)
    indexed = [f[:-4] for f in features if f not in df.columns]
    # fitting goes over the rows once an iteration: only the columns it needs, spread
    # evenly over the cluster whatever the input's partitions are
    par = df.sparkSession.sparkContext.defaultParallelism
    rows = train.select(*[col(c) for c in dict.fromkeys([f for f in features if f in df.columns] + indexed)],
                        col(label).alias(label)).repartition(par).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = build_pipeline(features, label, indexed=indexed, **lr).fit(rows)
    finally:
        rows.unpersist()
    return model, train, test


def require_features(df: DataFrame, features: Sequence[str]) -> None:
    """Every feature is a column, or the index (``<col>_idx``) of one; nothing is left out."""
    missing = [f for f in features if f not in df.columns
               and not (f.endswith("_idx") and f[:-4] in df.columns)]
    if missing:
        raise ValueError(f"features not in the table: {missing}; it has {df.columns}")


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M6: probability vector, raw score, class (MLlib: class 1 when p > threshold)
    plus ``p1`` = P(class 1) as a plain double."""
    return positive_probability(model.transform(df))


def coefficient_table(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """M7: (position, feature, coefficient, mean, std) plus the intercept as a
    final row with position -1. Bounded by the number of features."""
    scaler, lr = model.stages[-2], model.stages[-1]
    coefs = lr.coefficients.toArray().tolist()
    means = scaler.mean.toArray().tolist()
    stds = scaler.std.toArray().tolist()
    rows = [(i, f, float(coefs[i]), float(means[i]), float(stds[i])) for i, f in enumerate(features)]
    rows.append((-1, "(intercept)", float(lr.intercept), 0.0, 1.0))
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(
        rows, "position int, feature string, coefficient double, mean double, std double")


def feature_importance(coefs: DataFrame) -> DataFrame:
    """O2: features ranked by absolute weight (rank 1 = largest), sign kept."""
    from pyspark.sql import Window
    c = coefs.where(F.col("position") >= 0)
    # the coefficient table has one row per feature: a bounded global window
    w = Window.orderBy(F.abs("coefficient").desc(), F.col("feature"))
    return c.select(F.row_number().over(w).alias("rank"), "feature", "coefficient",
                    F.abs("coefficient").alias("abs_coefficient"))
