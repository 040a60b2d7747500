"""Category indexing, category lookup, z-scores, numeric parsing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql import Window

from ..functions import col
from ..session import scratch_dir, shuffle_partitions


def fit_string_index(df: DataFrame, columns: Sequence[str], suffix: str = "_idx",
                     handle_invalid: str = "keep") -> StringIndexerModel | None:
    """M1 fit: most frequent value -> 0.0, ties alphabetical; absent columns skipped.

    Fitting is one distributed count per value; only the distinct labels (a
    category list, bounded by the column's cardinality) reach the driver.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return None
    return StringIndexer(inputCols=present, outputCols=[c + suffix for c in present],
                         handleInvalid=handle_invalid,
                         stringOrderType="frequencyDesc").fit(df)


def string_index(df: DataFrame, columns: Sequence[str], suffix: str = "_idx",
                 handle_invalid: str = "keep") -> tuple[DataFrame, list[str]]:
    """M1: add ``<col>_idx`` doubles; null / unseen values get the extra last index."""
    model = fit_string_index(df, columns, suffix, handle_invalid)
    if model is None:
        return df, []
    return model.transform(df), list(model.getOutputCols())


def index_table(spark, model: StringIndexerModel) -> DataFrame:
    """The fitted category map as a table (column, value, idx): the saved form of M1."""
    rows = [(c, v, float(i)) for c, labels in zip(model.getInputCols(), model.labelsArray)
            for i, v in enumerate(labels)]
    return spark.createDataFrame(rows, "column string, value string, idx double")


def rank_values(df: DataFrame, column: str) -> DataFrame:
    """M1 fit for columns of any cardinality: ``(value, n, idx)``, the most frequent value
    first, ties in value order. No value comes to the driver.

    Values are counted, range-partitioned by (count descending, value) and numbered inside
    their range; ranges get the sum of the sizes before them (a row per range). The counted
    values are written to the shared folder once, so numbers do not change if a task is
    run again.
    """
    spark = df.sparkSession
    parts = shuffle_partitions(spark)
    counts = (df.where(col(column).isNotNull()).groupBy(col(column).cast("string").alias("value"))
              .agg(F.count(F.lit(1)).alias("n")))
    order = [F.desc("n"), F.asc("value")]
    path = scratch_dir(spark, "value-ranks")
    (counts.repartitionByRange(parts, *order).sortWithinPartitions(*order)
     .select("value", "n", F.spark_partition_id().alias("_part"),
             (F.monotonically_increasing_id() % F.lit(1 << 33)).alias("_at")).write.parquet(path))
    ranked = spark.read.parquet(path)
    # a row per range: a bounded window, and a broadcast of at most as many rows as partitions
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = (ranked.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
             .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_first")))
    return ranked.join(F.broadcast(first), "_part").select(
        "value", "n", (F.col("_first") + F.col("_at")).cast("double").alias("idx"))


def string_index_any(df: DataFrame, columns: Sequence[str], suffix: str = "_idx") -> DataFrame:
    """M1 for columns of any cardinality: as :func:`string_index` with ``keep`` (null gets the
    extra last index), by joins with :func:`rank_values`. A value that many rows hold is one
    row of the ranks, so its rows split over tasks."""
    out = df
    for c in columns:
        if c not in df.columns:
            continue
        ranks = rank_values(df, c).select(F.col("value").alias("_value"), F.col("idx").alias("_idx"))
        extra = float(ranks.count())
        out = (out.join(ranks, col(c).cast("string") == F.col("_value"), "left")
               .withColumn(c + suffix, F.coalesce("_idx", F.lit(extra))).drop("_value", "_idx"))
    return out


def category_lookup(df: DataFrame, column: str, mapping: Mapping[str, float] | DataFrame,
                    out: str | None = None, default: float = 0.0) -> DataFrame:
    """Replace a category by its index from a mapping; unknown -> ``default``.

    A mapping DataFrame must have (value, idx); with a ``column`` column, as
    :func:`index_table` gives, only the rows of ``column`` count. A value listed twice
    raises. The planner picks the join by the table's size in bytes.
    """
    out = out or column + "_idx"
    spark = df.sparkSession
    if isinstance(mapping, Mapping):
        mdf = spark.createDataFrame([(str(k), float(v)) for k, v in mapping.items()],
                                    "value string, idx double")
        small = True
    else:
        if "column" in mapping.columns:
            mapping = mapping.where(F.col("column") == column)
        mdf = mapping.select(F.col("value").cast("string").alias("value"),
                             F.col("idx").cast("double").alias("idx"))
        twice = mdf.groupBy("value").count().where("count > 1").first()
        if twice:
            raise ValueError(f"the mapping lists {twice['value']!r} {twice['count']} times")
        small = False
    mdf = mdf.withColumnRenamed("value", "_lk_value").withColumnRenamed("idx", "_lk_idx")
    right = F.broadcast(mdf) if small else mdf
    j = df.join(right, col(column).cast("string") == F.col("_lk_value"), "left")
    return j.withColumn(out, F.coalesce(F.col("_lk_idx"), F.lit(float(default)))).drop(
        "_lk_value", "_lk_idx")


# ------------------------------------------------------------- z-score ---

def zscore_fit(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """M3 fit: mean and sample std per column from the training rows (one aggregate)."""
    aggs = []
    for i, c in enumerate(columns):
        x = col(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}")]
    r = train.agg(*aggs).first()
    return {c: (r[f"m{i}"], r[f"s{i}"]) for i, c in enumerate(columns)}


def zscore_apply(df: DataFrame, stats: Mapping[str, tuple[float, float]], suffix: str = "_z",
                 zero_std: str = "zero") -> DataFrame:
    """M3 apply: (x - mean) / std with training statistics.

    ``zero_std='zero'`` gives 0.0 for a constant feature (as MLlib's
    StandardScaler); ``'one'`` divides by 1 instead (as the saved-weight scorer).
    """
    cols = []
    for c, (m, s) in stats.items():
        x = col(c).cast("double") - F.lit(m)
        if not s:
            z = F.lit(0.0) if zero_std == "zero" else x
        else:
            z = x / F.lit(s)
        cols.append(z.alias(c + suffix))
    return df.select("*", *cols)


# --------------------------------------------------------------- parse ---

def parse_numeric(df: DataFrame, columns: Sequence[str], suffix: str = "_num",
                  reject: str = "rejected") -> DataFrame:
    """Text -> double with ``try_cast``; ``rejected`` marks rows where a
    non-null input failed to parse (instead of failing the job)."""
    out = df
    bad = F.lit(False)
    for c in columns:
        parsed = F.expr(f"try_cast(trim(`{c}`) as double)")
        out = out.withColumn(c + suffix, parsed)
        bad = bad | (col(c).isNotNull() & F.col(c + suffix).isNull())
    return out.withColumn(reject, bad)
