"""Descriptive statistics, distributions, histograms, box plots (A1-A10, O1, O3).

All column summaries are computed in one scan over an unpivoted (long) view
grouped by feature, using only mergeable aggregates (partial + final
around one small exchange). Exact quartiles use distributed range narrowing
(see ``quantiles``); approximate ones use a quantile sketch in the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import all_present, col, numeric_columns
from ..session import delete_path, scratch_dir
from .quantiles import exact_quantile_values, few_summary, grouped_quantiles, stack_long, summary_aggs

STAT_COLUMNS = ("Feature", "Count", "Mean", "Median", "Std", "Min", "Max", "Q1", "Q3",
                "Skewness", "Kurtosis")


# ---------------------------------------------------------------- counts ---

def stage_counts(df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """A1: raw rows, rows with no null in ``keep``, distinct such rows - in one plan.

    Rows are first grouped by all kept columns (map-side combine collapses
    duplicates before the shuffle), then a global aggregate sums the groups.
    """
    keep = [c for c in (keep or df.columns) if c in df.columns]
    g = df.groupBy(*[col(c) for c in keep]).agg(F.count(F.lit(1)).alias("_n"))
    ok = all_present(g, keep)
    return g.agg(
        F.sum("_n").cast("bigint").alias("raw_rows"),
        F.coalesce(F.sum(F.when(ok, F.col("_n"))), F.lit(0)).cast("bigint").alias("non_null_rows"),
        F.count(F.when(ok, F.lit(1))).cast("bigint").alias("clean_rows"),
    )


def distribution(df: DataFrame, key: str) -> DataFrame:
    """Row count per value of ``key``, ordered by the value."""
    return (df.groupBy(col(key).alias(key)).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(key))


def severity_distribution(df: DataFrame, target: str = "Severity",
                          fallback: str = "label") -> DataFrame:
    """A3 + A4: distribution of the target, or of the label when the target is absent."""
    key = target if target in df.columns else fallback
    if key not in df.columns:
        raise ValueError(f"neither {target!r} nor {fallback!r} present: {df.columns}")
    return distribution(df, key)


# ------------------------------------------------------------- describe ---

def describe_core(df: DataFrame, columns: Sequence[str] | None = None,
                  preferred: Sequence[str] = ()) -> DataFrame:
    """A2: count / mean / stddev (sample) / min / max, typed (double) not strings.

    Columns: ``preferred`` that exist, else the first five columns.
    Layout matches ``DataFrame.describe``: one row per statistic.
    """
    if columns is None:
        columns = [c for c in preferred if c in df.columns] or df.columns[:5]
    aggs = []
    for i, c in enumerate(columns):
        x = col(c).try_cast("double")            # text has counts, and numbers where it holds some
        aggs += [F.count(col(c)).cast("double").alias(f"count_{i}"), F.avg(x).alias(f"mean_{i}"),
                 F.stddev_samp(x).alias(f"stddev_{i}"), F.min(x).alias(f"min_{i}"),
                 F.max(x).alias(f"max_{i}")]
    one = df.agg(*aggs)
    stats = ["count", "mean", "stddev", "min", "max"]
    args = ", ".join(
        f"'{s}', " + ", ".join(f"{s}_{i}" for i in range(len(columns))) for s in stats)
    names = ", ".join(f"`{c}`" for c in columns)
    return one.select(F.expr(f"stack({len(stats)}, {args}) as (summary, {names})"))


def describe_strings(df: DataFrame, columns: Sequence[str] | None = None,
                     preferred: Sequence[str] = ()) -> DataFrame:
    """A2 in Spark's native ``describe`` layout (every statistic as a string),
    for output identical to the original preview; ``describe_core`` is typed."""
    if columns is None:
        columns = [c for c in preferred if c in df.columns] or df.columns[:5]
    return df.select(*[col(c) for c in columns]).describe()


# --------------------------------------------------------- column stats ---

def _wide_moments(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Count, Mean, Std, Min, Max, Skewness, Kurtosis per feature, quartiles null."""
    aggs = {"Count": F.count, "Mean": F.avg, "Std": F.stddev_samp, "Min": F.min, "Max": F.max,
            "Skewness": F.skewness, "Kurtosis": F.kurtosis}
    one = df.agg(*[f(col(c).cast("double")).alias(f"{n}_{i}")
                   for i, c in enumerate(features) for n, f in aggs.items()])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("Feature"), *[
        (F.col(f"{n}_{i}") if n in aggs else F.lit(None).cast("double")).alias(n) for n in STAT_COLUMNS[1:]])
        for i, c in enumerate(features)])).alias("r")
    return one.select(rows).select("r.*")


def column_stats(df: DataFrame, features: Sequence[str] | None = None,
                 exclude: Sequence[str] = ("ID", "Severity", "label"),
                 quantiles: str = "exact", relative_error: float = 0.01,
                 cache: bool = False) -> DataFrame:
    """A5-A7 (+P9): one row per numeric feature with Count, Mean, Median, Std
    (sample), Min, Max, Q1, Q3, Skewness (population), Kurtosis (population excess).

    ``quantiles='exact'``: interpolated order statistics (distributed
    selection, a few extra scans); ``'approx'``: sketch with the given
    relative rank error, computed in the same single scan; ``'none'``: no
    quartiles, one plain aggregate. ``cache`` computes the input once (in the
    shared folder, removed afterwards) when it is costly and read repeatedly.
    """
    features = list(features) if features is not None else numeric_columns(df, exclude)
    if cache:                     # several passes: compute the input once, in the shared folder
        path = scratch_dir(df.sparkSession, "column-stats")
        df.select(*[col(f) for f in features]).write.parquet(path)
        try:
            return spark_local(column_stats(df.sparkSession.read.parquet(path), features, (), quantiles,
                                            relative_error))
        finally:
            delete_path(df.sparkSession, path)
    if quantiles == "none":       # moments only: one aggregate without the unpivoted view
        return _wide_moments(df, features)
    long = stack_long(df, features, drop_nan=False)
    moments = [F.count("x").alias("Count"), F.avg("x").alias("Mean"),
               F.stddev_samp("x").alias("Std"), F.min("x").alias("Min"), F.max("x").alias("Max"),
               F.skewness("x").alias("Skewness"), F.kurtosis("x").alias("Kurtosis")]
    if quantiles == "approx":
        accuracy = max(1, int(round(1.0 / relative_error)))
        q = F.percentile_approx("x", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), accuracy)
        m = long.groupBy("feature").agg(*moments, q.alias("_q"))
        m = (m.withColumn("Q1", F.col("_q")[0]).withColumn("Median", F.col("_q")[1])
              .withColumn("Q3", F.col("_q")[2]))
        return m.select(F.col("feature").alias("Feature"), F.col("Count").cast("bigint").alias("Count"),
                        *[F.col(c).cast("double").alias(c) for c in STAT_COLUMNS[2:]])
    # one scan: moments + the quantile sketch brackets; then one bracket-resolving scan
    probs = (0.25, 0.5, 0.75)
    summary = long.groupBy("feature").agg(*moments, *summary_aggs("x", probs)).collect()
    qv = exact_quantile_values(df, features, probs, summary=summary)
    by_f = {r["feature"]: r for r in summary}
    rows = []
    for f in features:
        r = by_f.get(f)
        if r is None:
            rows.append((f, 0, None, None, None, None, None, None, None, None, None))
            continue
        q1, med, q3 = (qv.get(((), f, p)) for p in probs)
        rows.append((f, r["Count"], r["Mean"], med, r["Std"], r["Min"], r["Max"], q1, q3,
                     r["Skewness"], r["Kurtosis"]))
    schema = ("Feature string, Count bigint, Mean double, Median double, Std double, Min double, "
              "Max double, Q1 double, Q3 double, Skewness double, Kurtosis double")
    # one row per feature: a bounded result assembled from two small aggregates
    return df.sparkSession.createDataFrame(rows, schema)


def skew_flag(stats: DataFrame, limit: float = 1.0) -> DataFrame:
    """O3: flag features whose absolute skewness exceeds ``limit``."""
    return stats.withColumn("skewed", F.abs(F.col("Skewness")) > F.lit(limit))


# ----------------------------------------------------------- histograms ---

def _edges(lo: float, hi: float) -> tuple[float, float]:
    # equal bounds are widened by 0.5 each side, as numpy.histogram does
    return (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)


def bin_index(x, lo, hi, bins: int):
    """Bin index with numpy.histogram semantics: edges e_i = i*step + lo with
    step = (hi - lo) / bins (e_bins = hi); bin i holds e_i <= x < e_{i+1}, the
    last bin is closed. ``lo``/``hi`` may be columns (one generic expression)."""
    step = (hi - lo) / F.lit(float(bins))
    g = F.least(F.greatest(F.floor((x - lo) / (hi - lo) * F.lit(bins)), F.lit(0)),
                F.lit(bins - 1)).cast("int")

    def edge(i):
        return i.cast("double") * step + lo
    return (F.when(x < edge(g), g - 1)
             .when((g < bins - 1) & (x >= edge(g + 1)), g + 1)
             .otherwise(g))


def histograms(df: DataFrame, features: Sequence[str], bins: int = 30,
               by: str | None = None) -> DataFrame:
    """Equal-width histograms of several features in one scan.

    Ranges come from one min/max aggregate (a bounded result, inlined as
    literal maps feature -> lo / hi, so one compact codegen expression bins
    every feature). Output (by?, feature, bin, bin_lo, bin_hi, count)
    includes empty bins: a literal grid left-joined to the (bounded) counts.
    """
    long = stack_long(df, features, [by] if by else [])
    rng = {r["feature"]: _edges(r["lo"], r["hi"])
           for r in long.groupBy("feature").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).collect()}
    feats = [f for f in features if f in rng]
    if not feats:
        raise ValueError("no non-null values to bin")
    lo_map = F.create_map(*[e for f in feats for e in (F.lit(f), F.lit(float(rng[f][0])))])
    hi_map = F.create_map(*[e for f in feats for e in (F.lit(f), F.lit(float(rng[f][1])))])
    keys = ([F.col(by)] if by else []) + [F.col("feature")]
    binned = long.select(*keys, "x", lo_map[F.col("feature")].alias("_lo"),
                         hi_map[F.col("feature")].alias("_hi"))
    counts = (binned.groupBy(*keys, bin_index(F.col("x"), F.col("_lo"), F.col("_hi"), bins).alias("bin"))
                    .agg(F.count(F.lit(1)).alias("count")))

    grid_rows = []                       # features x bins
    for f in feats:
        lo, hi = rng[f]
        step = (hi - lo) / bins
        for i in range(bins):
            grid_rows.append((f, i, i * step + lo, hi if i == bins - 1 else (i + 1) * step + lo))
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(i).alias("bin"),
                               F.lit(float(a)).alias("bin_lo"), F.lit(float(b)).alias("bin_hi"))
                      for f, i, a, b in grid_rows])
    if not by:
        grid = df.sparkSession.createDataFrame(grid_rows, "feature string, bin int, bin_lo double, bin_hi double")
        out = grid.join(counts, ["feature", "bin"], "left")
        return out.select("feature", "bin", "bin_lo", "bin_hi",
                          F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"))
    # a null group is a group; per group the counts become a map, and every cell looks itself
    # up in it: any number of groups, one row each, no join
    key = F.struct("feature", "bin")
    held = counts.groupBy(F.col(by)).agg(F.map_from_entries(F.collect_list(F.struct(key, "count"))).alias("_m"))
    out = held.select(by, "_m", F.explode(cells).alias("_c"))
    return out.select(by, "_c.feature", "_c.bin", "_c.bin_lo", "_c.bin_hi", F.coalesce(
        F.col("_m")[F.struct(F.col("_c.feature").alias("feature"), F.col("_c.bin").alias("bin"))],
        F.lit(0)).cast("bigint").alias("count"))


def histogram(df: DataFrame, feature: str, bins: int = 30, by: str | None = None) -> DataFrame:
    return histograms(df, [feature], bins, by).drop("feature")


# ------------------------------------------------------------- box plot ---

def spark_local(df: DataFrame) -> DataFrame:
    """Materialise a small (bounded) result as a local DataFrame."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def _with_fences(base: DataFrame, by: str, whis: float) -> DataFrame:
    """Rows (``by``, ``_v`` and any others) with their group's q1, median, q3, iqr and fences
    ``_lof`` / ``_hif``. The fences of few groups (counted) are broadcast, and rows stay where
    they are; those of many are a written table and never come to the driver."""
    spark, probs = base.sparkSession, (0.25, 0.5, 0.75)
    values = base.select(by, "_v")
    few = few_summary(values, ["_v"], probs, [by])
    if few is None:
        q = grouped_quantiles(values, ["_v"], probs, [by]).groupBy(by).agg(*[
            F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
            for p, n in zip(probs, ("q1", "median", "q3"))])
        q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
        q = q.withColumn("_lof", F.col("q1") - whis * F.col("iqr")).withColumn("_hif", F.col("q3") + whis * F.col("iqr"))
        path = scratch_dir(spark, "fences")
        q.write.parquet(path)
        return base.join(spark.read.schema(q.schema).parquet(path), by)
    qv = exact_quantile_values(values, ["_v"], probs, [by], summary=few)
    rows = []
    for g in sorted({k[0][0] for k in qv}):
        q1, med, q3 = qv[((g,), "_v", 0.25)], qv[((g,), "_v", 0.5)], qv[((g,), "_v", 0.75)]
        iqr = q3 - q1
        rows.append((g, q1, med, q3, iqr, q1 - whis * iqr, q3 + whis * iqr))
    schema = T.StructType([base.schema[by]] + [T.StructField(n, T.DoubleType()) for n in
                                               ("q1", "median", "q3", "iqr", "_lof", "_hif")])
    return base.join(F.broadcast(spark.createDataFrame(rows, schema)), by)


def boxplot_outliers(df: DataFrame, feature: str, by: str = "label", keys: Sequence[str] = (),
                     whis: float = 1.5) -> DataFrame:
    """A10: the points beyond the whiskers themselves, ``(by, keys..., value, side)`` with side
    ``low`` or ``high``, for any number of groups; every outlying row once. A group that holds
    most rows is not gathered: its rows meet its fences where they are."""
    base = df.select(col(by).alias(by), *[col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
                     col(feature).cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v") & F.col(by).isNotNull())
    side = F.when(F.col("_v") < F.col("_lof"), F.lit("low")).when(F.col("_v") > F.col("_hif"), F.lit("high"))
    j = _with_fences(base, by, whis).withColumn("side", side).where(F.col("side").isNotNull())
    return j.select(by, *[F.col(f"_key{i}").alias(k) for i, k in enumerate(keys)], F.col("_v").alias("value"), "side")


def boxplot_stats(df: DataFrame, feature: str, by: str = "label", whis: float = 1.5,
                  cache: bool = False) -> DataFrame:
    """A10: box-plot summary per group: n, mean, q1, median, q3, iqr, whiskers
    (most extreme values within 1.5 IQR of the box) and outlier counts.

    Pass 1: exact quartiles per group (distributed selection). Pass 2: the
    per-group fences are joined back and whiskers / outliers come out of one
    conditional aggregate. The fences of few groups (counted) are broadcast;
    those of many are a written table and never come to the driver.
    """
    base = df.select(col(by).alias(by), col(feature).cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v") & F.col(by).isNotNull())
    if cache:
        base = base.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            out = boxplot_stats(base, "_v", by, whis, cache=False)
            path = scratch_dir(df.sparkSession, "boxplot")
            out.write.parquet(path)
            return df.sparkSession.read.schema(out.schema).parquet(path)
        finally:
            base.unpersist()
    j = _with_fences(base, by, whis)
    inside = (F.col("_v") >= F.col("_lof")) & (F.col("_v") <= F.col("_hif"))
    agg = j.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), F.avg("_v").alias("mean"),
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.first("iqr").alias("iqr"),
        F.coalesce(F.min(F.when(F.col("_v") >= F.col("_lof"), F.col("_v"))), F.first("q1")).alias("whisker_lo"),
        F.coalesce(F.max(F.when(F.col("_v") <= F.col("_hif"), F.col("_v"))), F.first("q3")).alias("whisker_hi"),
        F.count(F.when(F.col("_v") < F.col("_lof"), F.lit(1))).alias("n_low_outliers"),
        F.count(F.when(F.col("_v") > F.col("_hif"), F.lit(1))).alias("n_high_outliers"),
        F.count(F.when(~inside, F.lit(1))).alias("n_outliers"))
    return agg.select(by, F.col("n").cast("bigint").alias("n"), "mean", "q1", "median", "q3", "iqr",
                      "whisker_lo", "whisker_hi",
                      *[F.col(c).cast("bigint").alias(c) for c in
                        ("n_low_outliers", "n_high_outliers", "n_outliers")])

