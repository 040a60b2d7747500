"""Distributed running totals over a global order (no single-task window).

An unpartitioned ``Window.orderBy`` moves every row into one task. Instead:

1. cut the ordering column into ~``buckets`` value ranges from a quantile
   sketch (one pass; the cut points are a bounded literal list);
2. running sums *inside* each range with ``Window.partitionBy(bucket)``;
3. per-range totals (one row per range) -> exclusive prefix over ranges;
4. broadcast-join those offsets (bounded by ``buckets`` rows) back.

The input should hold one row per distinct ordering value (pre-aggregate
first), which also neutralises hot values: a value that covers a third of
all rows is a single row here.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions

MAX_BUCKETS = 100_000          # bound of the broadcast per-range offset table
ROWS_PER_BUCKET = 2_000_000    # target rows per range (one window partition)


def _cut_points(df: DataFrame, order_col: str, nb: int):
    """(row count, sorted distinct cut points) for ``nb`` ranges, from one pass
    (count + quantile sketch with rank error 1/(4 nb))."""
    if nb <= 1:
        return None
    probs = [i / nb for i in range(1, nb)]
    acc = int(min(2 ** 31 - 1, 4 * nb))
    r = df.agg(F.count(F.lit(1)).alias("n"),
               F.percentile_approx(F.col(order_col).cast("double"),
                                   F.array(*[F.lit(p) for p in probs]), acc).alias("q")).first()
    cuts = sorted({float(c) for c in (r["q"] or []) if c is not None and not math.isnan(c)})
    return r["n"], cuts


def running_totals(df: DataFrame, order_col: str, sum_cols: Sequence[str],
                   buckets: int | None = None, prefix: str = "cum_",
                   keep_bucket: bool = False) -> DataFrame:
    """Add ``cum_<c>`` = sum of ``c`` over rows whose ``order_col`` <= this row's
    (inclusive, ascending) and ``total_<c>`` = the grand total.
    ``order_col`` must be unique and numeric. ``keep_bucket`` also returns the
    value-range id ``_bucket`` (ranges are ordered like ``order_col``)."""
    spark = df.sparkSession
    nb = min(MAX_BUCKETS, max(1, buckets or shuffle_partitions(spark)))
    cuts = _cut_points(df, order_col, nb)
    if buckets is None and cuts is not None:
        n, cuts = cuts
        # keep every range's window at most ROWS_PER_BUCKET rows: more ranges for big inputs
        want = min(MAX_BUCKETS, -(-n // ROWS_PER_BUCKET))
        if want > nb:
            _, cuts = _cut_points(df, order_col, want)
    elif cuts is not None:
        cuts = cuts[1]
    cuts = cuts or []
    splits = [-math.inf] + cuts + [math.inf]
    keyed = df.withColumn("_oc", F.col(order_col).cast("double"))
    if cuts:
        bucketed = Bucketizer(splits=splits, inputCol="_oc", outputCol="_bucket",
                              handleInvalid="keep").transform(keyed).drop("_oc")
    else:   # empty input or a single distinct value: one range
        bucketed = keyed.withColumn("_bucket", F.lit(0.0)).drop("_oc")

    w_in = (Window.partitionBy("_bucket").orderBy(order_col)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = bucketed.select("*", *[F.sum(c).over(w_in).alias(f"_run_{c}") for c in sum_cols])

    totals = bucketed.groupBy("_bucket").agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    # at most len(splits) rows: single-partition windows here are bounded
    w_off = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(F.lit(0))
    offsets = totals.select("_bucket", *[
        F.coalesce(F.sum(f"_tot_{c}").over(w_off), F.lit(0)).alias(f"_off_{c}") for c in sum_cols],
        *[F.sum(f"_tot_{c}").over(w_all).alias(f"_all_{c}") for c in sum_cols])

    out = runs.join(F.broadcast(offsets), "_bucket")
    return out.select(*[F.col(f"`{c}`") for c in df.columns],
                      *[(F.col(f"_off_{c}") + F.col(f"_run_{c}")).alias(f"{prefix}{c}")
                        for c in sum_cols],
                      *[F.col(f"_all_{c}").alias(f"total_{c}") for c in sum_cols],
                      *(["_bucket"] if keep_bucket else []))
