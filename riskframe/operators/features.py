"""Label and feature derivation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import col, quarter_index
from .clean import cast_int, require_columns


def binary_label(df: DataFrame, target: str = "Severity", threshold: int = 3,
                 label: str = "label") -> DataFrame:
    """Trim names, require ``target``, cast it to int, label = target >= threshold.

    A null (or non-numeric) target gets label 0, as in the original pipeline.
    """
    df = df.toDF(*[c.strip() for c in df.columns])
    require_columns(df, [target])
    df = cast_int(df, target)
    return df.withColumn(label, F.when(col(target) >= threshold, F.lit(1)).otherwise(F.lit(0)))


def time_features(df: DataFrame, ts: str = "Start_Time") -> DataFrame:
    """Hour 0-23, Weekday 1=Sunday..7=Saturday, Month 1-12; no-op if ``ts`` is absent.

    String timestamps are parsed with ``try_to_timestamp`` so a malformed value
    yields nulls instead of failing the job under ANSI mode.
    """
    if ts not in df.columns:
        return df
    t = col(ts)
    if dict(df.dtypes)[ts] == "string":
        t = F.expr(f"try_to_timestamp(`{ts}`)")
    return (df.withColumn("Hour", F.hour(t))
              .withColumn("Weekday", F.dayofweek(t))
              .withColumn("Month", F.month(t)))


# ---------------------------------------------------------------------------
# Documented customer features (RFM, quarters, trend, next-quarter label)
# ---------------------------------------------------------------------------

def rfm(orders: DataFrame, customer: str, order_id: str, ts: str, amount: str) -> DataFrame:
    """D3: per customer recency (days to the data set's last date), frequency
    (distinct orders), monetary (sum), life span (days first..last) and
    average order value.

    The data set's last date is one global aggregate whose single value is
    inlined as a literal: no cross join, no unpartitioned window. It is
    fetched as a DATE so the literal does not depend on any time zone.
    """
    last = orders.select(F.max(col(ts)).cast("date").alias("m")).first()["m"]
    per = orders.groupBy(col(customer).alias(customer)).agg(
        F.max(col(ts)).alias("_last"),
        F.min(col(ts)).alias("_first"),
        F.countDistinct(col(order_id)).alias("frequency"),
        F.sum(col(amount)).alias("monetary"),
    )
    return per.select(
        col(customer),
        F.datediff(F.lit(last), F.col("_last")).cast("bigint").alias("recency_days"),
        F.col("frequency").cast("bigint").alias("frequency"),
        F.col("monetary").alias("monetary"),
        F.datediff(F.col("_last"), F.col("_first")).cast("bigint").alias("lifespan_days"),
        (F.col("monetary") / F.col("frequency")).alias("avg_order_value"),
    )


def quarter_features(orders: DataFrame, customer: str, order_id: str, ts: str,
                     amount: str) -> DataFrame:
    """Per customer and quarter: amount, distinct orders, average value.

    The quarter index is year*4+quarter-1 so adjacent quarters differ by one.
    Pre-aggregating to (customer, quarter) bounds every later per-customer
    window by the number of quarters, however skewed the customers are.
    """
    g = orders.groupBy(col(customer).alias(customer),
                       quarter_index(col(ts)).alias("quarter_idx")).agg(
        F.sum(col(amount)).alias("_amt"),
        F.countDistinct(col(order_id)).alias("_n"))
    return g.select(
        col(customer), F.col("quarter_idx"),
        (F.col("quarter_idx") / 4).cast("bigint").alias("year"),
        (F.col("quarter_idx") % 4 + 1).cast("int").alias("quarter"),
        F.col("_amt").alias("quarter_amount"),
        F.col("_n").cast("bigint").alias("quarter_frequency"),
        (F.col("_amt") / F.col("_n")).alias("quarter_avg_value"),
    )


def quarter_trend(qf: DataFrame, customer: str) -> DataFrame:
    """Sign of the amount change against the immediately preceding quarter
    (-1 / 0 / +1); 0 when the previous quarter has no purchase."""
    w = Window.partitionBy(col(customer)).orderBy("quarter_idx")
    prev_q = F.lag("quarter_idx").over(w)
    prev_a = F.lag("quarter_amount").over(w)
    trend = F.when(prev_q == F.col("quarter_idx") - 1,
                   F.signum(F.col("quarter_amount") - prev_a)).otherwise(F.lit(0.0))
    return qf.withColumn("purchase_trend", trend.cast("int"))


def next_quarter_label(qf: DataFrame, customer: str, label: str = "label",
                       last_quarter: int | None = None) -> DataFrame:
    """1 when the customer buys in the next quarter, else 0.

    Rows of the data set's last quarter are dropped: their next quarter is not
    observed, so the label is unknown. ``last_quarter`` (an index) names that
    quarter where the caller knows it, for instance the last *complete* one.
    """
    if last_quarter is None:
        last_quarter = qf.select(F.max("quarter_idx").alias("m")).first()["m"]
    w = Window.partitionBy(col(customer)).orderBy("quarter_idx")
    nxt = F.lead("quarter_idx").over(w)
    return (qf.withColumn(label, F.when(nxt == F.col("quarter_idx") + 1, F.lit(1)).otherwise(F.lit(0)))
              .where(F.col("quarter_idx") < F.lit(last_quarter)))


def customer_quarter_table(orders: DataFrame, customer: str, order_id: str, ts: str,
                           amount: str, label: str = "label", complete_until=None) -> DataFrame:
    """D4 + D5 + D6 in one plan: both windows share one partitioning/sort.

    The last quarter comes from the orders' last date (one aggregate over one column),
    or from ``complete_until``: the date up to which orders are complete. Quarters
    that are not over by then are no evidence that a customer did not buy, so labels
    stop before the last complete quarter."""
    if complete_until is None:
        last = orders.select(quarter_index(F.max(col(ts))).alias("m")).first()["m"]
    else:
        end = F.date_add(F.lit(complete_until).cast("date"), 1)      # the quarter it falls in is open
        last = orders.sparkSession.range(1).select((quarter_index(end) - 1).alias("m")).first()["m"]
    qf = quarter_features(orders, customer, order_id, ts, amount)
    return next_quarter_label(quarter_trend(qf, customer), customer, label, last)


def latest_quarter_rows(orders: DataFrame, customer: str, order_id: str, ts: str,
                        amount: str) -> DataFrame:
    """D7 input: for *every* customer the features (with trend) of the last quarter in
    which the customer bought - the row to be scored."""
    qf = quarter_trend(quarter_features(orders, customer, order_id, ts, amount), customer)
    last = Window.partitionBy(col(customer))         # one row per quarter of a customer
    return (qf.withColumn("_last", F.max("quarter_idx").over(last))
              .where(F.col("quarter_idx") == F.col("_last")).drop("_last"))
