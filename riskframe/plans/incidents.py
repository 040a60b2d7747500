"""Bindings of the operators to the tables of a data directory.

The engine's operators are parameterised by column roles; this module maps
the star-schema tables onto those roles:

* incident table = lineitem joined to its order: severity is the order
  priority digit (1..5), the order date is the event time, line measures
  and the order total are the numeric features, return flag and line status
  are the categories;
* scored table = orders with a fixed logistic score of the order total, so
  evaluation queries are checkable against plain SQL;
* transactions = orders by customer for the customer (RFM / quarter) features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sigmoid
from ..sources.tables import load_table
from ..spec import PipelineSpec

# Fixed values of the scored-orders fixture: score = sigmoid((total - 250000) / 100000)
# rounded half-up to 9 decimals with IEEE arithmetic (so libm differences in
# exp cannot change a score),
# label = priority digit >= 3, class 1 when score > 0.5 (MLlib's strict rule).
SCORE_CENTER = 250000.0
SCORE_SCALE = 100000.0
SCORE_DECIMALS = 9

INCIDENT_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice")
INCIDENT_SPEC = PipelineSpec(
    target="Severity",
    time_col="Start_Time",
    keep_columns=("l_orderkey", "l_linenumber", "Severity", "Start_Time") + INCIDENT_MEASURES
    + ("l_returnflag", "l_linestatus"),
    measures=INCIDENT_MEASURES,
    categories=("l_returnflag", "l_linestatus"),
    features=INCIDENT_MEASURES + ("Hour", "Month", "Weekday"),
    histogram_features=INCIDENT_MEASURES,
    boxplot_feature="l_extendedprice",
    describe_columns=("Severity", "l_quantity", "l_extendedprice", "l_discount"),
    split_key=("l_orderkey", "l_linenumber"),
)


def severity_of(priority_col: str = "o_orderpriority"):
    """Priority text '3-MEDIUM' -> 3 (null when not numeric)."""
    return F.expr(f"try_cast(substr({priority_col}, 1, 1) as int)")


def incidents(spark: SparkSession, data_dir: str) -> DataFrame:
    """lineitem x orders on the order key, projected to the incident layout."""
    li = load_table(spark, data_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus")
    o = load_table(spark, data_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority", "o_orderdate")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    return j.select("l_orderkey", "l_linenumber", severity_of().alias("Severity"),
                    F.col("o_orderdate").alias("Start_Time"), *INCIDENT_MEASURES,
                    "l_returnflag", "l_linestatus")


def scored_orders(spark: SparkSession, data_dir: str) -> DataFrame:
    """orders with label, fixed score p1 and predicted class (double)."""
    o = load_table(spark, data_dir, "orders")
    sev = severity_of()
    p = sigmoid((F.col("o_totalprice") - F.lit(SCORE_CENTER)) / F.lit(SCORE_SCALE))
    scale = F.lit(10.0 ** SCORE_DECIMALS)
    p1 = F.floor(p * scale + F.lit(0.5)) / scale
    return o.select(
        "o_orderkey", "o_totalprice", "o_orderstatus",
        F.when(sev >= 3, F.lit(1)).otherwise(F.lit(0)).alias("label"),
        p1.alias("p1"),
    ).withColumn("prediction", F.when(F.col("p1") > 0.5, F.lit(1.0)).otherwise(F.lit(0.0)))


SCORED_SQL = f"""sc AS (
  SELECT o_orderkey, o_totalprice, o_orderstatus,
         CASE WHEN TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) >= 3 THEN 1 ELSE 0 END AS label,
         floor(1.0 / (1.0 + exp(-((o_totalprice - {SCORE_CENTER}) / {SCORE_SCALE}))) * {10.0 ** SCORE_DECIMALS!r} + 0.5)
           / {10.0 ** SCORE_DECIMALS!r} AS p1
  FROM orders),
sp AS (SELECT *, CAST(CASE WHEN p1 > 0.5 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS prediction FROM sc)"""
