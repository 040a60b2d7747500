"""Registered queries: each binds operators to the tables of a data directory.

``QUERIES[name](spark, data_dir) -> DataFrame`` and, where the operator is
SQL-expressible, ``ORACLE[name]`` is the same computation in plain SQL over
the same tables (used to check results). Computed doubles are rounded on
both sides by the shared contract in ``rounding`` so the two engines compare
bit for bit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import numeric_columns
from ..operators import clean, encode, evaluate, features, model, quantiles, score, stats
from ..session import scratch_dir
from ..sources import files, reports
from ..sources.tables import load_table
from . import pipeline
from .incidents import INCIDENT_MEASURES, INCIDENT_SPEC, SCORED_SQL, incidents, scored_orders
from .rounding import rounded, sig_py, sql_sig, sql_unit, unit_round

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
def query(name: str, sql: str | None = None, round_doubles: bool = True):
    """Register ``fn`` as query ``name`` (with its SQL oracle). Queries whose
    doubles are stored values passed through unchanged (both engines return
    the same bits) set ``round_doubles=False``."""
    def deco(fn):
        def run(spark: SparkSession, data_dir: str) -> DataFrame:
            out = fn(spark, data_dir)
            return rounded(out) if round_doubles else out
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def tbl(spark, d, name):
    return load_table(spark, d, name)


# =====================================================================
# Step 1 - cleaning, label, time features
# =====================================================================

LI_NULLS = ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
LI_NULLS_SQL = """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
         nullif(l_tax, 0) AS l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem"""


def _li_with_nulls(spark, d):
    li = tbl(spark, d, "lineitem")
    return li.select(*[F.expr("nullif(l_tax, 0)").alias("l_tax") if c == "l_tax" else F.col(c)
                       for c in LI_NULLS])


def _not_null_sql(cols, doubles=()):
    return " AND ".join(f"{c} IS NOT NULL" + (f" AND NOT isnan({c})" if c in doubles else "")
                        for c in cols)


@query("drop_nulls", f"""
SELECT * FROM ({LI_NULLS_SQL}) b
WHERE {_not_null_sql(LI_NULLS, ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))}""", round_doubles=False)
def q_drop_nulls(spark, d):
    """Rows with any null (tax 0 read as null) removed."""
    return clean.drop_nulls(_li_with_nulls(spark, d))


@query("dedupe_rows", """
SELECT DISTINCT l_returnflag, l_linestatus, l_tax, l_quantity FROM lineitem""", round_doubles=False)
def q_dedupe_rows(spark, d):
    """Exact duplicates removed from a narrow projection."""
    return clean.dedupe_rows(tbl(spark, d, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_tax", "l_quantity"))


CLEAN_KEEP = ("l_returnflag", "l_linestatus", "l_tax", "l_quantity", "l_comment")


@query("clean_data", f"""
SELECT DISTINCT l_returnflag, l_linestatus, l_tax, l_quantity FROM ({LI_NULLS_SQL}) b
WHERE {_not_null_sql(("l_returnflag", "l_linestatus", "l_tax", "l_quantity"), ("l_tax", "l_quantity"))}""", round_doubles=False)
def q_clean_data(spark, d):
    """P1+P2+P3: tolerant projection (l_comment absent), null filter, dedupe."""
    return clean.clean_data(_li_with_nulls(spark, d), CLEAN_KEEP)


SEVERITY_SQL = "TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER)"


@query("binary_label", f"""
SELECT o_orderkey, {SEVERITY_SQL} AS severity,
       CASE WHEN {SEVERITY_SQL} >= 3 THEN 1 ELSE 0 END AS label
FROM orders""", round_doubles=False)
def q_binary_label(spark, d):
    """severity = priority digit, label = severity >= 3."""
    o = tbl(spark, d, "orders").select("o_orderkey",
                                       F.substring("o_orderpriority", 1, 1).alias(" severity "))
    return features.binary_label(o, "severity", 3, "label")


@query("time_features", """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS Hour, CAST(dayofweek(ts) + 1 AS INTEGER) AS Weekday,
       CAST(month(ts) AS INTEGER) AS Month
FROM events""", round_doubles=False)
def q_time_features(spark, d):
    """Hour, weekday (1 = Sunday), month of the event time."""
    e = tbl(spark, d, "events").select("event_id", "ts")
    return features.time_features(e, "ts").drop("ts")


@query("preview", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem
ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity LIMIT 5""", round_doubles=False)
def q_preview(spark, d):
    """First five rows of the first five columns, in key order (a top-k)."""
    li = tbl(spark, d, "lineitem")
    first5 = li.columns[:5]
    return li.select(*first5).orderBy(*first5).limit(5)


@query("project_existing", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer", round_doubles=False)
def q_project_existing(spark, d):
    """Keep wanted columns that exist (c_phone, c_address are absent)."""
    return clean.project_existing(tbl(spark, d, "customer"),
                                  ["c_custkey", "c_name", "c_phone", "c_acctbal", "c_address",
                                   "c_mktsegment"])


@query("trim_names", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders", round_doubles=False)
def q_trim_names(spark, d):
    """Outer spaces removed from column names."""
    o = tbl(spark, d, "orders").select(F.col("o_orderkey").alias("  o_orderkey"),
                                       F.col("o_orderstatus").alias("o_orderstatus "),
                                       F.col("o_totalprice").alias(" o_totalprice "))
    return clean.trim_names(o)


# =====================================================================
# Step 2 - statistics
# =====================================================================

LABELLED_SQL = f"""lb AS (SELECT *, {SEVERITY_SQL} AS severity,
    CASE WHEN {SEVERITY_SQL} >= 3 THEN 1 ELSE 0 END AS label FROM orders)"""


def _labelled_orders(spark, d):
    o = tbl(spark, d, "orders").withColumn("severity", F.substring("o_orderpriority", 1, 1))
    return features.binary_label(o, "severity", 3, "label")


@query("severity_distribution", f"""
WITH {LABELLED_SQL}
SELECT severity, count(*) AS count FROM lb GROUP BY severity ORDER BY severity""")
def q_severity_distribution(spark, d):
    """A3: orders per severity level."""
    return stats.severity_distribution(_labelled_orders(spark, d), "severity")


@query("label_distribution", f"""
WITH {LABELLED_SQL}
SELECT label, count(*) AS count FROM lb GROUP BY label ORDER BY label""")
def q_label_distribution(spark, d):
    """Orders per binary label."""
    return stats.distribution(_labelled_orders(spark, d), "label")


STAGE_COLS = ("l_returnflag", "l_linestatus", "l_tax", "l_quantity")


@query("stage_counts", f"""
WITH b AS ({LI_NULLS_SQL})
SELECT CAST(count(*) AS BIGINT) AS raw_rows,
       CAST(count(*) FILTER (WHERE {_not_null_sql(STAGE_COLS, ("l_tax", "l_quantity"))}) AS BIGINT) AS non_null_rows,
       CAST((SELECT count(*) FROM (SELECT DISTINCT {", ".join(STAGE_COLS)} FROM b
             WHERE {_not_null_sql(STAGE_COLS, ("l_tax", "l_quantity"))})) AS BIGINT) AS clean_rows
FROM b""")
def q_stage_counts(spark, d):
    """A1: raw, non-null and final (deduplicated) row counts in one plan."""
    return stats.stage_counts(_li_with_nulls(spark, d), list(STAGE_COLS))


DESCRIBE_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _describe_sql(cols, table):
    parts = []
    for s, fn in (("count", "count({c})"), ("mean", "avg({c})"), ("stddev", "stddev_samp({c})"),
                  ("min", "min({c})"), ("max", "max({c})")):
        sel = ", ".join(f"{sql_sig('CAST(' + fn.format(c=c) + ' AS DOUBLE)')} AS {c}" for c in cols)
        parts.append(f"SELECT '{s}' AS summary, {sel} FROM {table}")
    return "\nUNION ALL\n".join(parts)


@query("describe_core", _describe_sql(DESCRIBE_COLS, "lineitem"))
def q_describe_core(spark, d):
    """A2: typed describe of four measures."""
    return stats.describe_core(tbl(spark, d, "lineitem"), list(DESCRIBE_COLS))


LI_STAT_FEATURES = ("l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
LI_KEYS = ("l_orderkey", "l_partkey", "l_suppkey")


def _column_stats_sql(long_sql: str, extra: str = "", select_extra: str = "") -> str:
    """SQL oracle of column_stats over a long (feature, x) relation."""
    return f"""
WITH long AS ({long_sql}),
mu AS (SELECT feature, avg(x) AS m FROM long GROUP BY feature),
agg AS (
  SELECT l.feature AS Feature, CAST(count(x) AS BIGINT) AS Count, avg(x) AS Mean,
         quantile_cont(x, 0.5) AS Median, stddev_samp(x) AS Std, min(x) AS Min, max(x) AS Max,
         quantile_cont(x, 0.25) AS Q1, quantile_cont(x, 0.75) AS Q3,
         CASE WHEN avg((x - m) * (x - m)) = 0 THEN NULL
              ELSE avg((x - m) * (x - m) * (x - m)) / pow(avg((x - m) * (x - m)), 1.5) END AS Skewness,
         CASE WHEN avg((x - m) * (x - m)) = 0 THEN NULL
              ELSE avg((x - m) * (x - m) * (x - m) * (x - m)) / pow(avg((x - m) * (x - m)), 2) - 3 END AS Kurtosis
  FROM long l JOIN mu ON l.feature = mu.feature GROUP BY l.feature)
SELECT Feature, Count, {", ".join(sql_sig(c) + " AS " + c for c in
    ("Mean", "Median", "Std", "Min", "Max", "Q1", "Q3"))},
       {sql_sig(sql_unit("Skewness"))} AS Skewness, {sql_sig(sql_unit("Kurtosis"))} AS Kurtosis{select_extra}
FROM agg {extra}"""


def _long_sql(cols, table):
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM {table}"
                              for c in cols)


@query("column_stats", _column_stats_sql(_long_sql(LI_STAT_FEATURES, "lineitem")))
def q_column_stats(spark, d):
    """A5-A7 + P9: numeric columns (keys excluded) summarised in one long pass."""
    li = tbl(spark, d, "lineitem")
    feats = numeric_columns(li, exclude=LI_KEYS)
    return unit_round(stats.column_stats(li, feats), ("Skewness", "Kurtosis"))


@query("skew_flag", f"""
SELECT Feature, Skewness, abs(Skewness) > 1 AS skewed FROM (
{_column_stats_sql(_long_sql(LI_STAT_FEATURES + ("o_totalprice",), "lineitem JOIN orders ON l_orderkey = o_orderkey"))}) s""")
def q_skew_flag(spark, d):
    """O3: features with |skewness| > 1."""
    li = tbl(spark, d, "lineitem")
    o = tbl(spark, d, "orders").select("o_orderkey", "o_totalprice")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    st = stats.column_stats(j, list(LI_STAT_FEATURES) + ["o_totalprice"], quantiles="none")
    return unit_round(stats.skew_flag(st).select("Feature", "Skewness", "skewed"), ("Skewness",))


QPROBS = (0.1, 0.25, 0.5, 0.75, 0.9)


@query("quartiles_exact", " UNION ALL ".join(
    f"SELECT o_orderstatus, 'o_totalprice' AS feature, CAST({p} AS DOUBLE) AS prob, "
    f"{sql_sig(f'quantile_cont(o_totalprice, {p})')} AS value FROM orders GROUP BY o_orderstatus"
    for p in QPROBS))
def q_quartiles_exact(spark, d):
    """A6 (exact): interpolated quantiles of the order total per order status."""
    o = tbl(spark, d, "orders")
    return quantiles.exact_quantiles(o, ["o_totalprice"], QPROBS, ["o_orderstatus"])


@query("quartiles_many_groups", " UNION ALL ".join(
    f"SELECT l_orderkey, 'l_quantity' AS feature, CAST({p} AS DOUBLE) AS prob, "
    f"{sql_sig(f'quantile_cont(CAST(l_quantity AS DOUBLE), {p})')} AS value FROM lineitem GROUP BY l_orderkey"
    for p in (0.25, 0.5, 0.75)))
def q_quartiles_many_groups(spark, d):
    """A6 (exact): quartiles of the quantity of every order (as many groups as orders)."""
    return quantiles.grouped_quantiles(tbl(spark, d, "lineitem"), ["l_quantity"], (0.25, 0.5, 0.75), ["l_orderkey"])


@query("skew_flag_events", f"""
SELECT Feature, Skewness, abs(Skewness) > 1 AS skewed FROM (
{_column_stats_sql(_long_sql(("value", "user_id"), "events"))}) s""")
def q_skew_flag_events(spark, d):
    """O3 on a skewed measure: both values of the flag occur."""
    st = stats.column_stats(tbl(spark, d, "events"), ["value", "user_id"], quantiles="none")
    return unit_round(stats.skew_flag(st).select("Feature", "Skewness", "skewed"), ("Skewness",))


@query("quartiles_approx")
def q_quartiles_approx(spark, d):
    """A6 (sketch, relative error 0.01): quartiles of line measures; rows-only check."""
    return quantiles.approx_quantiles(tbl(spark, d, "lineitem"), list(DESCRIBE_COLS),
                                      (0.25, 0.5, 0.75), relative_error=0.01)


def _hist_sql(value: str, table: str, by: str | None, bins: int = 30, feature: str | None = None) -> str:
    feature = feature or value
    by_sel = f"{by}, " if by else ""
    grid_from = f"range({bins}) t(i), s, (SELECT DISTINCT {by} FROM src) g" if by else f"range({bins}) t(i), s"
    join_on = f"gr.bin = b.bin AND gr.{by} = b.{by}" if by else "gr.bin = b.bin"
    gb = f"gr.{by}, " if by else ""
    return f"""
WITH src AS (SELECT {by_sel}CAST({value} AS DOUBLE) AS x FROM {table}
             WHERE {value} IS NOT NULL AND NOT isnan(CAST({value} AS DOUBLE))),
r AS (SELECT min(x) AS lo0, max(x) AS hi0 FROM src),
e AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
             CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM r),
s AS (SELECT lo, hi, (hi - lo) / {bins} AS step FROM e),
g0 AS (SELECT {by_sel}x, lo, step,
              CAST(least(greatest(floor((x - lo) / (hi - lo) * {bins}), 0), {bins - 1}) AS INTEGER) AS g
       FROM src, s),
b AS (SELECT {by_sel}CASE WHEN x < g * step + lo THEN g - 1
                           WHEN g < {bins - 1} AND x >= (g + 1) * step + lo THEN g + 1 ELSE g END AS bin
      FROM g0),
gr AS (SELECT {by_sel}CAST(i AS INTEGER) AS bin, i * step + lo AS bin_lo,
              CASE WHEN i = {bins - 1} THEN hi ELSE (i + 1) * step + lo END AS bin_hi FROM {grid_from})
SELECT {gb}'{feature}' AS feature, gr.bin AS bin, {sql_sig('gr.bin_lo')} AS bin_lo, {sql_sig('gr.bin_hi')} AS bin_hi,
       CAST(count(b.bin) AS BIGINT) AS count
FROM gr LEFT JOIN b ON {join_on}
GROUP BY {gb}gr.bin, gr.bin_lo, gr.bin_hi"""


@query("histogram_30", _hist_sql("o_totalprice", "orders", None))
def q_histogram_30(spark, d):
    """30 equal-width bins of the order total (numpy edge rules)."""
    return stats.histograms(tbl(spark, d, "orders"), ["o_totalprice"], 30)


@query("histogram_by_label", _hist_sql(
    "o_totalprice", f"(SELECT *, CASE WHEN {SEVERITY_SQL} >= 3 THEN 1 ELSE 0 END AS label FROM orders) o",
    "label"))
def q_histogram_by_label(spark, d):
    """The same bins, counted per label (shared edges)."""
    return stats.histograms(_labelled_orders(spark, d), ["o_totalprice"], 30, by="label")


@query("histograms_multi", " UNION ALL ".join(
    f"SELECT * FROM ({_hist_sql(c, 'lineitem', None)})" for c in DESCRIBE_COLS))
def q_histograms_multi(spark, d):
    """Histograms of four line measures from a single scan."""
    return stats.histograms(tbl(spark, d, "lineitem"), list(DESCRIBE_COLS), 30)


BOXPLOT_SQL = f"""
WITH src AS (SELECT l_returnflag, l_extendedprice AS v FROM lineitem
             WHERE l_extendedprice IS NOT NULL AND NOT isnan(l_extendedprice) AND l_returnflag IS NOT NULL),
q AS (SELECT l_returnflag, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3 FROM src GROUP BY l_returnflag),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lof, q3 + 1.5 * (q3 - q1) AS hif FROM q)
SELECT s.l_returnflag, CAST(count(*) AS BIGINT) AS n, {sql_sig('avg(v)')} AS mean,
       {sql_sig('any_value(q1)')} AS q1, {sql_sig('any_value(median)')} AS median, {sql_sig('any_value(q3)')} AS q3,
       {sql_sig('any_value(iqr)')} AS iqr,
       {sql_sig('coalesce(min(v) FILTER (WHERE v >= lof), any_value(q1))')} AS whisker_lo,
       {sql_sig('coalesce(max(v) FILTER (WHERE v <= hif), any_value(q3))')} AS whisker_hi,
       CAST(count(*) FILTER (WHERE v < lof) AS BIGINT) AS n_low_outliers,
       CAST(count(*) FILTER (WHERE v > hif) AS BIGINT) AS n_high_outliers,
       CAST(count(*) FILTER (WHERE v < lof OR v > hif) AS BIGINT) AS n_outliers
FROM src s JOIN f ON s.l_returnflag = f.l_returnflag GROUP BY s.l_returnflag"""


@query("boxplot_stats", BOXPLOT_SQL)
def q_boxplot_stats(spark, d):
    """A10: box-plot statistics of the extended price per return flag."""
    return stats.boxplot_stats(tbl(spark, d, "lineitem"), "l_extendedprice", by="l_returnflag")


# =====================================================================
# Step 3 - evaluation of a fixed score
# =====================================================================

@query("confusion_counts", f"""
WITH {SCORED_SQL}
SELECT label, prediction, count(*) AS count FROM sp GROUP BY label, prediction ORDER BY label, prediction""")
def q_confusion_counts(spark, d):
    """Rows per (label, prediction)."""
    return evaluate.confusion_counts(scored_orders(spark, d))


CELLS_SQL = """cells AS (SELECT
    CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) AS tp,
    CAST(count(*) FILTER (WHERE label = 0 AND prediction = 0) AS DOUBLE) AS tn,
    CAST(count(*) FILTER (WHERE label = 0 AND prediction = 1) AS DOUBLE) AS fp,
    CAST(count(*) FILTER (WHERE label = 1 AND prediction = 0) AS DOUBLE) AS fn FROM sp)"""


@query("confusion_cells", f"""
WITH {SCORED_SQL}, {CELLS_SQL}
SELECT tp, tn, fp, fn, tp + tn + fp + fn AS total FROM cells""")
def q_confusion_cells(spark, d):
    """A12 + A25: the four cells as doubles and their total."""
    return evaluate.confusion_cells(scored_orders(spark, d))


@query("confusion_matrix", f"""
WITH {SCORED_SQL}
SELECT label, CAST(count(*) FILTER (WHERE prediction = 0.0) AS BIGINT) AS pred_0,
       CAST(count(*) FILTER (WHERE prediction = 1.0) AS BIGINT) AS pred_1
FROM sp GROUP BY label""")
def q_confusion_matrix(spark, d):
    """2x2 pivot with fixed prediction columns."""
    return evaluate.confusion_matrix(scored_orders(spark, d))


RATES_SQL = """
  tp / (tp + fn + 1e-9) AS sensitivity,
  tn / (tn + fp + 1e-9) AS specificity,
  fp / (fp + tn + 1e-9) AS fpr,
  fn / (tp + fn + 1e-9) AS fnr,
  tp / (tp + fp + 1e-9) AS precision"""


def _rates_select():
    return f"""rates AS (SELECT *, {RATES_SQL},
  (tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn) + 1e-9) AS mcc FROM cells),
rates2 AS (SELECT *, 2.0 * precision * sensitivity / (precision + sensitivity + 1e-9) AS f1,
  sensitivity - fpr AS youden_j FROM rates)"""


@query("rate_metrics", f"""
WITH {SCORED_SQL}, {CELLS_SQL}, {_rates_select()}
SELECT {", ".join(sql_sig(c) + " AS " + c for c in
    ("sensitivity", "specificity", "fpr", "fnr", "precision", "f1", "mcc", "youden_j"))}
FROM rates2""")
def q_rate_metrics(spark, d):
    """Rates with +1e-9 smoothing, MCC in double, Youden's J."""
    return evaluate.rate_metrics(evaluate.confusion_cells(scored_orders(spark, d)))


@query("accuracy_weighted", f"""
WITH {SCORED_SQL},
cc AS (SELECT CAST(label AS DOUBLE) AS y, prediction AS p, count(*) AS n FROM sp GROUP BY 1, 2),
bl AS (SELECT y AS c, sum(n) AS n_c, coalesce(sum(n) FILTER (WHERE y = p), 0) AS tp_c FROM cc GROUP BY y),
bp AS (SELECT p AS c, sum(n) AS pred_c FROM cc GROUP BY p),
k AS (SELECT bl.n_c, bl.tp_c,
             CASE WHEN coalesce(bp.pred_c, 0) = 0 THEN 0.0 ELSE bl.tp_c / bp.pred_c END AS prec,
             bl.tp_c / bl.n_c AS rec
      FROM bl LEFT JOIN bp ON bl.c = bp.c)
SELECT {sql_sig('CAST(sum(tp_c) AS DOUBLE) / sum(n_c)')} AS accuracy,
       {sql_sig('sum(prec * n_c) / sum(n_c)')} AS weighted_precision,
       {sql_sig('sum(rec * n_c) / sum(n_c)')} AS weighted_recall,
       {sql_sig('sum(CASE WHEN prec + rec = 0 THEN 0.0 ELSE 2.0 * prec * rec / (prec + rec) END * n_c) / sum(n_c)')} AS weighted_f1
FROM k""")
def q_accuracy_weighted(spark, d):
    """A14 + A15: accuracy and label-weighted precision / recall / F1."""
    return evaluate.accuracy_weighted(scored_orders(spark, d))


AUC_SQL = """g AS (SELECT p1, sum(label) AS pos, count(*) - sum(label) AS neg FROM sp GROUP BY p1),
r AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY p1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
      FROM g),
auc AS (SELECT CAST(sum(pos * (nb + 0.5 * neg)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS auc_roc FROM r)"""


@query("auc_exact", f"""
WITH {SCORED_SQL}, {AUC_SQL}
SELECT {sql_sig('auc_roc')} AS auc_roc FROM auc""")
def q_auc_exact(spark, d):
    """Exact area under ROC (distributed running totals over distinct scores)."""
    return evaluate.auc_exact(scored_orders(spark, d))


@query("brier_logloss", f"""
WITH {SCORED_SQL}
SELECT {sql_sig(sql_unit('avg((p1 - label) * (p1 - label))'))} AS brier,
       {sql_sig(sql_unit('-avg(label * ln(p1 + 1e-15) + (1 - label) * ln(1 - p1 + 1e-15))'))} AS log_loss
FROM sp""")
def q_brier_logloss(spark, d):
    """A17 + A18 in one aggregate."""
    return unit_round(evaluate.brier_logloss(scored_orders(spark, d)), ("brier", "log_loss"))


@query("roc_points", f"""
WITH {SCORED_SQL},
g AS (SELECT p1, sum(label) AS pos, count(*) - sum(label) AS neg FROM sp GROUP BY p1),
t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM g),
r AS (SELECT p1, sum(pos) OVER (ORDER BY p1 DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
             sum(neg) OVER (ORDER BY p1 DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp FROM g)
SELECT {sql_sig('p1')} AS threshold, {sql_sig('CAST(fp AS DOUBLE) / N')} AS fpr, {sql_sig('CAST(tp AS DOUBLE) / P')} AS tpr
FROM r, t""")
def q_roc_points(spark, d):
    """(threshold, FPR, TPR) at every distinct score."""
    return evaluate.roc_points(scored_orders(spark, d))


@query("roc_curve", f"""
WITH {SCORED_SQL},
g AS (SELECT p1, sum(label) AS pos, count(*) - sum(label) AS neg FROM sp GROUP BY p1),
t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM g),
r AS (SELECT p1, sum(pos) OVER (ORDER BY p1 DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
             sum(neg) OVER (ORDER BY p1 DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp FROM g),
k AS (SELECT *, lag(tp) OVER (ORDER BY p1 DESC) AS tp_a, lead(tp) OVER (ORDER BY p1 DESC) AS tp_b,
             lag(fp) OVER (ORDER BY p1 DESC) AS fp_a, lead(fp) OVER (ORDER BY p1 DESC) AS fp_b FROM r)
SELECT CAST('inf' AS DOUBLE) AS threshold, CAST(0.0 AS DOUBLE) AS fpr, CAST(0.0 AS DOUBLE) AS tpr
UNION ALL
SELECT {sql_sig('p1')} AS threshold, {sql_sig('CAST(fp AS DOUBLE) / N')} AS fpr,
       {sql_sig('CAST(tp AS DOUBLE) / P')} AS tpr
FROM k, t
WHERE tp_a IS NULL OR tp_b IS NULL OR tp_b - 2 * tp + tp_a <> 0 OR fp_b - 2 * fp + fp_a <> 0""")
def q_roc_curve(spark, d):
    """A23 as the usual roc_curve: bend points only, origin (inf, 0, 0) first."""
    return evaluate.roc_points(scored_orders(spark, d), drop_intermediate=True, with_origin=True)


def _metrics_long_sql():
    cols = {
        "accuracy": "(tp + tn) / (tp + tn + fp + fn)", "auc_roc": "(SELECT auc_roc FROM auc)",
        "precision": "precision", "sensitivity": "sensitivity", "specificity": "specificity",
        "f1": "f1", "fnr": "fnr", "fpr": "fpr", "mcc": "mcc", "youden_j": "youden_j",
        "brier": "(SELECT brier FROM pl)", "log_loss": "(SELECT log_loss FROM pl)",
        "tp": "tp", "tn": "tn", "fp": "fp", "fn": "fn"}
    sel = "\nUNION ALL ".join(f"SELECT '{name}' AS Metric, {sql_sig('round(CAST(' + cols[key] + ' AS DOUBLE), 6)')} AS Value FROM rates2"
                              for name, key in evaluate.METRIC_NAMES)
    return f"""
WITH {SCORED_SQL}, {CELLS_SQL}, {_rates_select()}, {AUC_SQL},
pl AS (SELECT avg((p1 - label) * (p1 - label)) AS brier,
              -avg(label * ln(p1 + 1e-15) + (1 - label) * ln(1 - p1 + 1e-15)) AS log_loss FROM sp),
ml AS ({sel})"""


@query("metrics_long", _metrics_long_sql() + "\nSELECT Metric, Value FROM ml")
def q_metrics_long(spark, d):
    """The 16-row evaluation report (Metric, Value)."""
    sp = scored_orders(spark, d)
    return evaluate.metrics_long(evaluate.evaluation_summary(sp))


KPI_SQL = _metrics_long_sql() + """,
names AS (SELECT * FROM (VALUES ('Accuracy', 'Accuracy'), ('Precision (Severe Accident)', 'Precision'),
  ('Recall / Sensitivity (Severe Accident Detection)', 'Recall'), ('F1-Score', 'F1-Score'),
  ('AUC-ROC', 'AUC-ROC')) v(Metric, kpi))
SELECT names.kpi AS Metric, CAST(coalesce(ml.Value, 0.0) AS DOUBLE) AS Value
FROM names LEFT JOIN ml ON names.Metric = ml.Metric"""


@query("kpi_subset", KPI_SQL)
def q_kpi_subset(spark, d):
    """Five headline metrics under short names, 0 when missing."""
    sp = scored_orders(spark, d)
    return evaluate.kpi_subset(evaluate.metrics_long(evaluate.evaluation_summary(sp)))


# =====================================================================
# Step 4 - encoding, splitting, scoring
# =====================================================================

@query("string_index", """
WITH e AS (SELECT event_id, nullif(event_type, 'view') AS event_type FROM events),
f AS (SELECT event_type, count(*) AS n FROM e WHERE event_type IS NOT NULL GROUP BY event_type),
r AS (SELECT event_type, CAST(row_number() OVER (ORDER BY n DESC, event_type) - 1 AS DOUBLE) AS idx FROM f),
k AS (SELECT CAST(count(*) AS DOUBLE) AS k FROM f)
SELECT e.event_id, e.event_type, coalesce(r.idx, k.k) AS event_type_idx
FROM e LEFT JOIN r ON e.event_type = r.event_type CROSS JOIN k""", round_doubles=False)
def q_string_index(spark, d):
    """M1: frequency-ordered index, ties alphabetical; null -> extra last index."""
    e = tbl(spark, d, "events").select("event_id", F.expr("nullif(event_type, 'view')").alias("event_type"))
    out, _ = encode.string_index(e, ["event_type", "no_such_column"])
    return out


SPLIT_KEY_SQL = "('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber)), 1, 7))::BIGINT < 214748365"
Z_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("hash_split", f"SELECT l_orderkey, l_linenumber, {SPLIT_KEY_SQL} AS is_train FROM lineitem", round_doubles=False)
def q_hash_split(spark, d):
    """M4: md5-bucket 80/20 split of the line key."""
    li = tbl(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return model.hash_split(li, ["l_orderkey", "l_linenumber"], 0.8)


@query("hash_split_fine", f"SELECT l_orderkey, l_linenumber, {SPLIT_KEY_SQL.replace('214748365', '267093279')} "
       "AS is_train FROM lineitem", round_doubles=False)
def q_hash_split_fine(spark, d):
    """M4: a split at 99.5 percent."""
    li = tbl(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return model.hash_split(li, ["l_orderkey", "l_linenumber"], 0.995)


@query("split_sizes", f"""
WITH s AS (SELECT {SPLIT_KEY_SQL} AS t FROM lineitem)
SELECT CAST(count(*) FILTER (WHERE t) AS BIGINT) AS train_rows,
       CAST(count(*) FILTER (WHERE NOT t) AS BIGINT) AS test_rows,
       CAST(count(*) AS BIGINT) AS total_rows,
       {sql_sig('count(*) FILTER (WHERE t) * 100.0 / count(*)')} AS train_pct,
       {sql_sig('count(*) FILTER (WHERE NOT t) * 100.0 / count(*)')} AS test_pct
FROM s""")
def q_split_sizes(spark, d):
    """Train / test / total counts and shares."""
    li = tbl(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return model.split_sizes(model.hash_split(li, ["l_orderkey", "l_linenumber"], 0.8))


# fitted statistics are rounded to 12 significant digits on both sides, so
# both engines apply identical doubles and z / probabilities agree bit for bit
ZSTATS_SQL = f"""s AS (SELECT l_orderkey, l_linenumber, {", ".join(Z_COLS)}, {SPLIT_KEY_SQL} AS is_train FROM lineitem),
st AS (SELECT {", ".join(f"{sql_sig(f'avg({c})')} AS m_{c}, {sql_sig(f'stddev_samp({c})')} AS s_{c}" for c in Z_COLS)}
       FROM s WHERE is_train)"""


def _sig_stats(st: dict) -> dict:
    return {c: tuple(sig_py(v) for v in ms) for c, ms in st.items()}


@query("zscore", f"""
WITH {ZSTATS_SQL}
SELECT l_orderkey, l_linenumber, is_train,
       {", ".join(f"{sql_sig(sql_unit(f'CASE WHEN s_{c} = 0 THEN 0.0 ELSE ({c} - m_{c}) / s_{c} END'))} AS {c}_z" for c in Z_COLS)}
FROM s, st""")
def q_zscore(spark, d):
    """M3: z-scores with mean / sample std of the training rows only."""
    li = tbl(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *Z_COLS)
    flagged = model.hash_split(li, ["l_orderkey", "l_linenumber"], 0.8)
    st = _sig_stats(encode.zscore_fit(flagged.where("is_train"), Z_COLS))
    out = encode.zscore_apply(flagged, st).select("l_orderkey", "l_linenumber", "is_train",
                                                  *[c + "_z" for c in Z_COLS])
    return unit_round(out, [c + "_z" for c in Z_COLS])


# Fixed weights of the scoring fixture (position order = Z_COLS) and intercept.
SCORE_WEIGHTS = (0.8, -0.5, 1.2, -0.3)
SCORE_INTERCEPT = -0.1


@query("score_batch", f"""
WITH {ZSTATS_SQL},
z AS (SELECT l_orderkey, l_linenumber, {SCORE_INTERCEPT} + {" + ".join(
    f"{w} * (({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END)" for w, c in zip(SCORE_WEIGHTS, Z_COLS))} AS z
      FROM s, st),
p AS (SELECT *, 1.0 / (1.0 + exp(-z)) AS probability FROM z)
SELECT l_orderkey, l_linenumber, {sql_sig(sql_unit('z'))} AS z, {sql_sig(sql_unit('probability'))} AS probability,
       CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS prediction,
       CASE WHEN probability >= 0.5 THEN 'severe (severity 3-4)' ELSE 'minor (severity 1-2)' END AS caption
FROM p""")
def q_score_batch(spark, d):
    """Scoring from a coefficient table (weights + training mean / std)."""
    li = tbl(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *Z_COLS)
    flagged = model.hash_split(li, ["l_orderkey", "l_linenumber"], 0.8)
    st = _sig_stats(encode.zscore_fit(flagged.where("is_train"), Z_COLS))
    rows = [(i, c, w, st[c][0], st[c][1]) for i, (w, c) in enumerate(zip(SCORE_WEIGHTS, Z_COLS))]
    rows.append((-1, "(intercept)", SCORE_INTERCEPT, 0.0, 1.0))
    coefs = spark.createDataFrame(rows, "position int, feature string, coefficient double, mean double, std double")
    out = score.score_batch(li, coefs).select("l_orderkey", "l_linenumber", "z", "probability",
                                              "prediction", "caption")
    return unit_round(out, ("z", "probability"))


# Fixed category map of the lookup fixture; other values fall back to 0.0.
EVENT_TYPE_MAP = {"click": 1.0, "purchase": 2.0, "view": 3.0}


@query("category_lookup", """
WITH m AS (SELECT * FROM (VALUES ('click', 1.0), ('purchase', 2.0), ('view', 3.0)) v(value, idx))
SELECT e.event_id, e.event_type, CAST(coalesce(m.idx, 0.0) AS DOUBLE) AS event_type_idx
FROM events e LEFT JOIN m ON e.event_type = m.value""", round_doubles=False)
def q_category_lookup(spark, d):
    """Category -> index through a broadcast map; unknown -> 0.0."""
    e = tbl(spark, d, "events").select("event_id", "event_type")
    return encode.category_lookup(e, "event_type", EVENT_TYPE_MAP)


@query("category_lookup_fitted", """
WITH f AS (SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY event_type),
r AS (SELECT event_type, CAST(row_number() OVER (ORDER BY n DESC, event_type) - 1 AS DOUBLE) AS idx FROM f)
SELECT o.o_orderkey, o.o_orderstatus, CAST(coalesce(r.idx, 0.0) AS DOUBLE) AS o_orderstatus_idx
FROM orders o LEFT JOIN r ON o.o_orderstatus = r.event_type""", round_doubles=False)
def q_category_lookup_fitted(spark, d):
    """M1 map saved as a table (S5) and applied with a size-checked broadcast join."""
    m = encode.fit_string_index(tbl(spark, d, "events"), ["event_type"])
    mapping = encode.index_table(spark, m).select("value", "idx")
    o = tbl(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return encode.category_lookup(o, "o_orderstatus", mapping)


@query("category_lookup_known", """
WITH f AS (SELECT event_type, count(*) AS n FROM events WHERE event_type IN ('error', 'click', 'view') GROUP BY 1),
r AS (SELECT event_type, CAST(row_number() OVER (ORDER BY n DESC, event_type) - 1 AS DOUBLE) AS idx FROM f)
SELECT e.event_id, e.event_type, CAST(coalesce(r.idx, 0.0) AS DOUBLE) AS event_type_idx
FROM events e LEFT JOIN r ON e.event_type = r.event_type""", round_doubles=False)
def q_category_lookup_known(spark, d):
    """M1 map of some event types applied to all events (M11): known and unknown values."""
    e = tbl(spark, d, "events").select("event_id", "event_type")
    m = encode.fit_string_index(e.where(F.col("event_type").isin("error", "click", "view")), ["event_type"])
    return encode.category_lookup(e, "event_type", encode.index_table(spark, m))


@query("parse_reject", """
WITH e AS (SELECT event_id, CASE WHEN event_type = 'error' THEN props ELSE CAST(value AS VARCHAR) END AS raw
           FROM events)
SELECT event_id, TRY_CAST(trim(raw) AS DOUBLE) AS raw_num,
       (raw IS NOT NULL AND TRY_CAST(trim(raw) AS DOUBLE) IS NULL) AS rejected
FROM e""", round_doubles=False)
def q_parse_reject(spark, d):
    """Text -> double with a reject flag instead of a failed job."""
    e = tbl(spark, d, "events").select(
        "event_id", F.when(F.col("event_type") == "error", F.col("props"))
        .otherwise(F.col("value").cast("string")).alias("raw"))
    return encode.parse_numeric(e, ["raw"]).select("event_id", "raw_num", "rejected")


# =====================================================================
# Step 5 - training (not expressible in static SQL: rows-only checks)
# =====================================================================

TRAIN_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _train_lineitem(spark, d):
    li = tbl(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", *TRAIN_FEATURES,
        (F.col("l_returnflag") == "R").cast("int").alias("label"))
    return model.train_model(li, TRAIN_FEATURES, "label", ["l_orderkey", "l_linenumber"], 0.8,
                             max_iter=50, reg_param=0.01, elastic_net=0.0)


@query("train_score")
def q_train_score(spark, d):
    """M2-M6: pipeline fitted on the training rows, test rows scored."""
    fitted, _, test = _train_lineitem(spark, d)
    return model.predict(fitted, test).select("l_orderkey", "l_linenumber", "label", "p1", "prediction")


@query("feature_importance")
def q_feature_importance(spark, d):
    """M7 + O2: coefficient table ranked by absolute weight."""
    fitted, _, _ = _train_lineitem(spark, d)
    return model.feature_importance(model.coefficient_table(fitted, TRAIN_FEATURES))


@query("auc_mllib_binned")
def q_auc_mllib_binned(spark, d):
    """A16 as the original reports it: MLlib's 1000-bin down-sampled AUC of the test rows."""
    fitted, _, test = _train_lineitem(spark, d)
    v = evaluate.auc_binned(model.predict(fitted, test), "label")
    return spark.createDataFrame([(float(v),)], "auc_roc_binned double")


# =====================================================================
# Step 6 - documented customer features
# =====================================================================

@query("txn_clean", """
SELECT l_orderkey AS invoice, l_partkey AS item, l_quantity AS quantity, l_extendedprice AS price,
       CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS invoice_ts
FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL AND l_quantity IS NOT NULL AND NOT isnan(l_quantity)
  AND l_extendedprice IS NOT NULL AND NOT isnan(l_extendedprice) AND l_shipdate IS NOT NULL
  AND l_quantity > 0 AND l_extendedprice > 0""", round_doubles=False)
def q_txn_clean(spark, d):
    """D1 + D2: transactions with all keys present, positive quantity / price, parsed date."""
    li = tbl(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("invoice"), F.col("l_partkey").alias("item"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("invoice_date"))
    return clean.txn_clean(li, "invoice", "item", "quantity", "price", "invoice_date", "yyyy-MM-dd")


@query("rfm", f"""
WITH m AS (SELECT max(o_orderdate) AS md FROM orders)
SELECT o_custkey, CAST(date_diff('day', max(o_orderdate), any_value(md)) AS BIGINT) AS recency_days,
       CAST(count(DISTINCT o_orderkey) AS BIGINT) AS frequency, {sql_sig('sum(o_totalprice)')} AS monetary,
       CAST(date_diff('day', min(o_orderdate), max(o_orderdate)) AS BIGINT) AS lifespan_days,
       {sql_sig('sum(o_totalprice) / count(DISTINCT o_orderkey)')} AS avg_order_value
FROM orders, m GROUP BY o_custkey""")
def q_rfm(spark, d):
    """D3: recency, frequency, monetary, life span, average order value per customer."""
    return features.rfm(tbl(spark, d, "orders"), "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


QF_SQL = """qf AS (
  SELECT o_custkey, CAST(year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS BIGINT) AS quarter_idx,
         sum(o_totalprice) AS amt, count(DISTINCT o_orderkey) AS n
  FROM orders GROUP BY 1, 2),
qf2 AS (SELECT o_custkey, quarter_idx, CAST(quarter_idx // 4 AS BIGINT) AS year,
               CAST(quarter_idx % 4 + 1 AS INTEGER) AS quarter, amt AS quarter_amount,
               CAST(n AS BIGINT) AS quarter_frequency, amt / n AS quarter_avg_value FROM qf)"""
QF_COLS_SQL = (f"o_custkey, quarter_idx, year, quarter, {sql_sig('quarter_amount')} AS quarter_amount, "
               f"quarter_frequency, {sql_sig('quarter_avg_value')} AS quarter_avg_value")
TREND_SQL = """qt AS (SELECT *, CAST(CASE WHEN lag(quarter_idx) OVER w = quarter_idx - 1
                  THEN sign(quarter_amount - lag(quarter_amount) OVER w) ELSE 0 END AS INTEGER) AS purchase_trend,
                 CASE WHEN lead(quarter_idx) OVER w = quarter_idx + 1 THEN 1 ELSE 0 END AS label
           FROM qf2 WINDOW w AS (PARTITION BY o_custkey ORDER BY quarter_idx))"""


@query("quarter_features", f"WITH {QF_SQL} SELECT {QF_COLS_SQL} FROM qf2")
def q_quarter_features(spark, d):
    """Amount, orders and average value per customer quarter."""
    return features.quarter_features(tbl(spark, d, "orders"), "o_custkey", "o_orderkey",
                                     "o_orderdate", "o_totalprice")


@query("quarter_trend", f"WITH {QF_SQL}, {TREND_SQL} SELECT {QF_COLS_SQL}, purchase_trend FROM qt")
def q_quarter_trend(spark, d):
    """Sign of the change against the adjacent previous quarter."""
    qf = features.quarter_features(tbl(spark, d, "orders"), "o_custkey", "o_orderkey",
                                   "o_orderdate", "o_totalprice")
    return features.quarter_trend(qf, "o_custkey")


@query("next_quarter_label", f"""WITH {QF_SQL}, {TREND_SQL}
SELECT {QF_COLS_SQL}, purchase_trend, label FROM qt
WHERE quarter_idx < (SELECT max(quarter_idx) FROM qf2)""")
def q_next_quarter_label(spark, d):
    """1 when the customer buys in the next quarter; last quarter dropped."""
    return features.customer_quarter_table(tbl(spark, d, "orders"), "o_custkey", "o_orderkey",
                                           "o_orderdate", "o_totalprice")


QSTAT_FEATURES = ("quarter_amount", "quarter_frequency", "quarter_avg_value", "purchase_trend")


@query("quarter_stats", _column_stats_sql(
    f"WITH {QF_SQL}, {TREND_SQL}, lab AS (SELECT * FROM qt WHERE quarter_idx < (SELECT max(quarter_idx) FROM qf2)) "
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM lab" for c in QSTAT_FEATURES)))
def q_quarter_stats(spark, d):
    """Statistics of the customer-quarter features."""
    t = features.customer_quarter_table(tbl(spark, d, "orders"), "o_custkey", "o_orderkey",
                                        "o_orderdate", "o_totalprice")
    return unit_round(stats.column_stats(t, list(QSTAT_FEATURES), cache=True), ("Skewness", "Kurtosis"))


@query("latest_quarters", f"""WITH {QF_SQL}, {TREND_SQL}
SELECT {QF_COLS_SQL}, purchase_trend FROM qt
WHERE quarter_idx = (SELECT max(quarter_idx) FROM qf2 m WHERE m.o_custkey = qt.o_custkey)""")
def q_latest_quarters(spark, d):
    """D7 input: every customer's last observed quarter."""
    return features.latest_quarter_rows(tbl(spark, d, "orders"), "o_custkey", "o_orderkey",
                                        "o_orderdate", "o_totalprice")


@query("quarter_label_distribution", f"""WITH {QF_SQL}, {TREND_SQL}
SELECT label, count(*) AS count FROM qt WHERE quarter_idx < (SELECT max(quarter_idx) FROM qf2)
GROUP BY label ORDER BY label""")
def q_quarter_label_distribution(spark, d):
    """Next-quarter label distribution."""
    t = features.customer_quarter_table(tbl(spark, d, "orders"), "o_custkey", "o_orderkey",
                                        "o_orderdate", "o_totalprice")
    return stats.distribution(t, "label")


@query("train_score_quarter")
def q_train_score_quarter(spark, d):
    """Probability that a customer buys next quarter (trained on customer quarters)."""
    t = features.customer_quarter_table(tbl(spark, d, "orders"), "o_custkey", "o_orderkey",
                                        "o_orderdate", "o_totalprice")
    feats = ["quarter_amount", "quarter_frequency", "quarter_avg_value", "purchase_trend"]
    fitted, _, test = model.train_model(t, feats, "label", ["o_custkey", "quarter_idx"], 0.8)
    return model.predict(fitted, test).select("o_custkey", "quarter_idx", "label", "p1", "prediction")


@query("next_quarter_scores")
def q_next_quarter_scores(spark, d):
    """Model trained on labelled customer quarters scores every customer's
    last observed quarter: probability of buying in the (unseen) next quarter."""
    o = tbl(spark, d, "orders")
    t = features.customer_quarter_table(o, "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    feats = ["quarter_amount", "quarter_frequency", "quarter_avg_value", "purchase_trend"]
    fitted, _, _ = model.train_model(t, feats, "label", ["o_custkey", "quarter_idx"], 0.8)
    latest = features.latest_quarter_rows(o, "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return model.predict(fitted, latest).select("o_custkey", "quarter_idx", F.col("p1").alias("p_next_quarter"))


# =====================================================================
# Step 7 - sources and sinks
# =====================================================================

@query("scan_csv_roundtrip", "SELECT * FROM orders", round_doubles=False)
def q_scan_csv_roundtrip(spark, d):
    """Orders written as a CSV directory, read back with its schema."""
    o = tbl(spark, d, "orders")
    path = files.write_table(o, scratch_dir(spark, "orders-csv"), fmt="csv")
    return files.read_table(spark, path, "csv", o.schema)


@query("scan_csv_by_name", """SELECT o_totalprice, o_orderkey, o_orderpriority, o_orderdate FROM orders""", round_doubles=False)
def q_scan_csv_by_name(spark, d):
    """A CSV whose columns stand in another order, with more columns and padded names."""
    o = tbl(spark, d, "orders")
    wanted = o.select("o_totalprice", "o_orderkey", "o_orderpriority", "o_orderdate").schema
    mixed = o.select(F.lit("x").alias("note"), F.col("o_orderpriority").alias(" o_orderpriority"), "o_custkey",
                     F.col("o_orderkey").alias("o_orderkey "), "o_orderdate", "o_totalprice")
    path = files.write_table(mixed, scratch_dir(spark, "orders-mixed"), fmt="csv")
    return files.read_csv(spark, path, wanted)


@query("sink_report", f"""
WITH {LABELLED_SQL}
SELECT severity, count(*) AS count FROM lb GROUP BY severity""")
def q_sink_report(spark, d):
    """S4 + S7: a small report written as one CSV file and read back."""
    dist = stats.severity_distribution(_labelled_orders(spark, d), "severity")
    path = reports.write_report(dist, scratch_dir(spark, "severity-report"))
    return reports.read_report(spark, path, "severity int, count bigint")


# =====================================================================
# End-to-end job on the incident table (lineitem x orders)
# =====================================================================

def _incident_not_null():
    cols = ("l_orderkey", "l_linenumber", "Severity", "Start_Time") + INCIDENT_MEASURES + (
        "l_returnflag", "l_linestatus")
    return _not_null_sql(cols, INCIDENT_MEASURES)


@query("incident_prepare", f"""
WITH j AS (
  SELECT l_orderkey, l_linenumber, {SEVERITY_SQL} AS Severity, o_orderdate AS Start_Time,
         {", ".join(INCIDENT_MEASURES)}, l_returnflag, l_linestatus
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
c AS (SELECT DISTINCT * FROM j WHERE {_incident_not_null()})
SELECT *, CAST(hour(Start_Time) AS INTEGER) AS Hour, CAST(dayofweek(Start_Time) + 1 AS INTEGER) AS Weekday,
       CAST(month(Start_Time) AS INTEGER) AS Month, CASE WHEN Severity >= 3 THEN 1 ELSE 0 END AS label
FROM c""", round_doubles=False)
def q_incident_prepare(spark, d):
    """E1 over a join: clean, time features and label of the incident table."""
    return pipeline.prepare(incidents(spark, d), INCIDENT_SPEC)


@query("incident_column_stats", _column_stats_sql(
    f"""WITH j AS (SELECT DISTINCT l_orderkey, l_linenumber, {SEVERITY_SQL} AS Severity, o_orderdate AS Start_Time,
         {", ".join(INCIDENT_MEASURES)}, l_returnflag, l_linestatus
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
c AS (SELECT *, CAST(hour(Start_Time) AS INTEGER) AS Hour, CAST(dayofweek(Start_Time) + 1 AS INTEGER) AS Weekday,
        CAST(month(Start_Time) AS INTEGER) AS Month FROM j WHERE {_incident_not_null()}) """
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM c"
                         for c in ("l_orderkey", "l_linenumber") + INCIDENT_MEASURES + ("Hour", "Weekday", "Month"))))
def q_incident_column_stats(spark, d):
    """A7 on the prepared incident table: every numeric column but target and label."""
    prep = pipeline.prepare(incidents(spark, d), INCIDENT_SPEC)
    feats = [c for c in numeric_columns(prep, ("Severity", "label"))]
    return unit_round(stats.column_stats(prep, feats, cache=True), ("Skewness", "Kurtosis"))


@query("pipeline_metrics")
def q_pipeline_metrics(spark, d):
    """The whole job (prepare, describe, train, evaluate) -> 16-row report."""
    return pipeline.run_pipeline(spark, INCIDENT_SPEC, incidents(spark, d)).metrics


# =====================================================================
# Streaming ingest (S8) over file drops made from the orders table
# =====================================================================

@query("stream_severity_counts", f"""
WITH {LABELLED_SQL}
SELECT severity AS Severity, count(*) AS count FROM lb GROUP BY severity""")
def q_stream_severity_counts(spark, d):
    """Orders land as CSV file drops; a file-source stream cleans them and
    maintains the severity distribution (state bounded by the number of levels)."""
    from pyspark.sql import types as T

    from ..spec import PipelineSpec
    from ..streaming.ingest import incident_stream, start_severity_counts
    landing = scratch_dir(spark, "landing")
    o = tbl(spark, d, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("Severity"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("Start_Time"), "o_totalprice")
    o.repartition(4).write.option("header", True).csv(landing)          # four file drops
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("Severity", T.IntegerType()),
                           T.StructField("Start_Time", T.StringType()),
                           T.StructField("o_totalprice", T.DoubleType())])
    spec = PipelineSpec(keep_columns=("o_orderkey", "Severity", "Start_Time", "o_totalprice"))
    stream = incident_stream(spark, landing, schema, spec, max_files_per_trigger=2)   # two micro-batches
    report = scratch_dir(spark, "stream-severity")
    q = start_severity_counts(stream, "Severity", report, scratch_dir(spark, "stream-ckpt"))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return reports.read_report(spark, report, "Severity int, count bigint")
