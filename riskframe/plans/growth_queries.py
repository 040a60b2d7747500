"""Registered queries of the growing-table and checked-training features: history-wide
dedupe, incremental reports, maintained quarters, atomic publication, mixed headers, outlier
points, distributed index, certified training and AUC bounds. Registered by import."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import certify, encode, evaluate, features, model, partials, score, stats
from ..session import scratch_dir
from ..sources import files, publish
from ..spec import PipelineSpec
from .incidents import SCORED_SQL, scored_orders
from .queries import (LABELLED_SQL, QF_COLS_SQL, QF_SQL, QSTAT_FEATURES, SEVERITY_SQL, SPLIT_KEY_SQL, TRAIN_FEATURES,
                      TREND_SQL, _labelled_orders, query, tbl)
from .rounding import sig, sql_sig, sql_unit, unit, unit_round

# =====================================================================
# Dedupe over the whole history, incremental reports
# =====================================================================


def _order_lines(spark, d):
    return tbl(spark, d, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("Severity"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("Start_Time"), "o_totalprice")


@query("history_dedupe", f"""
SELECT o_orderkey, {SEVERITY_SQL} AS Severity, o_totalprice, CAST(hour(o_orderdate) AS INTEGER) AS Hour,
       CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS Weekday, CAST(month(o_orderdate) AS INTEGER) AS Month,
       CASE WHEN {SEVERITY_SQL} >= 3 THEN 1 ELSE 0 END AS label
FROM orders""", round_doubles=False)
def q_history_dedupe(spark, d):
    """P3 + S8: file drops with the same rows in several of them, one batch each: every row of
    the history is stored once, whenever it comes again."""
    from ..streaming.incremental import IncrementalJob
    from ..streaming.ingest import incident_stream
    o = _order_lines(spark, d)
    landing = scratch_dir(spark, "drops")
    third = F.pmod("o_orderkey", F.lit(3))
    drops = [o.where(third == 0), o.where((third == 1) | (F.col("o_orderkey") % 6 == 0)),
             o.where((third == 2) | (third == 0)), o.where(third == 1)]
    for part in drops:
        part.coalesce(1).write.mode("append").option("header", True).csv(landing)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("Severity", T.IntegerType()),
                           T.StructField("Start_Time", T.StringType()), T.StructField("o_totalprice", T.DoubleType())])
    spec = PipelineSpec(keep_columns=("o_orderkey", "Severity", "Start_Time", "o_totalprice"))
    stream = incident_stream(spark, landing, schema, spec, max_files_per_trigger=1, dedupe_within=None)
    job = IncrementalJob(spark, scratch_dir(spark, "history"), ["o_totalprice"], publish_each=False)
    run = job.start(stream, scratch_dir(spark, "history-ckpt"))
    run.awaitTermination()
    if run.exception() is not None:
        raise RuntimeError(str(run.exception()))
    return job.rows().select("o_orderkey", "Severity", "o_totalprice", "Hour", "Weekday", "Month", "label")


MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
MOMENTS_SQL = " UNION ALL ".join(f"""
SELECT '{c}' AS Feature, count({c}) AS Count, {sql_sig(f'avg({c})')} AS Mean, {sql_sig(f'stddev_samp({c})')} AS Std,
       {sql_sig(f'min({c})')} AS Min, {sql_sig(f'max({c})')} AS Max, {sql_sig(sql_unit(f'''
         (count({c}) * sum(pow({c} - m_{c}, 3)) / pow(sum(pow({c} - m_{c}, 2)), 1.5)) / sqrt(count({c}))'''))} AS Skewness,
       {sql_sig(sql_unit(f'''count({c}) * sum(pow({c} - m_{c}, 4)) / pow(sum(pow({c} - m_{c}, 2)), 2) - 3'''))} AS Kurtosis
FROM lineitem, (SELECT avg({c}) AS m_{c} FROM lineitem)""" for c in MEASURES)


@query("incremental_column_stats", MOMENTS_SQL)
def q_incremental_column_stats(spark, d):
    """S8 + A5: statistics after five batches, some rows in two of them, from merged states; a
    batch reads its own rows, the ledger and one state."""
    from ..streaming.incremental import IncrementalJob
    li = tbl(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *MEASURES)
    job = IncrementalJob(spark, scratch_dir(spark, "growing"), MEASURES, publish_each=False)
    fifth = F.pmod("l_orderkey", F.lit(5))
    for k in range(5):
        job.apply(li.where((fifth == k) | (fifth == F.lit((k + 3) % 5))), k)
    job.publish()
    out = job.published().read("column_statistics").drop("Q1", "Median", "Q3")
    return unit_round(out, ("Skewness", "Kurtosis"))


FIRST_DROP = "o_orderkey % 4 = 0"


@query("incremental_histogram", f"""
WITH e AS (SELECT min(o_totalprice) AS a, max(o_totalprice) AS z FROM orders WHERE {FIRST_DROP}),
c AS (SELECT CASE WHEN o_totalprice < a THEN -1 WHEN o_totalprice > z THEN 30 ELSE
        (SELECT max(i) FROM range(30) r(i) WHERE o_totalprice >= i * ((z - a) / 30.0) + a) END AS bin FROM orders, e)
SELECT CAST(g.bin AS INTEGER) AS bin, count(c.bin) AS count FROM range(-1, 31) g(bin) LEFT JOIN c ON c.bin = g.bin
GROUP BY g.bin""")
def q_incremental_histogram(spark, d):
    """Histogram cells added up batch by batch, in the ranges of the first batch."""
    o = tbl(spark, d, "orders").select("o_orderkey", "o_totalprice")
    state, edges = None, None
    for k in range(4):
        rows = o.where(F.col("o_orderkey") % 4 == k)
        new = []
        if edges is None:
            new = [partials.edges_state(partials.moments_state(rows, ["o_totalprice"]), 30)]
            edges = partials.edges_of(new[0])
        new.append(partials.cells_state(rows, edges))
        state = partials.merge_states(*new, *([state] if state is not None else []))
    return partials.histogram_cells(state).select("bin", "count")


@query("incremental_evaluation", f"""
WITH {SCORED_SQL},
c AS (SELECT CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) AS tp,
             CAST(count(*) FILTER (WHERE label = 0 AND prediction = 0) AS DOUBLE) AS tn,
             CAST(count(*) FILTER (WHERE label = 0 AND prediction = 1) AS DOUBLE) AS fp,
             CAST(count(*) FILTER (WHERE label = 1 AND prediction = 0) AS DOUBLE) AS fn,
             avg((p1 - label) * (p1 - label)) AS brier,
             -avg(label * ln(p1 + 1e-15) + (1 - label) * ln(1.0 - p1 + 1e-15)) AS log_loss FROM sp),
b AS (SELECT least(floor(p1 * 1000), 999) AS bin, CAST(sum(label) AS DOUBLE) AS pos,
             CAST(sum(1 - label) AS DOUBLE) AS neg FROM sp GROUP BY 1),
w AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM b),
a AS (SELECT sum(pos * below) AS won, sum(pos * neg) AS open, sum(pos) * sum(neg) AS pairs FROM w)
SELECT tp, tn, fp, fn, {sql_sig(sql_unit('brier'))} AS brier, {sql_sig(sql_unit('log_loss'))} AS log_loss,
       {sql_sig(sql_unit('(tp + tn) / (tp + tn + fp + fn)'))} AS accuracy,
       {sql_sig(sql_unit('won / pairs'))} AS auc_lower, {sql_sig(sql_unit('(won + open) / pairs'))} AS auc_upper
FROM c, a""")
def q_incremental_evaluation(spark, d):
    """S8 + A12-A18: outcome cells, losses and score bins of four batches, merged."""
    s = scored_orders(spark, d)
    state = None
    for k in range(4):
        new = partials.evaluation_state(s.where(F.col("o_orderkey") % 4 == k))
        state = new if state is None else partials.merge_states(state, new)
    out = partials.evaluation(state).select("tp", "tn", "fp", "fn", "brier", "log_loss", "accuracy", "auc_lower",
                                            "auc_upper")
    return unit_round(out, ("brier", "log_loss", "accuracy", "auc_lower", "auc_upper"))


SKETCH_PROBS = (0.05, 0.25, 0.5, 0.75, 0.95)
SKETCH_ERROR = 0.01


@query("sketch_rank_error", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({p} AS DOUBLE) AS prob, true AS within" for c in MEASURES for p in SKETCH_PROBS))
def q_sketch_rank_error(spark, d):
    """Quantiles answered from sketches stored per batch and merged, checked against the
    exact ranks of their answers (share of rows below, and not above) over all rows."""
    li = tbl(spark, d, "lineitem").select("l_orderkey", *MEASURES)
    state = partials.merge_states(*[partials.moments_state(li.where(F.col("l_orderkey") % 3 == k), MEASURES)
                                    for k in range(3)])
    got = partials.sketch_quantiles(state, SKETCH_PROBS).collect()
    n = {r["feature"]: r["n"] for r in state.where("kind = 'moments'").select("feature", "n").collect()}
    ranks = li.agg(*[f for i, r in enumerate(got) for f in (
        F.count(F.when(F.col(r["feature"]) < r["value"], 1)).alias(f"b{i}"),
        F.count(F.when(F.col(r["feature"]) <= r["value"], 1)).alias(f"a{i}"))]).first()
    rows = [(r["feature"], r["prob"], ranks[f"b{i}"] / n[r["feature"]] - SKETCH_ERROR <= r["prob"]
             <= ranks[f"a{i}"] / n[r["feature"]] + SKETCH_ERROR) for i, r in enumerate(got)]
    return spark.createDataFrame(rows, "feature string, prob double, within boolean")


@query("quarters_maintained", f"""WITH {QF_SQL}, {TREND_SQL}
SELECT {QF_COLS_SQL}, purchase_trend, label FROM qt WHERE quarter_idx < (SELECT max(quarter_idx) FROM qf2)""")
def q_quarters_maintained(spark, d):
    """D4-D6 under late and corrected orders: batches out of time order, some orders first with
    a wrong amount or under another customer and corrected later."""
    from ..streaming.quarters import QuarterTable
    o = tbl(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    third = F.pmod(F.xxhash64("o_orderkey"), F.lit(3))
    wrong = o.where((third == 1) & (F.col("o_orderkey") % 5 == 0))
    t = QuarterTable(spark, scratch_dir(spark, "quarters"), ("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"))
    t.apply(o.where(third == 2).unionByName(wrong.withColumn("o_totalprice", F.col("o_totalprice") * 2)
                                            .withColumn("o_custkey", F.col("o_custkey") + F.col("o_orderkey") % 2)), 0)
    t.apply(o.where(third == 0), 1)
    t.apply(o.where(third == 1), 2)
    return t.labelled().withColumnRenamed("customer", "o_custkey")


# =====================================================================
# Sources and sinks
# =====================================================================

@query("scan_csv_mixed_headers", """
SELECT o_orderkey, o_totalprice, o_orderpriority, CASE WHEN o_orderkey % 3 = 2 THEN o_custkey END AS o_custkey
FROM orders""", round_doubles=False)
def q_scan_csv_mixed_headers(spark, d):
    """One folder whose part files have three headers: other orders, padding, a further
    column, a column that only some have."""
    o = tbl(spark, d, "orders")
    wanted = o.select("o_orderkey", "o_totalprice", "o_orderpriority", "o_custkey").schema
    folder = scratch_dir(spark, "orders-mixed-headers")
    layouts = (["o_orderkey", "o_totalprice", "o_orderpriority"],
               [F.col("o_orderpriority").alias(" o_orderpriority "), F.lit("x").alias("note"), "o_orderkey", "o_totalprice"],
               ["o_custkey", "o_totalprice", "o_orderkey", "o_orderpriority"])
    for k, cols in enumerate(layouts):
        o.where(F.col("o_orderkey") % 3 == k).select(*cols).write.mode("append").option("header", True).csv(folder)
    return files.read_csv(spark, folder, wanted)


@query("published_reports", f"""
WITH {LABELLED_SQL} SELECT severity, count(*) AS count FROM lb GROUP BY severity""")
def q_published_reports(spark, d):
    """A table and a report published as one set and read back through it, while a
    later, unfinished run lies beside it."""
    rows = _labelled_orders(spark, d)
    run = publish.Run(spark, scratch_dir(spark, "published"))
    run.table(rows, "rows")
    run.report(stats.severity_distribution(rows, "severity"), "severity")
    run.commit()
    torn = publish.Run(spark, run.base)
    torn.report(stats.severity_distribution(rows.limit(1), "severity"), "severity")     # never committed
    now = publish.Published(spark, run.base)
    if now.verify() or now.read("rows").count() != rows.count():
        raise RuntimeError("the published set is not what was written")
    return now.read("severity")


# =====================================================================
# Outlier points, index without the driver, AUC bounds
# =====================================================================

TAILED = "CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END * pow(o_totalprice / 100000.0, 3)"


@query("boxplot_outliers", f"""
WITH v AS (SELECT o_orderkey, o_orderstatus, {TAILED} AS x FROM orders),
q AS (SELECT o_orderstatus, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM v GROUP BY 1)
SELECT o_orderstatus, o_orderkey, {sql_sig('x')} AS value,
       CASE WHEN x < q1 - 1.5 * (q3 - q1) THEN 'low' ELSE 'high' END AS side
FROM v JOIN q USING (o_orderstatus) WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)""")
def q_boxplot_outliers(spark, d):
    """A10: the outlying rows themselves, by group, on both sides."""
    o = tbl(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.expr(TAILED).alias("x"))
    return stats.boxplot_outliers(o, "x", "o_orderstatus", ["o_orderkey"])


@query("string_index_any", """
WITH l AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS part,
                  CASE WHEN l_linenumber < 7 THEN concat(l_orderkey, '-', l_linenumber) END AS line FROM lineitem),
p AS (SELECT part, CAST(row_number() OVER (ORDER BY count(*) DESC, part) - 1 AS DOUBLE) AS part_idx FROM l GROUP BY part),
u AS (SELECT line, CAST(row_number() OVER (ORDER BY count(*) DESC, line) - 1 AS DOUBLE) AS line_idx
      FROM l WHERE line IS NOT NULL GROUP BY line)
SELECT l_orderkey, l_linenumber, part_idx,
       coalesce(line_idx, (SELECT CAST(count(*) AS DOUBLE) FROM u)) AS line_idx
FROM l JOIN p USING (part) LEFT JOIN u USING (line)""", round_doubles=False)
def q_string_index_any(spark, d):
    """M1: a column of many values and one of as many values as rows (nulls among them)."""
    li = tbl(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"),
        F.when(F.col("l_linenumber") < 7, F.concat_ws("-", "l_orderkey", "l_linenumber")).alias("line"))
    return encode.string_index_any(li, ["part", "line"]).select("l_orderkey", "l_linenumber", "part_idx", "line_idx")


@query("auc_certified", f"""
WITH {SCORED_SQL},
g AS (SELECT p1, sum(label) AS pos, sum(1 - label) AS neg FROM sp GROUP BY p1),
w AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY p1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT {sql_sig(sql_unit('CAST(sum(pos * (below + 0.5 * neg)) AS DOUBLE) / (sum(pos) * sum(neg))'))} AS auc_roc,
       true AS enclosed, true AS narrow FROM w""")
def q_auc_certified(spark, d):
    """Bounds from refined score bins around the exact AUC, at most 1e-6 apart."""
    s = scored_orders(spark, d)
    b = evaluate.auc_certified(s, tolerance=1e-6).first()
    exact = evaluate.auc_exact(s)
    v = F.col("auc_roc")
    slack = F.lit(1e-12)                             # rounding of the sums
    return unit_round(exact.select(
        v, ((v >= F.lit(b["auc_lower"]) - slack) & (v <= F.lit(b["auc_upper"]) + slack)).alias("enclosed"),
        F.lit(b["auc_upper"] - b["auc_lower"] <= 1e-6).alias("narrow")), ("auc_roc",))


# =====================================================================
# Training, checked: the SQL twin finds the optimum by Newton steps
# =====================================================================

def _newton_sql(source: str, feats, reg: float = 0.01, steps: int = 9) -> str:
    """CTEs down to ``w``: the optimum (b0..bd-1, bd the intercept) of the regularised logistic
    loss over ``tr`` rows (y and raw features) of ``source``, with ``st`` the scaling."""
    d = len(feats)
    names = range(d + 1)
    z = ", ".join([*(f"CASE WHEN s{j} = 0 THEN 0.0 ELSE (x{j} - m{j}) / s{j} END AS z{j}" for j in range(d)),
                   f"1.0 AS z{d}"])
    out = [f"tr AS MATERIALIZED ({source})",
           "st AS MATERIALIZED (SELECT " + ", ".join(
               f"avg(x{j}) AS m{j}, stddev_samp(x{j}) AS s{j}" for j in range(d)) + " FROM tr)",
           f"z AS MATERIALIZED (SELECT y, {z} FROM tr, st)",
           "w0 AS MATERIALIZED (SELECT " + ", ".join(f"CAST(0 AS DOUBLE) AS b{j}" for j in names) + ")"]
    margin = " + ".join(f"b{j} * z{j}" for j in names)
    for k in range(steps):
        ridge = lambda j: f" + {reg} * any_value(b{j})" if j < d else ""
        diag = lambda i, j: f" + {reg}" if i == j and i < d else ""
        cells = [f"avg((p - y) * z{j}){ridge(j)} AS a{j}_{d + 1}" for j in names]
        cells += [f"avg(p * (1 - p) * z{i} * z{j}){diag(i, j)} AS a{i}_{j}" for i in names for j in names]
        out.append(f"e{k}_0 AS MATERIALIZED (SELECT {', '.join(cells)} FROM (SELECT z.*, w{k}.*, "
                   f"1.0 / (1.0 + exp(-({margin}))) AS p FROM z, w{k}))")
        for c in range(d):                           # elimination below the diagonal
            cols = [f"a{i}_{j}" if i <= c or j <= c else f"a{i}_{j} - a{i}_{c} / a{c}_{c} * a{c}_{j} AS a{i}_{j}"
                    for i in names for j in range(d + 2)]
            out.append(f"e{k}_{c + 1} AS MATERIALIZED (SELECT {', '.join(cols)} FROM e{k}_{c})")
        prev = f"e{k}_{d}"
        for i in reversed(names):                    # back substitution
            rest = "".join(f" - a{i}_{j} * t{j}" for j in range(i + 1, d + 1))
            out.append(f"x{k}_{i} AS MATERIALIZED (SELECT *, (a{i}_{d + 1}{rest}) / a{i}_{i} AS t{i} FROM {prev})")
            prev = f"x{k}_{i}"
        out.append(f"w{k + 1} AS MATERIALIZED (SELECT " + ", ".join(f"b{j} - t{j} AS b{j}" for j in names)
                   + f" FROM w{k}, {prev})")
    out.append(f"w AS MATERIALIZED (SELECT * FROM w{steps})")
    return ",\n".join(out)


def _weights_sql(feats) -> str:
    d = len(feats)
    rows = [f"SELECT {j if j < d else -1} AS position, '{feats[j] if j < d else '(intercept)'}' AS feature, "
            f"{sql_sig(sql_unit(f'b{j}'))} AS coefficient, "
            f"{sql_sig(f'm{j}') if j < d else '0.0'} AS mean, {sql_sig(f's{j}') if j < d else '1.0'} AS std, "
            f"true AS certified FROM w, st" for j in range(d + 1)]
    return " UNION ALL ".join(rows)


SCORE_DIGITS = 6


def _scores_sql(feats, keys: str, rows: str) -> str:
    d = len(feats)
    m = f"b{d} + " + " + ".join(f"b{j} * CASE WHEN s{j} = 0 THEN 0.0 ELSE (x{j} - m{j}) / s{j} END" for j in range(d))
    return (f"SELECT {keys}, floor(1.0 / (1.0 + exp(-({m}))) * 1e{SCORE_DIGITS} + 0.5) / 1e{SCORE_DIGITS} AS p1 "
            f"FROM ({rows}), w, st")


BOUND = 1e-9                    # distance to the optimum at which results are compared
LINE_ROWS = (f"SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS y, "
             + ", ".join(f"CAST({c} AS DOUBLE) AS x{j}" for j, c in enumerate(TRAIN_FEATURES))
             + f", {SPLIT_KEY_SQL} AS is_train FROM lineitem")
LINE_NEWTON = _newton_sql(f"SELECT * FROM ({LINE_ROWS}) WHERE is_train", TRAIN_FEATURES)
QUARTER_SPLIT = SPLIT_KEY_SQL.replace("l_orderkey, l_linenumber", "o_custkey, quarter_idx")
QUARTER_X = ", ".join(f"CAST({c} AS DOUBLE) AS x{j}" for j, c in enumerate(QSTAT_FEATURES))
QUARTER_ROWS = (f"SELECT o_custkey, quarter_idx, CAST(label AS DOUBLE) AS y, {QUARTER_X}, {QUARTER_SPLIT} AS is_train "
                "FROM qt WHERE quarter_idx < (SELECT max(quarter_idx) FROM qf2)")
QUARTER_NEWTON = _newton_sql(f"SELECT * FROM ({QUARTER_ROWS}) WHERE is_train", QSTAT_FEATURES)


def _line_training(spark, d):
    li = tbl(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", *TRAIN_FEATURES, (F.col("l_returnflag") == "R").cast("int").alias("label"))
    return certify.train_certified(li, TRAIN_FEATURES, "label", ["l_orderkey", "l_linenumber"])


def _quarter_training(spark, d):
    t = features.customer_quarter_table(tbl(spark, d, "orders"), "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return certify.train_certified(t, QSTAT_FEATURES, "label", ["o_custkey", "quarter_idx"])


def _certified(weights, bound):
    return weights.select("position", "feature", unit(F.col("coefficient")).alias("coefficient"), "mean", "std",
                          F.lit(bound <= BOUND).alias("certified"))


def _scores(df, weights):
    scale = F.lit(10.0 ** SCORE_DIGITS)
    return score.score_batch(df, weights).withColumn(
        "p1", F.floor(F.col("probability") * scale + F.lit(0.5)) / scale)


@query("train_certificate", f"WITH {LINE_NEWTON}\n{_weights_sql(TRAIN_FEATURES)}")
def q_train_certificate(spark, d):
    """M4-M7: weights with the bound of their distance to the optimum."""
    weights, bound, _, _ = _line_training(spark, d)
    return _certified(weights, bound)


@query("train_certificate_quarter", f"WITH {QF_SQL}, {TREND_SQL}, {QUARTER_NEWTON}\n{_weights_sql(QSTAT_FEATURES)}")
def q_train_certificate_quarter(spark, d):
    """The same for the customer-quarter model."""
    weights, bound, _, _ = _quarter_training(spark, d)
    return _certified(weights, bound)


@query("train_score_certified", f"WITH {LINE_NEWTON}\n" + _scores_sql(
    TRAIN_FEATURES, "l_orderkey, l_linenumber, CAST(y AS INTEGER) AS label", f"SELECT * FROM ({LINE_ROWS}) WHERE NOT is_train"),
       round_doubles=False)
def q_train_score_certified(spark, d):
    """M6: test rows scored at the certified weights."""
    weights, _, _, test = _line_training(spark, d)
    return _scores(test, weights).select("l_orderkey", "l_linenumber", F.col("label").cast("int").alias("label"), "p1")


@query("feature_importance_certified", f"""WITH {LINE_NEWTON}, t AS ({_weights_sql(TRAIN_FEATURES)})
SELECT CAST(row_number() OVER (ORDER BY abs(coefficient) DESC, feature) AS INTEGER) AS rank, feature, coefficient,
       abs(coefficient) AS abs_coefficient FROM t WHERE position >= 0""")
def q_feature_importance_certified(spark, d):
    """O2 + M7: features by absolute certified weight."""
    weights, bound, _, _ = _line_training(spark, d)
    t = _certified(weights, bound)
    return model.feature_importance(t.withColumn("coefficient", sig(F.col("coefficient"))))


@query("next_quarter_scores_certified", f"WITH {QF_SQL}, {TREND_SQL}, {QUARTER_NEWTON}\n" + _scores_sql(
    QSTAT_FEATURES, "o_custkey, quarter_idx",
    f"SELECT o_custkey, quarter_idx, {QUARTER_X} FROM qt WHERE quarter_idx = "
    "(SELECT max(quarter_idx) FROM qf2 m WHERE m.o_custkey = qt.o_custkey)"), round_doubles=False)
def q_next_quarter_scores_certified(spark, d):
    """Every customer's last quarter scored at the certified weights."""
    weights, _, _, _ = _quarter_training(spark, d)
    latest = features.latest_quarter_rows(tbl(spark, d, "orders"), "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return _scores(latest, weights).select("o_custkey", "quarter_idx", "p1")
