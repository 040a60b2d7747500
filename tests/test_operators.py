"""Edge cases and properties of the operators (fixtures built in the test)."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import clean, encode, evaluate, features, model, quantiles, score, stats
from riskframe.operators.cumulative import running_totals


# ------------------------------------------------------------- cleaning ---

def test_binary_label_null_and_text_severity(spark):
    df = spark.createDataFrame([("1",), ("3",), (None,), ("x",), ("4",)], " Severity  string")
    out = features.binary_label(df).orderBy(F.col("Severity").asc_nulls_first()).collect()
    assert [r["label"] for r in out] == [0, 0, 0, 1, 1]
    assert sum(r["Severity"] is None for r in out) == 2


def test_required_column_guard(spark):
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError, match="Severity"):
        features.binary_label(df)


def test_drop_nulls_removes_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)],
                               "v double, s string")
    assert sorted(r["v"] for r in clean.drop_nulls(df).collect()) == [1.0]


def test_drop_nulls_pushes_is_not_null(spark, tmp_dir):
    spark.range(10).withColumn("v", F.col("id") * 1.0).write.parquet(tmp_dir + "/t")
    plan = clean.drop_nulls(spark.read.parquet(tmp_dir + "/t"))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "IsNotNull(v)" in plan


def test_clean_data_tolerant_and_dedupe(spark):
    df = spark.createDataFrame([(1, "a", 9), (1, "a", 8), (None, "b", 7)], "k int, s string, z int")
    out = clean.clean_data(df, ["k", "s", "missing"])
    assert out.columns == ["k", "s"]
    assert out.count() == 1


def test_trim_names(spark):
    df = spark.createDataFrame([(1, 2)], "` a ` int, `b  ` int")
    assert clean.trim_names(df).columns == ["a", "b"]


def test_time_features_bad_string(spark):
    df = spark.createDataFrame([("2022-09-08 05:49:30.000000000",), ("not a time",)], "Start_Time string")
    rows = features.time_features(df).collect()
    assert (rows[0]["Hour"], rows[0]["Weekday"], rows[0]["Month"]) == (5, 5, 9)   # Thursday = 5
    assert rows[1]["Hour"] is None


def test_txn_clean_rejects(spark):
    df = spark.createDataFrame([
        (1, "i", 2.0, 3.0, "2020-01-05"), (2, "i", 0.0, 3.0, "2020-01-05"), (3, "i", 2.0, -1.0, "2020-01-05"),
        (4, None, 2.0, 3.0, "2020-01-05"), (5, "i", 2.0, 3.0, "bad")], "inv int, item string, q double, p double, d string")
    out = clean.txn_clean(df, "inv", "item", "q", "p", "d", "yyyy-MM-dd").collect()
    assert [r["inv"] for r in out] == [1]


# ------------------------------------------------------------ quantiles ---

@pytest.mark.parametrize("final_rows", [4096, 7])
def test_exact_quantiles_match_numpy(spark, final_rows):
    rnd = random.Random(7)
    vals = [float(rnd.choice([1, 2, 2, 3, 5, 8, 13])) if i % 3 else rnd.gauss(0, 1000) for i in range(3000)]
    rows = [(i % 3, v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(5)
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)
    got = quantiles.exact_quantile_values(df, ["v"], probs, ["g"], bins=16, final_rows=final_rows)
    for g in range(3):
        xs = np.array([v for k, v in rows if k == g])
        for p in probs:
            assert got[((g,), "v", p)] == pytest.approx(np.percentile(xs, p * 100), rel=1e-12, abs=1e-9)


def test_approx_quantiles_rank_error(spark):
    df = spark.range(10000).select(F.col("id").cast("double").alias("v"))
    q = {r["prob"]: r["value"] for r in quantiles.approx_quantiles(df, ["v"], (0.25, 0.5, 0.75)).collect()}
    assert abs(q[0.5] - 5000) <= 100


def test_running_totals_many_buckets(spark):
    df = spark.createDataFrame([(float(i) / 7.0, float(i % 5)) for i in range(2000)], "s double, c double")
    out = running_totals(df, "s", ["c"], buckets=13).orderBy("s").collect()
    acc = 0.0
    for r in out:
        acc += r["c"]
        assert r["cum_c"] == pytest.approx(acc)


# -------------------------------------------------------------- stats ---

def test_histogram_numpy_semantics(spark):
    rnd = random.Random(3)
    xs = [rnd.uniform(-5, 17) for _ in range(997)] + [17.5, -5.5]
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "v double")
    h = stats.histogram(df, "v", 30).orderBy("bin").collect()
    counts, edges = np.histogram(xs, bins=30)
    assert [r["count"] for r in h] == counts.tolist()
    assert h[-1]["bin_hi"] == pytest.approx(edges[-1])
    assert sum(r["count"] for r in h) == len(xs)


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(4.0,)] * 5, "v double")
    h = stats.histogram(df, "v", 30).where("count > 0").collect()
    counts, _ = np.histogram([4.0] * 5, bins=30)
    assert [r["bin"] for r in h] == [int(np.argmax(counts))]


def test_boxplot_matches_matplotlib_rules(spark):
    rnd = random.Random(1)
    xs = [rnd.expovariate(0.1) for _ in range(500)]
    df = spark.createDataFrame([(1, x) for x in xs], "label int, v double")
    b = stats.boxplot_stats(df, "v", "label").first()
    q1, med, q3 = np.percentile(xs, [25, 50, 75])
    iqr = q3 - q1
    inside = [x for x in xs if q1 - 1.5 * iqr <= x <= q3 + 1.5 * iqr]
    assert b["median"] == pytest.approx(med)
    assert b["whisker_hi"] == pytest.approx(max(inside))
    assert b["whisker_lo"] == pytest.approx(min(inside))
    assert b["n_outliers"] == len(xs) - len(inside)


def test_column_stats_constant_and_bigint(spark):
    df = spark.createDataFrame([(5, 1.0), (5, 2.0), (5, 3.0)], "k bigint, v double")
    st = {r["Feature"]: r for r in stats.column_stats(df).collect()}
    assert set(st) == {"k", "v"}                     # bigint is numeric too
    assert st["k"]["Std"] == 0.0 and st["k"]["Skewness"] is None
    assert st["v"]["Median"] == 2.0 and st["v"]["Kurtosis"] == pytest.approx(-1.5)


def test_stage_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, "c")], "k int, s string")
    r = stats.stage_counts(df).first()
    assert (r["raw_rows"], r["non_null_rows"], r["clean_rows"]) == (4, 3, 2)


def test_severity_fallback_to_label(spark):
    df = spark.createDataFrame([(0,), (1,), (1,)], "label int")
    assert [tuple(r) for r in stats.severity_distribution(df).collect()] == [(0, 1), (1, 2)]


# --------------------------------------------------------- evaluation ---

def test_published_confusion_cells_reproduce_rates(spark):
    cells = spark.createDataFrame([(9.0, 1089201.0, 26.0, 261639.0)], "tp double, tn double, fp double, fn double")
    r = evaluate.rate_metrics(cells).first()
    assert round(r["precision"], 6) == 0.257143
    assert round(r["sensitivity"], 6) == 3.4e-05
    assert round(r["specificity"], 6) == 0.999976
    assert round(r["f1"], 6) == 6.9e-05
    assert round(r["fnr"], 6) == 0.999966
    assert round(r["fpr"], 6) == 2.4e-05
    assert round(r["youden_j"], 6) == 1.1e-05
    assert round(r["mcc"], 6) == 0.000817          # no int64 overflow


def test_one_class_predictions(spark):
    df = spark.createDataFrame([(0, 0.0, 0.2), (1, 0.0, 0.4), (1, 0.0, 0.3)], "label int, prediction double, p1 double")
    cm = {r["label"]: (r["pred_0"], r["pred_1"]) for r in evaluate.confusion_matrix(df).collect()}
    assert cm == {0: (1, 0), 1: (2, 0)}
    one = spark.createDataFrame([(1, 0.0, 0.2), (1, 0.0, 0.4)], "label int, prediction double, p1 double")
    assert evaluate.auc_exact(one).first()["auc_roc"] is None


def test_roc_and_auc_properties(spark):
    rnd = random.Random(5)
    rows = [(int(rnd.random() < 0.3), round(rnd.random(), 2)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "label int, p1 double")
    roc = evaluate.roc_points(df).orderBy(F.desc("threshold")).collect()
    fpr = [0.0] + [r["fpr"] for r in roc]
    tpr = [0.0] + [r["tpr"] for r in roc]
    assert all(b >= a for a, b in zip(fpr, fpr[1:])) and all(b >= a for a, b in zip(tpr, tpr[1:]))
    assert fpr[-1] == pytest.approx(1.0) and tpr[-1] == pytest.approx(1.0)
    trapezoid = sum((fpr[i + 1] - fpr[i]) * (tpr[i + 1] + tpr[i]) / 2 for i in range(len(fpr) - 1))
    auc = evaluate.auc_exact(df).first()["auc_roc"]
    assert auc == pytest.approx(trapezoid, abs=1e-12)
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc == pytest.approx(brute, abs=1e-12)


def test_accuracy_weighted_matches_mllib(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    rnd = random.Random(2)
    rows = [(float(rnd.random() < 0.4), float(rnd.random() < 0.3)) for _ in range(500)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = evaluate.accuracy_weighted(df).first()
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    for ours_key, metric in (("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                             ("weighted_recall", "weightedRecall"), ("weighted_f1", "f1")):
        assert ours[ours_key] == pytest.approx(ev.evaluate(df, {ev.metricName: metric}), abs=1e-12)


def test_kpi_subset_defaults_to_zero(spark):
    m = spark.createDataFrame([("Accuracy", 0.8)], "Metric string, Value double")
    k = {r["Metric"]: r["Value"] for r in evaluate.kpi_subset(m).collect()}
    assert k == {"Accuracy": 0.8, "Precision": 0.0, "Recall": 0.0, "F1-Score": 0.0, "AUC-ROC": 0.0}


# ---------------------------------------------------- encode / model ---

def test_string_index_ties_and_nulls(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "w string")
    out, cols = encode.string_index(df, ["w", "absent"])
    assert cols == ["w_idx"]
    m = {r["w"]: r["w_idx"] for r in out.collect()}
    assert m == {"c": 0.0, "a": 1.0, "b": 2.0, None: 3.0}


def test_category_lookup_default(spark):
    df = spark.createDataFrame([("Rain",), ("Hail",)], "Weather_Condition string")
    out = {r[0]: r[1] for r in encode.category_lookup(df, "Weather_Condition", {"Rain": 2.0}).collect()}
    assert out == {"Rain": 2.0, "Hail": 0.0}


def test_parse_numeric_reject(spark):
    df = spark.createDataFrame([(" 1.5",), ("abc",), (None,)], "x string")
    rows = encode.parse_numeric(df, ["x"]).collect()
    assert [(r["x_num"], r["rejected"]) for r in rows] == [(1.5, False), (None, True), (None, False)]


def test_hash_split_is_partition_independent(spark):
    df = spark.range(5000).select(F.col("id").alias("k"))
    a = model.hash_split(df.repartition(2), ["k"]).where("is_train").count()
    b = model.hash_split(df.repartition(7), ["k"]).where("is_train").count()
    assert a == b and 3800 < a < 4200
    assert model.hash_split(df, ["k"]).count() == 5000


def _toy(spark, n=400, seed=11):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        x1, x2 = rnd.gauss(0, 1), rnd.gauss(5, 2)
        y = int(x1 + 0.3 * x2 + rnd.gauss(0, 0.5) > 1.5)
        rows.append((i, x1, x2, 7.0, y))
    return spark.createDataFrame(rows, "id int, x1 double, x2 double, const double, label int")


def test_score_batch_equals_mllib(spark):
    df = _toy(spark)
    feats = ["x1", "x2", "const"]
    fitted, _, test = model.train_model(df, feats, "label", ["id"])
    pred = model.predict(fitted, test).select("id", "p1", "prediction")
    coefs = model.coefficient_table(fitted, feats)
    mine = score.score_batch(test, coefs).select("id", "probability", "prediction")
    j = pred.join(mine.withColumnRenamed("prediction", "mine_pred"), "id").collect()
    assert len(j) == test.count()
    for r in j:
        assert r["p1"] == pytest.approx(r["probability"], abs=1e-9)


def test_mllib_threshold_is_strict_scorer_is_not(spark):
    df = spark.createDataFrame([(0.0,)], "x double")
    out = score.score_batch(df, [("x", 1.0, 0.0, 1.0)], intercept=0.0).first()
    assert out["probability"] == 0.5 and out["prediction"] == 1


def test_zscore_constant_feature(spark):
    df = spark.createDataFrame([(1.0, 3.0), (1.0, 5.0)], "c double, v double")
    st = encode.zscore_fit(df, ["c", "v"])
    r = encode.zscore_apply(df, st).orderBy("v").first()
    assert r["c_z"] == 0.0 and r["v_z"] == pytest.approx(-1 / math.sqrt(2))
    r1 = encode.zscore_apply(df, st, zero_std="one").first()
    assert r1["c_z"] == 0.0


def test_feature_importance_order(spark):
    coefs = spark.createDataFrame([(0, "a", 0.1, 0.0, 1.0), (1, "b", -2.0, 0.0, 1.0), (2, "c", 1.0, 0.0, 1.0),
                                   (-1, "(intercept)", 5.0, 0.0, 1.0)],
                                  "position int, feature string, coefficient double, mean double, std double")
    assert [r["feature"] for r in model.feature_importance(coefs).orderBy("rank").collect()] == ["b", "c", "a"]


def test_model_save_load(spark, tmp_dir):
    from riskframe.sources.models import load_coefficients, load_model, save_model
    df = _toy(spark, 200)
    fitted, _, test = model.train_model(df, ["x1", "x2"], "label", ["id"])
    save_model(fitted, ["x1", "x2"], tmp_dir + "/m")
    again = load_model(tmp_dir + "/m")
    a = model.predict(fitted, test).select("id", "p1").orderBy("id").collect()
    b = model.predict(again, test).select("id", "p1").orderBy("id").collect()
    assert a == b
    assert load_coefficients(spark, tmp_dir + "/m").count() == 3


# ------------------------------------------------- customer quarters ---

def test_quarter_trend_and_label(spark):
    from datetime import datetime
    rows = [(1, 10, datetime(2020, 1, 5), 100.0), (1, 11, datetime(2020, 4, 5), 50.0),
            (1, 12, datetime(2020, 10, 5), 70.0), (2, 20, datetime(2020, 10, 6), 10.0),
            (2, 21, datetime(2021, 1, 6), 10.0)]
    o = spark.createDataFrame(rows, "c int, o int, d timestamp, amt double")
    t = {(r["c"], r["quarter"]): r for r in features.customer_quarter_table(o, "c", "o", "d", "amt").collect()}
    # customer 1: Q1 -> Q2 adjacent (label 1); Q2 -> Q4 gap (label 0, trend of Q4 = 0)
    assert t[(1, 1)]["label"] == 1 and t[(1, 2)]["label"] == 0
    assert t[(1, 2)]["purchase_trend"] == -1 and t[(1, 4)]["purchase_trend"] == 0
    assert t[(2, 4)]["label"] == 1
    assert (2, 1) not in t                  # last observed quarter dropped (label unknown)
    r = {x["c"]: x for x in features.rfm(o, "c", "o", "d", "amt").collect()}
    assert r[1]["recency_days"] == 93 and r[1]["frequency"] == 3 and r[1]["lifespan_days"] == 274


def test_cached_stats_equal_uncached(spark):
    rnd = random.Random(8)
    df = spark.createDataFrame([(i % 2, rnd.random() * 10) for i in range(500)], "label int, v double")
    a = stats.column_stats(df, ["v"]).collect()
    b = stats.column_stats(df, ["v"], cache=True).collect()
    # the written copy is read in other partitions: sums may differ in the last digit
    assert [r["Feature"] for r in a] == [r["Feature"] for r in b]
    assert all(x == pytest.approx(y, rel=1e-12) for r, t in zip(a, b) for x, y in zip(r[1:], t[1:]))
    assert stats.boxplot_stats(df, "v").orderBy("label").collect() == \
        stats.boxplot_stats(df, "v", cache=True).orderBy("label").collect()
    assert not spark.sparkContext._jsc.getPersistentRDDs()


# ------------------------------------------------------- degenerate input ---

def test_empty_and_all_null_inputs(spark):
    empty = spark.createDataFrame([], "label int, p1 double, prediction double, v double")
    assert evaluate.auc_exact(empty).first()["auc_roc"] is None
    assert evaluate.roc_points(empty).count() == 0
    cells = evaluate.confusion_cells(empty).first()
    assert (cells["tp"], cells["total"]) == (0.0, 0.0)
    assert quantiles.exact_quantiles(empty, ["v"], (0.5,)).count() == 0
    nulls = spark.createDataFrame([(None, 1.0), (None, 2.0), (None, 3.0)], "a double, b double")
    st = {r["Feature"]: r for r in stats.column_stats(nulls).collect()}
    assert st["a"]["Count"] == 0 and st["a"]["Median"] is None and st["b"]["Median"] == 2.0
    h = stats.histograms(nulls, ["a", "b"], 30)
    assert {r["feature"] for r in h.collect()} == {"b"}
    with pytest.raises(ValueError):
        stats.histograms(nulls, ["a"], 30)


def test_single_row(spark):
    one = spark.createDataFrame([(1, 0.7, 1.0, 5.0)], "label int, p1 double, prediction double, v double")
    st = stats.column_stats(one, ["v"]).first()
    assert (st["Count"], st["Median"], st["Q1"], st["Q3"]) == (1, 5.0, 5.0, 5.0)
    b = stats.boxplot_stats(one, "v", "label").first()
    assert (b["median"], b["whisker_lo"], b["whisker_hi"], b["n_outliers"]) == (5.0, 5.0, 5.0, 0)
    assert evaluate.auc_exact(one).first()["auc_roc"] is None


def test_latest_quarter_rows(spark):
    from datetime import datetime
    rows = [(1, 10, datetime(2020, 1, 5), 100.0), (1, 11, datetime(2020, 4, 5), 50.0),
            (2, 20, datetime(2020, 4, 6), 10.0), (3, 30, datetime(2020, 1, 6), 10.0)]
    o = spark.createDataFrame(rows, "c int, o int, d timestamp, amt double")
    out = {r["c"]: r for r in features.latest_quarter_rows(o, "c", "o", "d", "amt").collect()}
    assert {c: r["quarter"] for c, r in out.items()} == {1: 2, 2: 2, 3: 1}      # every customer, own last quarter
    assert out[1]["purchase_trend"] == -1 and out[2]["purchase_trend"] == 0
    t = features.customer_quarter_table(o, "c", "o", "d", "amt", complete_until="2020-05-10")
    assert t.count() == 0                             # the second quarter is open: no label before it is known
    t = features.customer_quarter_table(o, "c", "o", "d", "amt", complete_until="2020-06-30")
    assert {(r["c"], r["quarter"], r["label"]) for r in t.collect()} == {(1, 1, 1), (3, 1, 0)}


def test_edge_faults(spark):
    one = spark.createDataFrame([(0, 0.2, 0.0), (0, 0.7, 1.0)], "label int, p1 double, prediction double")
    assert {(r["fpr"], r["tpr"]) for r in evaluate.roc_points(one).collect()} == {(1.0, None), (0.5, None)}
    mixed = spark.createDataFrame([("x", 1), ("2", 3)], "t string, n int")
    d = {r["summary"]: r["t"] for r in stats.describe_core(mixed).collect()}
    assert d["count"] == 2.0 and d["mean"] == 2.0
    g = spark.createDataFrame([(None, 1.0), (None, 2.0), (1, 1.0)], "g int, v double")
    h = stats.histograms(g, ["v"], 2, by="g").collect()
    assert {(r["g"], r["bin"]): r["count"] for r in h} == {(None, 0): 1, (None, 1): 1, (1, 0): 1, (1, 1): 0}
    twice = spark.createDataFrame([("a", 0.0), ("a", 1.0)], "value string, idx double")
    with pytest.raises(ValueError):
        encode.category_lookup(mixed, "t", twice)
    cut = model.hash_split(spark.range(20000), ["id"], 0.995).groupBy("is_train").count()
    n = {r["is_train"]: r["count"] for r in cut.collect()}
    assert 50 < n[False] < 160
    assert model.split_sizes(model.hash_split(spark.range(0), ["id"])).first()["train_pct"] is None
    with pytest.raises(ValueError):
        model.train_model(one, ["p1", "no_such"])


def test_quantiles_of_extreme_values_and_many_groups(spark):
    rnd = random.Random(4)
    inf = float("inf")
    xs = [rnd.gauss(0, 1) for _ in range(200)] + [inf] * 100 + [-inf] * 100 + [1.7e308, -1.7e308, 5e-324, 1e-323]
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    got = quantiles.exact_quantile_values(df, ["v"], (0.1, 0.3, 0.6, 0.9), final_rows=1, accuracy=2)
    for p in (0.1, 0.3, 0.6, 0.9):
        s, h = sorted(xs), p * (len(xs) - 1)
        a, b = s[int(math.floor(h))], s[int(math.ceil(h))]
        assert got[((), "v", p)] == (a if a == b or h == int(h) else pytest.approx(a + (h - math.floor(h)) * (b - a)))
    rows = [(i % 700, rnd.random()) for i in range(5000)] + [(None, 1.0), (None, 3.0)]
    g = spark.createDataFrame(rows, "g int, v double")
    for limit in (10_000, 5):
        out = quantiles.grouped_quantiles(g, ["v"], (0.25, 0.5), ["g"], sort_rows=limit).collect()
        assert len(out) == 2 * 701
        for r in out[::50]:
            vs = [v for k, v in rows if k == r["g"]]
            assert r["value"] == pytest.approx(float(np.percentile(vs, 100 * r["prob"])), rel=1e-12)

def _roc_curve_reference(y, s):
    """numpy version of the usual roc_curve (drop_intermediate=True)."""
    y, s = np.asarray(y, float), np.asarray(s, float)
    order = np.argsort(-s, kind="mergesort")
    y, s = y[order], s[order]
    idx = np.r_[np.where(np.diff(s))[0], y.size - 1]
    tps = np.cumsum(y)[idx]
    fps = 1 + idx - tps
    thr = s[idx]
    if len(fps) > 2:
        keep = np.where(np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True])[0]
        fps, tps, thr = fps[keep], tps[keep], thr[keep]
    tps, fps, thr = np.r_[0, tps], np.r_[0, fps], np.r_[np.inf, thr]
    return thr, fps / fps[-1], tps / tps[-1]


@pytest.mark.parametrize("seed", [1, 2])
def test_roc_drop_intermediate_matches_reference_curve(spark, seed):
    rnd = random.Random(seed)
    rows = [(int(rnd.random() < 0.35), round(rnd.random(), 2) if rnd.random() < 0.7 else 0.5)
            for _ in range(2500)]
    df = spark.createDataFrame(rows, "label int, p1 double").repartition(5)
    got = sorted(((r["threshold"], r["fpr"], r["tpr"]) for r in
                  evaluate.roc_points(df, drop_intermediate=True, with_origin=True).collect()),
                 key=lambda t: -t[0])
    thr, fpr, tpr = _roc_curve_reference([y for y, _ in rows], [p for _, p in rows])
    assert len(got) == len(thr)
    for (a, b, c), x, y_, z in zip(got, thr, fpr, tpr):
        assert a == x and b == pytest.approx(y_) and c == pytest.approx(z)
