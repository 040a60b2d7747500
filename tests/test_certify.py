"""Certified training, distributed index, outlier points, AUC bounds, mixed headers, maintained quarters."""
import os
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import certify, encode, evaluate, features, model, stats
from riskframe.sources import files
from riskframe.streaming.quarters import QuarterTable


def _training(spark, n=800, seed=2):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        a, b = rnd.gauss(3, 2), rnd.expovariate(0.1)
        rows.append((a, b, 5.0, int(rnd.random() < 1 / (1 + np.exp(-(a - 3) + 0.05 * b)))))
    return spark.createDataFrame(rows, "a double, b double, c double, label int").repartition(3), rows


def _optimum(rows, reg=0.01):
    """Plain Newton in numpy on the standardised rows."""
    x = np.array([r[:3] for r in rows], float)
    s = x.std(axis=0, ddof=1)
    z = np.where(s > 0, (x - x.mean(axis=0)) / np.where(s > 0, s, 1), 0.0)
    z, y = np.hstack([z, np.ones((len(z), 1))]), np.array([r[3] for r in rows], float)
    w, ridge = np.zeros(4), np.diag([reg] * 3 + [0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-z @ w))
        w = w - np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) / len(z) + ridge, z.T @ (p - y) / len(z) + ridge @ w)
    return w


def test_bound_holds_and_polish_reaches_the_optimum(spark, monkeypatch):
    df, rows = _training(spark)
    best = _optimum(rows)
    scaled = certify.scaled_by(df, ["a", "b", "c"])
    for off in (0.0, 1e-6, 1e-3, 0.02):
        c = certify.certificate(df, scaled, best + off * np.array([1, -1, 0.5, 1]), tolerance=1e-7).first()
        away = off * np.linalg.norm([1, -1, 0.5, 1])
        assert c["distance_bound"] is None or c["distance_bound"] >= away * 0.999
        assert c["certified"] == (off == 0.0) and c["n"] == len(rows)
    assert certify.certificate(df, scaled, best + 30.0).first()["distance_bound"] is None       # too far to tell
    monkeypatch.setattr(certify, "SUMS", 5)                  # the aggregates in several passes
    for start in (np.zeros(4), best + 3.0):
        w, bound = certify.polish(df, scaled, start)
        assert np.abs(w - best).max() < 1e-10 and bound < 1e-10


def test_fitted_model_is_within_its_bound(spark):
    df, rows = _training(spark, 500)
    feats = ["a", "b", "c"]
    table, bound, train, test = certify.train_certified(df, feats, "label", ["a", "b"])
    fitted, _, _ = model.train_model(df, feats, "label", ["a", "b"])
    scaled, w = certify.scaled_of(model.coefficient_table(fitted, feats))
    c = certify.certificate(train, scaled, w).first()
    _, best = certify.scaled_of(table)
    assert bound < 1e-9 and np.linalg.norm(w - best) <= c["distance_bound"] + 1e-9
    assert train.count() + test.count() == 500


def test_no_training_rows(spark):
    df, _ = _training(spark, 5)
    with pytest.raises(ValueError, match="no training rows"):
        certify.terms(df.limit(0), certify.Scaled(["a"], [0.0], [1.0]), np.zeros(2))


def test_index_equals_string_index_and_collects_nothing(spark, monkeypatch):
    rnd = random.Random(4)
    rows = [(i, rnd.choice(["x", "x", "x", "y", "z", None, "", "é"]), f"u{i}", "hot" if i % 3 else f"v{i % 7}")
            for i in range(900)]
    df = spark.createDataFrame(rows, "i int, a string, u string, h string").repartition(5)
    want, names = encode.string_index(df, ["a", "u", "h"])
    monkeypatch.setattr(type(df), "collect", lambda self: pytest.fail("collected"))
    got = encode.string_index_any(df, ["a", "u", "h", "absent"])
    monkeypatch.undo()
    pick = lambda d: sorted(map(tuple, d.select("i", *names).collect()))
    assert pick(got) == pick(want)
    ranks = encode.rank_values(df, "u")
    assert sorted(r["idx"] for r in ranks.collect()) == list(map(float, range(900)))
    assert encode.string_index_any(df.limit(0), ["a"]).count() == 0


@pytest.mark.parametrize("many", [False, True])
def test_outlier_points(spark, monkeypatch, many):
    from riskframe.operators import quantiles
    rnd = random.Random(6)
    rows = [(k, rnd.choice([0, 0, 1, 2, None]), rnd.gauss(0, 1) ** 3) for k in range(900)]
    rows += [(2000, 1, None), (2001, 1, float("nan")), (2002, 3, 5.0)]
    if many:
        monkeypatch.setattr(quantiles, "MAX_TARGETS", 2)
    df = spark.createDataFrame(rows, "k int, g int, v double").repartition(4)
    got = sorted(map(tuple, stats.boxplot_outliers(df, "v", "g", ["k"]).collect()))
    want = []
    for g in (0, 1, 2, 3):
        own = [(k, v) for k, x, v in rows if x == g and v is not None and v == v]
        q1, q3 = np.percentile([v for _, v in own], [25, 75])
        for k, v in own:
            side = "low" if v < q1 - 1.5 * (q3 - q1) else "high" if v > q3 + 1.5 * (q3 - q1) else None
            if side:
                want.append((g, k, v, side))
    assert got == sorted(want) and {w[3] for w in want} == {"low", "high"}
    counts = {r["g"]: r["n_outliers"] for r in stats.boxplot_stats(df, "v", "g").collect()}
    assert counts == {g: sum(w[0] == g for w in want) for g in (0, 1, 2, 3)}


def test_auc_bounds_enclose_and_narrow(spark):
    rnd = random.Random(8)
    fixtures = {
        "ties": [(int(rnd.random() < 0.4), rnd.choice([0.1, 0.2, 0.2, 0.9])) for _ in range(500)],
        "fine": [(int(rnd.random() < 0.4), 0.5 + 1e-9 * rnd.random()) for _ in range(400)] + [(1, 0.0), (0, 1.0)],
        "hot": [(int(rnd.random() < 0.5), 0.5 if i % 3 == 0 else rnd.random()) for i in range(600)],
        "one": [(1, 0.5), (0, 0.5)],
    }
    for name, rows in fixtures.items():
        df = spark.createDataFrame(rows, "label int, p1 double").repartition(3)
        exact = evaluate.auc_exact(df).first()[0]
        wide = evaluate.auc_certified(df, bins=10, tolerance=0.5).first()
        tight = evaluate.auc_certified(df, bins=10, tolerance=1e-9).first()
        for b in (wide, tight):
            assert b["auc_lower"] - 1e-12 <= exact <= b["auc_upper"] + 1e-12, name
        assert tight["auc_upper"] - tight["auc_lower"] <= 1e-9, name
    one = spark.createDataFrame([(1, 0.5), (1, 0.7), (1, None)], "label int, p1 double")
    assert evaluate.auc_certified(one).first()["auc_lower"] is None


def test_folder_of_three_headers(spark, tmp_dir):
    def put(name, text):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
    put("a.csv", "x,y\n1,one\n2,\"t,wo\"\n")
    put("b.csv", " y ,x,extra\nthree,3,zz\nbad,q,zz\n")
    put("c.csv", "z,x\n4.5,4\n")
    put("d.csv", "")
    put("_skipped.csv", "x\n9\n")
    df = files.read_csv(spark, tmp_dir, "x int, y string, z double, w int", rejected="bad")
    assert df.columns == ["x", "y", "z", "bad"]
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, [
        (1, "one", None, False), (2, "t,wo", None, False), (3, "three", None, False), (None, "bad", None, True),
        (4, None, 4.5, False)]))
    put("e.csv", "x,x\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        files.read_csv(spark, tmp_dir, "x int")


def test_mixed_headers_are_one_scan_each(spark, tmp_dir):
    for k in range(6):
        with open(os.path.join(tmp_dir, f"{k}.csv"), "w") as f:
            f.write(("x,y" if k % 2 else "y,x") + f"\n{k},{k}\n")
    df = files.read_csv(spark, tmp_dir, "x int, y int")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2 and sorted(r["x"] for r in df.collect()) == list(range(6))


KIND = "c long, o long, t timestamp, a double"


def test_quarters_after_late_and_corrected_orders(spark, tmp_dir):
    rnd = random.Random(5)
    orders = [(rnd.choice([1, 1, rnd.randint(2, 40)]), i, datetime(2020, 1, 1) + timedelta(days=rnd.randrange(900)),
               float(rnd.randint(1, 500))) for i in range(400)]
    rnd.shuffle(orders)                                     # a third of the orders are customer 1's
    first = [(c + (i % 7 == 0), i, t + timedelta(days=200 * (i % 5 == 0)), a * 2) for c, i, t, a in orders[:150]]
    batches = [first, orders[150:300], orders[:60] + orders[300:390], [], orders[60:150] + orders[390:] + orders[60:65],
               [(None, 9999, datetime(2020, 1, 1), 1.0), (3, None, datetime(2020, 1, 1), 1.0)]]
    table = QuarterTable(spark, os.path.join(tmp_dir, "q"), ("c", "o", "t", "a"), buckets=6)
    version: dict = {}
    for k, part in enumerate(batches):
        df = spark.createDataFrame(part, KIND)
        table.apply(df, k)
        if k == 2:
            table.apply(df, k)                              # tried again
        before = dict(version)
        version |= {o: (c, o, t, a) for c, o, t, a in part if c is not None and o is not None}
        touched = {c for c, o, *_ in part if c is not None and o is not None}
        touched |= {before[o][0] for _, o, *_ in part if o in before and version[o][0] != before[o][0]}
        written = spark.read.parquet(table._folder("quarters", k))
        assert {r[0] for r in written.select("customer").distinct().collect()} <= touched   # nobody else's rows
        whole = spark.createDataFrame(list(version.values()), KIND)
        want = features.customer_quarter_table(whole, "c", "o", "t", "a")
        got = table.labelled()
        key = lambda d: sorted(map(tuple, d.collect()))     # noqa: E731
        assert key(got.select(*[x for x in got.columns])) == key(want), k
