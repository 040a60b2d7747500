"""Scale rules: plan shapes of every registered query, and hot-key inputs.

* No cartesian / nested-loop join and no Python UDF in any final plan.
* A single-partition exchange may only sit on an aggregate (bounded rows),
  never on row-level data.
* Operators stay exact when one key or value holds a third of all rows.
"""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from riskframe.operators import clean, evaluate, features, quantiles, stats

from .conftest import SF_SMALL


def _final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_plan_rules(spark, name):
    plan = _final_plan(E.queries()[name](spark, SF_SMALL))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan), name
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas", plan), name
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            for below in lines[i + 1:]:
                if len(below) - len(below.lstrip(" :+-")) <= depth:
                    break                      # left the exchange's subtree
                if re.search(r"HashAggregate|ObjectHashAggregate|SortAggregate", below):
                    break                      # rows are aggregated (bounded) first
                assert "FileScan" not in below, \
                    f"{name}: single-partition exchange over row-level data\n{plan}"


def _hot(n, frac=1 / 3, seed=0):
    rnd = random.Random(seed)
    return [7.0 if rnd.random() < frac else rnd.gauss(0, 50) for _ in range(n)]


def test_quantiles_hot_value(spark):
    xs = _hot(6000)
    df = spark.createDataFrame([(x,) for x in xs], "v double").repartition(6)
    got = quantiles.exact_quantile_values(df, ["v"], (0.1, 0.25, 0.5, 0.75, 0.9), final_rows=50, bins=8)
    for p in (0.1, 0.25, 0.5, 0.75, 0.9):
        assert got[((), "v", p)] == pytest.approx(np.percentile(xs, p * 100), abs=1e-9)


def test_boxplot_hot_group(spark):
    rnd = random.Random(4)
    rows = [(0 if rnd.random() < 0.9 else 1, rnd.expovariate(0.2)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "label int, v double").repartition(5)
    out = {r["label"]: r for r in stats.boxplot_stats(df, "v").collect()}
    for k in (0, 1):
        xs = [v for g, v in rows if g == k]
        q1, med, q3 = np.percentile(xs, [25, 50, 75])
        assert out[k]["median"] == pytest.approx(med) and out[k]["q3"] == pytest.approx(q3)
        assert out[k]["n"] == len(xs)


def test_roc_hot_score(spark):
    rnd = random.Random(6)
    rows = [(int(rnd.random() < 0.4), 0.5 if rnd.random() < 1 / 3 else round(rnd.random(), 3))
            for _ in range(3000)]
    df = spark.createDataFrame(rows, "label int, p1 double").repartition(4)
    auc = evaluate.auc_exact(df).first()["auc_roc"]
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    brute = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert auc == pytest.approx(brute, abs=1e-12)
    roc = {r["threshold"]: (r["fpr"], r["tpr"]) for r in evaluate.roc_points(df).collect()}
    fp = sum(1 for y, p in rows if y == 0 and p >= 0.5) / len(neg)
    tp = sum(1 for y, p in rows if y == 1 and p >= 0.5) / len(pos)
    assert roc[0.5] == pytest.approx((fp, tp))


def test_customer_quarters_hot_customer(spark):
    from datetime import datetime, timedelta
    rnd = random.Random(9)
    rows = []
    for i in range(3000):
        c = 1 if rnd.random() < 1 / 3 else rnd.randint(2, 200)
        rows.append((c, i, datetime(2020, 1, 1) + timedelta(days=rnd.randint(0, 700)), rnd.random() * 100))
    o = spark.createDataFrame(rows, "c int, o int, d timestamp, amt double").repartition(6)
    t = features.customer_quarter_table(o, "c", "o", "d", "amt")
    hot = sorted((r["quarter_idx"], r["quarter_frequency"]) for r in t.where("c = 1").collect())
    qi = lambda d: d.year * 4 + (d.month - 1) // 3
    expect: dict = {}
    for c, _, d, _ in rows:
        if c == 1:
            expect[qi(d)] = expect.get(qi(d), 0) + 1
    last = max(qi(d) for _, _, d, _ in rows)
    assert hot == sorted((q, n) for q, n in expect.items() if q < last)


def test_dedupe_hot_duplicate(spark):
    rows = [(1, "a")] * 2000 + [(i, "b") for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, s string").repartition(5)
    assert clean.dedupe_rows(df).count() == 1001
    r = stats.stage_counts(df).first()
    assert (r["raw_rows"], r["clean_rows"]) == (3000, 1001)


def test_histogram_hot_value_in_top_bin(spark):
    xs = [10.0] * 1000 + [float(i % 10) for i in range(2000)]
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    h = [r["count"] for r in stats.histogram(df, "v", 30).orderBy("bin").collect()]
    assert h == np.histogram(xs, bins=30)[0].tolist()


def test_category_lookup_table_join_is_left_to_the_planner(spark):
    from riskframe.operators import encode
    mapping = spark.range(100).select(F.col("id").cast("string").alias("value"),
                                      F.col("id").cast("double").alias("idx"))
    df = spark.range(1000).select((F.col("id") % 150).cast("string").alias("k"))
    out = encode.category_lookup(df, "k", mapping)
    # no broadcast hint: the planner decides by the table's size in bytes
    assert "strategy=broadcast" not in out._jdf.queryExecution().analyzed().toString()
    small = encode.category_lookup(df, "k", {"1": 1.0})
    assert "strategy=broadcast" in small._jdf.queryExecution().analyzed().toString()
    expect = sum(1 for i in range(1000) if i % 150 == 0 or i % 150 >= 100)   # key '0' or unknown
    assert out.where("k_idx = 0.0").count() == expect


def test_quantile_value_budget_still_exact(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "VALUE_BUDGET", 40)
    rnd = random.Random(12)
    rows = [(i % 7, rnd.gauss(0, 10)) for i in range(4000)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(3)
    got = quantiles.exact_quantile_values(df, ["v"], (0.25, 0.5, 0.75), ["g"], final_rows=200, bins=16)
    for g in range(7):
        xs = [v for k, v in rows if k == g]
        for p in (0.25, 0.5, 0.75):
            assert got[((g,), "v", p)] == pytest.approx(np.percentile(xs, p * 100), abs=1e-9)


def test_many_groups_stay_off_the_driver(spark, monkeypatch):
    rnd = random.Random(12)
    rows = [(rnd.choice([k, 0]), rnd.gauss(0, 5)) for k in range(40) for _ in range(30)] + [(41, None), (None, 1.0)]
    df = spark.createDataFrame(rows, "label int, v double").repartition(4)
    box = lambda **kw: sorted(map(tuple, stats.boxplot_stats(df, "v", **kw).collect()))
    probs = (0.1, 0.25, 0.5)
    q = lambda: {(r["label"], r["prob"]): r["value"] for r in
                 quantiles.exact_quantiles(df, ["v"], probs, ["label"]).collect()}
    want, want_q = box(), q()

    def not_many(*args, **kw):
        raise AssertionError("all groups on the driver")
    monkeypatch.setattr(quantiles, "MAX_TARGETS", 60)
    monkeypatch.setattr(quantiles, "order_statistics", not_many)
    for got in (box(), box(cache=True)):
        assert len(got) == len(want) == 40
        for a, b in zip(got, want):
            assert a == pytest.approx(b)
    got_q = q()
    assert len(got_q) == len(want_q) == 41 * len(probs) and got_q == pytest.approx(want_q)


def test_resolving_pass_is_code_that_the_jvm_compiles(spark, monkeypatch):
    """HotSpot interprets methods of 8,000 bytes and more; each half of the pass stays below."""
    import contextlib
    import io

    from riskframe.operators import quantiles as q
    df = spark.range(20_000).select(*[((F.col("id") * (k + 7919)) % 10_007).cast("double").alias(f"c{k}")
                                      for k in range(9)])
    plans = []
    for name in ("_gaps", "_inside"):
        monkeypatch.setattr(q, name, lambda *a, f=getattr(q, name): plans.append(f(*a)) or plans[-1])
    got = q.exact_quantile_values(df, df.columns, (0.25, 0.5, 0.75), final_rows=2)
    for c in df.columns:
        x = sorted(r[0] for r in df.select(c).collect())
        for p in (0.25, 0.5, 0.75):
            h = p * (len(x) - 1)
            i = int(h)
            assert abs(got[((), c, p)] - (x[i] + (h - i) * (x[min(i + 1, len(x) - 1)] - x[i]))) < 1e-9
    assert len(plans) >= 2
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    for plan in plans[:2]:
        said = io.StringIO()
        spark.conf.set("spark.sql.adaptive.enabled", "false")      # else code is made while it runs
        try:
            with contextlib.redirect_stdout(said):
                plan.select("*").explain("codegen")
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", said.getvalue())]
        assert sizes and max(sizes) < 8000, sizes
