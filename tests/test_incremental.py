"""Ledger, mergeable states, atomic publication and the batch-by-batch job."""
import os
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import evaluate, partials, stats
from riskframe.sources import publish
from riskframe.streaming.incremental import IncrementalJob
from riskframe.streaming.ledger import Ledger, row_key


def _rows(n, seed=0, first=0):
    rnd = random.Random(seed)
    return [(first + i, rnd.choice([1, 2, 2, 3]), rnd.gauss(5, 3), rnd.expovariate(0.3),
             datetime(2020, 1, 1) + timedelta(hours=rnd.randrange(5000))) for i in range(n)]


KIND = "id long, Severity int, a double, b double, t timestamp"


def _scored(df):
    p1 = F.floor((1 / (1 + F.exp(-F.col("a") / 4))) * 1000) / 1000
    return df.select((F.col("Severity") >= 2).cast("int").alias("label"), p1.alias("p1"),
                     (p1 > 0.5).cast("double").alias("prediction"))


def _job(spark, base, **kw):
    return IncrementalJob(spark, base, ["a", "b"], ["Severity"], ["a"], bins=8, score=_scored, buckets=4, **kw)


def test_row_keys_agree_with_distinct(spark):
    rows = [(1, "a", 0.0, None), (1, "a", -0.0, None), (1, None, 0.0, "a"), (None, "a", 0.0, "1"),
            (1, "ab", 0.0, "c"), (1, "a", 0.0, "bc"), (1, "a", float("nan"), None), (1, "a", float("nan"), None)]
    df = spark.createDataFrame(rows, "x int, s string, d double, u string")
    assert df.select(*row_key(df)).distinct().count() == df.distinct().count() == 6


def test_ledger_is_not_shuffled_and_compacts(spark, tmp_dir):
    ledger = Ledger(spark, os.path.join(tmp_dir, "ledger"), buckets=8)
    for k in range(3):
        rows = spark.createDataFrame(_rows(200, seed=k, first=100 * k), KIND).drop("a", "b", "t", "Severity")
        new = ledger.unseen(rows, k)
        if k == 2:
            new.write.format("noop").mode("overwrite").save()
            plan = new._jdf.queryExecution().executedPlan().toString()
            left, right = plan.split("FileScan parquet spark_catalog")[:2]
            assert "Bucketed: true" in right
            assert left.count("Exchange hashpartitioning") == 1           # the batch's, pre-aggregated
            above, below = left.split("Exchange hashpartitioning")
            assert "SortMergeJoin" in above and "partial_count" in below
        expect = 200 if k == 0 else 100
        got = new.persist()
        assert got.count() == expect
        ledger.add(got, k)
        got.unpersist()
    assert ledger.keys().count() == 400 and ledger.n_files() > 8
    again = Ledger(spark, os.path.join(tmp_dir, "ledger"))                # another session finds it
    assert again.buckets == 8 and again.version == ledger.version
    assert again.compact(files_per_bucket=1) and again.n_files() <= 8 and again.keys().count() == 400
    assert not again.compact(files_per_bucket=1)
    seen = Ledger(spark, os.path.join(tmp_dir, "ledger"))
    rows = spark.createDataFrame(_rows(500, seed=9), KIND).select("id")
    assert seen.unseen(rows, 7).count() == 100
    assert seen.unseen(rows, 2).count() == 200                            # batch 2 tried again: its own keys


def test_batches_equal_one_run_and_old_rows_are_not_read(spark, tmp_dir):
    rows = _rows(600, seed=3)
    hot = [(10_000, 2, 1.5, 2.5, datetime(2020, 1, 1))] * 300             # a third of all rows are one row
    drops = [rows[:200] + hot, rows[150:400], rows[:100] + rows[380:], rows[50:60]]
    whole = spark.createDataFrame(rows + hot[:1], KIND)
    base = os.path.join(tmp_dir, "job")
    job = _job(spark, base)
    for k, part in enumerate(drops):
        job.apply(spark.createDataFrame(part, KIND).repartition(3), k)
        if k < 3:                    # rows of earlier batches are gone: whoever reads them fails
            os.rename(job._rows_path(k), os.path.join(tmp_dir, f"kept{k}"))
            os.makedirs(os.path.join(base, "rows"), exist_ok=True)
    for k in range(3):
        os.rename(os.path.join(tmp_dir, f"kept{k}"), job._rows_path(k))
    stored = job.rows(None).drop("k1", "k2")
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, whole.collect()))
    got = {r["Feature"]: r for r in job.reports()["column_statistics"].collect()}
    want = {r["Feature"]: r for r in stats.column_stats(whole, ["a", "b"]).collect()}
    for f in ("a", "b"):
        for c in ("Count", "Mean", "Std", "Min", "Max", "Skewness", "Kurtosis"):
            assert got[f][c] == pytest.approx(want[f][c], rel=1e-10), (f, c)
        xs = np.sort([r[2 if f == "a" else 3] for r in rows])
        for c, p in (("Q1", 0.25), ("Median", 0.5), ("Q3", 0.75)):
            assert abs(np.searchsorted(xs, got[f][c]) / len(xs) - p) < 0.02
    sev = {r["Severity"]: r["count"] for r in partials.level_counts(job.state_before(), "Severity").collect()}
    assert sev == {r["Severity"]: r["count"] for r in whole.groupBy("Severity").count().collect()}
    first = np.array([r[2] for r in drops[0]])
    cells = job.reports()["histograms"].orderBy("bin").collect()
    xs = np.array([r[2] for r in rows] + [1.5])
    counts = np.histogram(xs, bins=8, range=(first.min(), first.max()))[0].tolist()
    assert [c["count"] for c in cells] == [int((xs < first.min()).sum()), *counts, int((xs > first.max()).sum())]
    one = partials.evaluation(job.state_before()).first()
    full = evaluate.evaluation_summary(_scored(whole)).first()
    for c in ("tp", "tn", "fp", "fn", "accuracy", "brier", "log_loss", "mcc", "f1"):
        assert one[c] == pytest.approx(full[c], rel=1e-10), c
    assert one["auc_lower"] <= full["auc_roc"] <= one["auc_upper"]
    assert one["auc_mid"] == pytest.approx(full["auc_roc"], abs=1e-12)    # scores have three decimals
    pub = job.published()
    assert pub.verify() == [] and pub.read("rows").first()["rows"] == 601
    assert len(publish.folders(spark, f"{base}/published/runs")) == 2


def test_a_batch_tried_again_changes_nothing(spark, tmp_dir):
    a, b = _rows(80, seed=1), _rows(120, seed=1)
    plain, torn = _job(spark, os.path.join(tmp_dir, "p")), _job(spark, os.path.join(tmp_dir, "t"))
    frames = [spark.createDataFrame(x, KIND) for x in (a, b)]
    for k, df in enumerate(frames):
        plain.apply(df, k)
    torn.apply(frames[0], 0)

    def stop(*args):
        raise RuntimeError("executor lost")
    for step in ("_partial", "publish"):                 # stops after the ledger, then before the switch
        keep = getattr(torn, step)
        setattr(torn, step, stop)
        with pytest.raises(RuntimeError, match="lost"):
            torn.apply(frames[1], 1)
        setattr(torn, step, keep)
        assert torn.published().read("rows").first()["rows"] == 80       # the earlier set, whole
    again = _job(spark, os.path.join(tmp_dir, "t"))      # a new driver
    again.apply(frames[1], 1)
    assert again.rows().count() == plain.rows().count() == 120
    key = lambda j: sorted(map(str, j.reports()["column_statistics"].collect()))
    assert key(again) == key(plain)


def test_nulls_and_empty_batches(spark, tmp_dir):
    job = _job(spark, os.path.join(tmp_dir, "job"))
    job.apply(spark.createDataFrame([], KIND), 0)
    job.apply(spark.createDataFrame([(1, None, None, float("nan"), None), (2, 3, 4.0, 5.0, None)], KIND), 1)
    job.apply(spark.createDataFrame([], KIND), 2)
    assert job.rows().count() == 2
    got = {r["Feature"]: r for r in job.reports()["column_statistics"].collect()}
    assert got["a"]["Count"] == 1 and got["a"]["Std"] is None and got["b"]["Mean"] == 5.0


def test_merge_is_the_same_in_any_grouping(spark):
    df = spark.createDataFrame(_rows(400, seed=5), KIND)
    parts = [partials.moments_state(df.where(F.col("id") % 4 == k), ["a", "b"]) for k in range(4)]
    one = partials.merge_states(*parts)
    two = partials.merge_states(partials.merge_states(*parts[:3]), parts[3])
    for x, y in zip(*(partials.column_statistics(m).orderBy("Feature").collect() for m in (one, two))):
        assert x["Kurtosis"] == pytest.approx(y["Kurtosis"], rel=1e-11) and x["Count"] == y["Count"] == 400


def test_publication_is_all_or_nothing(spark, tmp_dir):
    base = os.path.join(tmp_dir, "pub")
    df = spark.createDataFrame([(1, "a,\"b"), (2, None)], "x int, s string")
    run = publish.Run(spark, base)
    run.report(df, "r")
    run.table(df.repartition(2), "t")
    assert not publish.is_published(spark, base)
    run.commit()
    held = publish.Published(spark, base)
    second = publish.Run(spark, base)
    second.report(df.limit(1), "r")                       # stopped between two reports
    now = publish.Published(spark, base)
    assert now.id == held.id and now.verify() == [] and now.read("t").count() == 2
    third = publish.Run(spark, base)
    third.report(df.limit(1), "r")
    third.commit()
    assert held.read("r").count() == 2 and publish.Published(spark, base).read("r").count() == 1
    part = next(f for f in os.listdir(os.path.join(held.path, "t")) if f.endswith(".parquet"))
    os.unlink(os.path.join(held.path, "t", part))
    assert held.verify() == ["t"]
    assert set(publish.prune(spark, base, keep=1)) == {held.id, second.id}
    assert publish.Published(spark, base).id == third.id


def test_pipeline_stopped_between_two_reports_leaves_the_earlier_set(spark, tmp_dir, monkeypatch):
    from riskframe.plans.incidents import INCIDENT_SPEC, incidents
    from riskframe.plans.pipeline import run_pipeline

    from .conftest import SF_SMALL
    base = os.path.join(tmp_dir, "pub")
    rows = incidents(spark, SF_SMALL)
    first = run_pipeline(spark, INCIDENT_SPEC, rows, publish_dir=base, roc_bins=50)
    before = publish.Published(spark, base)
    assert before.verify() == [] and before.read("model_evaluation").count() == 16
    assert before.model().transform(before.read("prepared").withColumn("label", F.col("label").cast("double"))).count() \
        == first.stage_counts["prepared_rows"]
    report, done = publish.Run.report, []

    def stop_at_third(self, df, name):
        if len(done) == 2:
            raise RuntimeError("driver lost")
        done.append(name)
        return report(self, df, name)
    monkeypatch.setattr(publish.Run, "report", stop_at_third)
    with pytest.raises(RuntimeError, match="lost"):
        run_pipeline(spark, INCIDENT_SPEC, rows.where("l_orderkey % 2 = 0"), publish_dir=base, roc_bins=50)
    now = publish.Published(spark, base)
    assert now.id == before.id and now.verify() == []
    assert now.read("prepared").count() == first.stage_counts["prepared_rows"]
