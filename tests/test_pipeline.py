"""End-to-end job, CSV ingest and streaming ingest on incident-shaped fixtures."""

import os
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from riskframe.plans.incidents import INCIDENT_SPEC, incidents
from riskframe.plans.pipeline import run_pipeline
from riskframe.sources import files
from riskframe.spec import ACCIDENTS, accident_schema

from .conftest import SF_SMALL

WEATHER = ["Clear", "Cloudy", "Rain", "Snow"]


def _accident_rows(n, seed=0, start=datetime(2021, 3, 1)):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        sev = rnd.choice([1, 2, 2, 2, 3, 4])
        t = start + timedelta(minutes=37 * i)
        rows.append((sev, t.strftime("%Y-%m-%d %H:%M:%S"), 30 + rnd.random() * 10, -90 + rnd.random() * 10,
                     rnd.expovariate(2.0) * (sev / 2), 40 + rnd.random() * 40, 20 + rnd.random() * 80,
                     29 + rnd.random(), float(rnd.choice([2, 5, 10, 10])), rnd.random() * 20,
                     rnd.choice(WEATHER), rnd.choice(["Day", "Night"])))
    rows.append(rows[0])                                    # an exact duplicate
    rows.append((None,) + rows[1][1:])                      # a null severity
    return rows


def test_run_pipeline_accident_layout(spark, tmp_dir):
    raw = spark.createDataFrame(_accident_rows(600), accident_schema())
    src = files.write_table(raw, os.path.join(tmp_dir, "raw"), fmt="csv")
    res = run_pipeline(spark, ACCIDENTS, src, output_dir=os.path.join(tmp_dir, "out"),
                       schema=accident_schema())
    assert res.stage_counts == {"raw_rows": 602, "non_null_rows": 601, "clean_rows": 600,
                                "prepared_rows": 600}
    metrics = {r["Metric"]: r["Value"] for r in res.metrics.collect()}
    assert len(metrics) == 16
    cells = [metrics[k] for k in ("TP (Severe Accidents Detected)", "TN (Minor Accidents Detected)",
                                  "FP", "FN (Missed Severe Accidents)")]
    assert sum(cells) == res.predictions.count()
    assert {r["Feature"] for r in res.descriptive.collect()} == set(ACCIDENTS.features)
    for name in ("descriptive_statistics", "severity_distribution", "model_evaluation", "roc_points",
                 "feature_importance", "histograms", "boxplot", "model", "prepared"):
        assert name in res.outputs
    back = spark.read.option("header", True).csv(res.outputs["model_evaluation"])
    assert back.count() == 16


def test_exact_roc_is_not_written_by_one_task(spark, tmp_dir, monkeypatch):
    from riskframe.sources import reports
    written, write = [], reports.write_report
    monkeypatch.setattr(reports, "write_report", lambda df, path: written.append(os.path.basename(path)) or write(df, path))
    raw = spark.createDataFrame(_accident_rows(300), accident_schema())
    for bins in (None, 20):
        written.clear()
        res = run_pipeline(spark, ACCIDENTS, raw, output_dir=os.path.join(tmp_dir, f"roc{bins}"), roc_bins=bins)
        assert ("roc_points" in written) == bool(bins) and "model_evaluation" in written
        back = reports.read_report(spark, res.outputs["roc_points"], "threshold double, fpr double, tpr double")
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, res.roc.collect()))


def test_run_pipeline_on_tables(spark):
    res = run_pipeline(spark, INCIDENT_SPEC, incidents(spark, SF_SMALL))
    assert res.metrics.count() == 16
    assert res.importance.count() == len(INCIDENT_SPEC.features)


def test_streaming_ingest(spark, tmp_dir):
    from riskframe.streaming.ingest import incident_stream, start_ingest, start_severity_counts
    landing = os.path.join(tmp_dir, "landing")
    rows = _accident_rows(200, seed=4)
    schema = accident_schema()
    for k, part in enumerate((rows[:120], rows[120:])):
        spark.createDataFrame(part, schema).coalesce(1).write.option("header", True).csv(
            os.path.join(landing, f"drop{k}"))
    # the file source reads a flat folder: move part files up (written under /tmp only)
    flat = os.path.join(tmp_dir, "flat")
    os.makedirs(flat)
    for k in range(2):
        d = os.path.join(landing, f"drop{k}")
        for f in os.listdir(d):
            if f.endswith(".csv"):
                os.link(os.path.join(d, f), os.path.join(flat, f"drop{k}-{f}"))
    stream = incident_stream(spark, flat, schema, ACCIDENTS, max_files_per_trigger=1)
    q1 = start_ingest(stream, os.path.join(tmp_dir, "table"), os.path.join(tmp_dir, "ck1"))
    q1.awaitTermination(120)
    q2 = start_severity_counts(stream, "Severity", os.path.join(tmp_dir, "sev"), os.path.join(tmp_dir, "ck2"))
    q2.awaitTermination(120)
    table = spark.read.parquet(os.path.join(tmp_dir, "table"))
    assert table.count() == 200          # duplicate and null-severity rows removed
    assert set(["Hour", "Weekday", "Month", "label"]) <= set(table.columns)
    sev = spark.read.option("header", True).schema("Severity int, count bigint").csv(os.path.join(tmp_dir, "sev"))
    assert sev.agg(F.sum("count")).first()[0] == 200


def test_category_features_indexed_on_train_only(spark):
    from riskframe.operators import features, model
    raw = spark.createDataFrame(_accident_rows(300, seed=9), accident_schema())
    df = features.binary_label(raw)
    feats = ["Distance(mi)", "Weather_Condition_idx", "Sunrise_Sunset_idx"]
    fitted, train, test = model.train_model(df, feats, "label")
    assert len(fitted.stages) == 4
    out = model.predict(fitted, test)
    assert out.where(F.col("Weather_Condition_idx").isNull()).count() == 0
    assert model.coefficient_table(fitted, feats).count() == 4


def test_csv_malformed_values_become_nulls(spark, tmp_dir):
    from riskframe import api
    path = os.path.join(tmp_dir, "raw.csv")
    header = "Severity,Start_Time,Start_Lat,Start_Lng,Distance(mi),Temperature(F),Humidity(%),Pressure(in)," \
             "Visibility(mi),Wind_Speed(mph),Weather_Condition,Sunrise_Sunset\n"
    good = "3,2021-05-01 10:00:00,30.1,-90.2,0.5,70,50,29.9,10,5,Rain,Day\n"
    bad_num = "2,2021-05-01 11:00:00,30.1,-90.2,abc,70,50,29.9,10,5,Clear,Night\n"
    bad_time = "4,not-a-time,30.1,-90.2,0.7,70,50,29.9,10,5,Clear,Night\n"
    with open(path, "w") as f:
        f.write(header + good + bad_num + bad_time)
    raw = api.load_data(spark, path)
    assert raw.count() == 3
    prepared = api.feature_engineering(api.clean_data(raw))
    rows = prepared.collect()
    assert len(rows) == 2                       # the non-numeric distance is a null, dropped
    by_sev = {r["Severity"]: r for r in rows}
    assert by_sev[3]["Hour"] == 10 and by_sev[4]["Hour"] is None   # bad time: null features, no failure


def test_pipeline_drops_unparseable_times(spark, tmp_dir):
    rows = _accident_rows(300, seed=3)
    rows[5] = (rows[5][0], "not a time") + rows[5][2:]
    raw = spark.createDataFrame(rows, accident_schema())
    res = run_pipeline(spark, ACCIDENTS, raw)
    assert res.stage_counts["clean_rows"] == 300 and res.stage_counts["prepared_rows"] == 299
    assert res.metrics.count() == 16


def test_stream_keeps_out_of_order_history_and_runs_pipeline(spark, tmp_dir):
    from riskframe.streaming.ingest import incident_stream, start_pipeline_on_arrival
    schema = accident_schema()
    newer = _accident_rows(150, seed=11, start=datetime(2023, 1, 1))[:150]
    older = _accident_rows(150, seed=12, start=datetime(2017, 1, 1))[:150]
    flat = os.path.join(tmp_dir, "drops")
    os.makedirs(flat)
    for k, part in enumerate((newer, older)):            # history arrives after newer data
        d = os.path.join(tmp_dir, f"w{k}")
        spark.createDataFrame(part, schema).coalesce(1).write.option("header", True).csv(d)
        for f in os.listdir(d):
            if f.endswith(".csv"):
                os.link(os.path.join(d, f), os.path.join(flat, f"{k}-{f}"))
    stream = incident_stream(spark, flat, schema, ACCIDENTS, max_files_per_trigger=1)
    q = start_pipeline_on_arrival(stream, ACCIDENTS, os.path.join(tmp_dir, "table"),
                                  os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"))
    q.awaitTermination(300)
    assert q.exception() is None
    assert spark.read.parquet(os.path.join(tmp_dir, "table")).count() == 300
    m = spark.read.option("header", True).csv(os.path.join(tmp_dir, "out", "reports", "model_evaluation"))
    assert m.count() == 16
