"""The step-by-step API, run end to end on an incident-shaped fixture."""

import os

from riskframe import api
from riskframe.spec import ACCIDENT_FEATURES, accident_schema

from .test_pipeline import _accident_rows


def test_step_api_end_to_end(spark, tmp_dir):
    raw = spark.createDataFrame(_accident_rows(400, seed=2), accident_schema())
    src = api.save_output(raw, os.path.join(tmp_dir, "raw"))
    df, cols = api.preprocess(spark, src, os.path.join(tmp_dir, "prepared"))
    assert cols == ["Weather_Condition_idx", "Sunrise_Sunset_idx"]
    assert df.count() == 400
    df = api.add_label(df)
    desc, dist = api.descriptive_statistics(df)
    assert desc.count() == 5 and dist.count() == 4
    out = api.save_descriptive_to_file(df, os.path.join(tmp_dir, "results"))
    assert spark.read.option("header", True).csv(out["descriptive_statistics"]).count() == 11
    assert api.label_distribution(df).count() == 2
    assert api.feature_histogram(df, "Distance(mi)").count() == 30
    assert api.boxplot(df, "Distance(mi)").count() == 2
    fitted, pred, scaler = api.train_model(df, ACCIDENT_FEATURES)
    assert len(scaler.mean) == len(ACCIDENT_FEATURES)
    metrics, cm = api.evaluate_model(pred)
    assert len(metrics) == 16
    assert sum(r["count"] for r in cm.collect()) == pred.count()
    files = api.save_evaluation_to_file(metrics, cm, os.path.join(tmp_dir, "results"))
    assert spark.read.option("header", True).csv(files["model_evaluation"]).count() == 16
    roc = api.extract_roc_points(pred)
    assert roc.count() > 1
    assert api.feature_importance(fitted, ACCIDENT_FEATURES).count() == len(ACCIDENT_FEATURES)
    api.save_model_files(fitted, ACCIDENT_FEATURES, os.path.join(tmp_dir, "model"))
    tr, te, sc = api.prepare_features(df.limit(300), df.limit(100), ["Distance(mi)", "Hour"])
    assert "features" in tr.columns and "features" in te.columns


def test_form_category_map(spark):
    df = spark.createDataFrame([("Rain", "Night"), ("Hail", "Day"), ("Thunderstorm", None)],
                               "Weather_Condition string, Sunrise_Sunset string")
    out = [(r["Weather_Condition_idx"], r["Sunrise_Sunset_idx"])
           for r in api.lookup_form_categories(df).orderBy("Weather_Condition").collect()]
    assert out == [(0.0, 0.0), (2.0, 1.0), (5.0, 0.0)]


def test_describe_string_layout(spark):
    df = spark.createDataFrame([(3, 1.5), (1, 2.5)], "Severity int, `Distance(mi)` double")
    d, _ = api.descriptive_statistics(df, as_strings=True)
    rows = {r["summary"]: r for r in d.collect()}
    assert d.columns == ["summary", "Severity", "Distance(mi)"]
    assert rows["count"]["Severity"] == "2" and float(rows["mean"]["Distance(mi)"]) == 2.0
