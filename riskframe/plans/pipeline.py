"""The end-to-end job (S8): ingest -> clean -> features -> describe -> train ->
evaluate -> reports + model.

One call replaces the original two scripts plus the upload hook. The
prepared table is written to ``<output>/prepared`` (Parquet) and read back,
so later stages start from a short lineage and a columnar scan; without an
output folder it is persisted instead. The prepared row count is read from
the written Parquet footers. (``Observation`` metrics are not used: in
Spark 4.1 a session holding an observation manager makes fitted
logistic-regression models non-serialisable.)
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..functions import numeric_columns
from ..operators import clean, evaluate, features, model, stats
from ..sources import files, publish, reports
from ..sources.models import save_model
from ..spec import QUANTILE_RELATIVE_ERROR, STATS_EXCLUDED, PipelineSpec


CONCURRENT_JOBS = 4     # independent report jobs submitted at once


@dataclass
class PipelineResult:
    prepared: DataFrame
    stage_counts: dict
    descriptive: DataFrame
    severity: DataFrame
    labels: DataFrame
    histograms: DataFrame | None
    boxplot: DataFrame | None
    model: object
    predictions: DataFrame
    metrics: DataFrame
    confusion: DataFrame
    roc: DataFrame
    coefficients: DataFrame
    importance: DataFrame
    outputs: dict = field(default_factory=dict)


def enrich(cleaned: DataFrame, spec: PipelineSpec) -> DataFrame:
    """Time features and label of a cleaned table. Rows whose time does not
    parse (null Hour / Weekday / Month) are dropped here, up front, instead of
    failing the job later at feature assembly."""
    feats = cleaned
    if spec.time_col and spec.time_col in cleaned.columns:
        feats = clean.drop_nulls(features.time_features(cleaned, spec.time_col),
                                 ["Hour", "Weekday", "Month"])
    return features.binary_label(feats, spec.target, spec.severe_threshold, spec.label)


def prepare(raw: DataFrame, spec: PipelineSpec) -> DataFrame:
    """Tolerant projection, null filter, dedupe, time features, label."""
    return enrich(clean.clean_data(raw, spec.keep_columns), spec)


def run_pipeline(spark: SparkSession, spec: PipelineSpec, source: DataFrame | str,
                 output_dir: str | None = None, schema=None, roc_bins: int | None = None,
                 publish_dir: str | None = None) -> PipelineResult:
    """The whole job. ``output_dir`` gets plain folders, each overwritten by itself;
    ``publish_dir`` gets everything as one published set (``sources.publish``): readers see
    the set of the run before until this one is complete."""
    run = publish.Run(spark, publish_dir) if publish_dir else None
    raw = files.read_csv(spark, source, schema) if isinstance(source, str) else source
    clean.require_columns(raw, [spec.target])
    # one pass over the source: distinct kept rows with multiplicities give the
    # cleaned table and the stage counts together
    groups, count_df = clean.clean_with_counts(raw, spec.keep_columns)
    groups = groups.persist(StorageLevel.MEMORY_AND_DISK)
    c = count_df.first()
    counts = {"raw_rows": c["raw_rows"], "non_null_rows": c["non_null_rows"],
              "clean_rows": c["clean_rows"]}
    prepared = enrich(groups.where("_ok").drop("_n", "_ok"), spec)

    outputs: dict[str, str] = {}
    kept_on_disk = bool(output_dir or run)
    if run:
        outputs["prepared"] = run.table(prepared, "prepared")
        prepared = files.read_table(spark, outputs["prepared"])
    if output_dir:
        base = output_dir.rstrip("/")
        outputs["prepared"] = files.write_table(prepared, f"{base}/prepared")
    if kept_on_disk:
        prepared = files.read_table(spark, outputs["prepared"])
    else:
        prepared = prepared.persist(StorageLevel.MEMORY_AND_DISK)
    counts["prepared_rows"] = prepared.count()   # Parquet footers, or the cache being filled
    groups.unpersist()

    # Every report but the exact ROC is bounded (features, levels, bins, 16 metrics)
    # and is materialised once. Independent reports and the model fit are submitted
    # as concurrent Spark jobs from driver threads, so small jobs overlap
    # instead of queueing behind each other.
    def small(df):
        return None if df is None else spark.createDataFrame(df.collect(), df.schema)

    stat_features = [c for c in numeric_columns(prepared, STATS_EXCLUDED) if c != spec.label]
    hist_feats, feats = list(spec.histogram_features), list(spec.features)
    model.require_features(prepared, feats)
    clean.require_columns(prepared, hist_feats)
    with ThreadPoolExecutor(max_workers=CONCURRENT_JOBS) as pool:
        # ---- describe (A2-A10) and train (M2-M5) ----
        f_desc = pool.submit(lambda: stats.column_stats(
            prepared, stat_features, quantiles=spec.quantiles, relative_error=QUANTILE_RELATIVE_ERROR))
        f_sev = pool.submit(lambda: small(stats.severity_distribution(prepared, spec.target, spec.label)))
        f_lab = pool.submit(lambda: small(stats.distribution(prepared, spec.label)))
        f_hist = pool.submit(lambda: small(stats.histograms(prepared, hist_feats, spec.bins))
                             if hist_feats else None)
        f_box = pool.submit(lambda: small(stats.boxplot_stats(prepared, spec.boxplot_feature, by=spec.label))
                            if spec.boxplot_feature and spec.boxplot_feature in prepared.columns else None)
        f_fit = pool.submit(lambda: model.train_model(
            prepared, feats, spec.label, spec.split_key, spec.train_fraction,
            max_iter=spec.max_iter, reg_param=spec.reg_param, elastic_net=spec.elastic_net,
            threshold=spec.class_threshold))
        fitted, _, test = f_fit.result()
        predictions = model.predict(fitted, test).persist(StorageLevel.MEMORY_AND_DISK)

        # ---- evaluate (A11-A25, O2, M7) ----
        f_metrics = pool.submit(lambda: small(evaluate.metrics_long(
            evaluate.evaluation_summary(predictions, spec.label, "prediction", "p1"))))
        f_conf = pool.submit(lambda: small(evaluate.confusion_counts(predictions, spec.label, "prediction")))
        f_roc = pool.submit(lambda: small(evaluate.roc_points(predictions, spec.label, "p1", bins=roc_bins))
                            if roc_bins else evaluate.roc_points(predictions, spec.label, "p1"))
        coefs = small(model.coefficient_table(fitted, feats))
        importance = small(model.feature_importance(coefs))
        descriptive, severity, labels = f_desc.result(), f_sev.result(), f_lab.result()
        hist, box = f_hist.result(), f_box.result()
        metrics, confusion, roc = f_metrics.result(), f_conf.result(), f_roc.result()
    if roc_bins:
        predictions.unpersist()
    if not kept_on_disk:
        prepared.unpersist()

    bounded = {name: df for name, df in (
        ("descriptive_statistics", descriptive), ("severity_distribution", severity),
        ("label_distribution", labels), ("confusion_matrix", confusion), ("model_evaluation", metrics),
        ("roc_points", roc if roc_bins else None), ("feature_importance", importance), ("histograms", hist),
        ("boxplot", box)) if df is not None}
    if run:
        for name, df in bounded.items():
            outputs[name] = run.report(df, name)
        if not roc_bins:
            outputs["roc_points"] = run.table(roc, "roc_points", fmt="csv")
        outputs["model"] = run.model(fitted, feats)
        run.commit()
    if output_dir:
        base = output_dir.rstrip("/")
        for name, df in bounded.items():
            outputs[name] = reports.write_report(df, f"{base}/reports/{name}")
        if not roc_bins:                 # a row per distinct score: part files from every task
            outputs["roc_points"] = files.write_table(roc, f"{base}/reports/roc_points", fmt="csv")
        outputs["model"] = save_model(fitted, feats, f"{base}/model")

    return PipelineResult(prepared, counts, descriptive, severity, labels, hist, box, fitted,
                          model.predict(fitted, test), metrics, confusion, roc, coefs, importance,
                          outputs)
