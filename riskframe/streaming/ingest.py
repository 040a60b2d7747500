"""File-drop ingest as Structured Streaming.

New CSV files landing in a folder are picked up incrementally (file source,
``availableNow`` trigger for batch-style runs or a processing-time trigger
for a long-running job), cleaned, enriched with time features and the label,
and appended to a Parquet table. The running severity distribution is a
streaming aggregate whose state is bounded by the number of severity levels.

Dedupe across files uses ``dropDuplicatesWithinWatermark`` over an
*ingestion-time* watermark: a row re-uploaded within the window is dropped,
and state is bounded by the window rather than by every row ever seen. An
event-time watermark would instead discard historical rows that arrive
after newer ones (uploads are not time-ordered). The batch job's full-row
dedupe still runs over the whole appended table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.errors import AnalysisException
from pyspark.sql.types import StringType, StructField, StructType

from ..operators import clean, features
from ..sources import files, reports
from ..session import ensure_checkpoint_dir
from ..spec import PipelineSpec


def incident_stream(spark: SparkSession, landing_dir: str, schema: StructType, spec: PipelineSpec,
                    max_files_per_trigger: int | None = None,
                    dedupe_within: str | None = "1 day") -> DataFrame:
    """Streaming DataFrame of prepared incidents (projection, null filter, time
    features, label, dedupe of rows re-ingested within ``dedupe_within``)."""
    # columns are bound by the header's names: those of the files that have landed (all as
    # text, then cast), or of the schema while the folder is empty; a later file whose
    # header differs fails its batch (enforceSchema off) instead of shifting columns
    try:
        names = spark.read.option("header", True).csv(landing_dir).columns
    except AnalysisException:
        names = []
    reader = spark.readStream.schema(StructType([StructField(n, StringType()) for n in names or schema.names]))
    reader = reader.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = files.by_name(reader.csv(landing_dir), schema)
    kept = clean.project_existing(raw, spec.keep_columns)
    tcol = spec.time_col if spec.time_col in kept.columns else None
    if tcol and dict(kept.dtypes)[tcol] == "string":
        kept = kept.withColumn(tcol, clean.parse_timestamp(tcol).cast("timestamp"))
    kept = clean.drop_nulls(kept, kept.columns)
    if dedupe_within:
        cols = kept.columns
        kept = (kept.withColumn("_ingested_at", F.current_timestamp())
                    .withWatermark("_ingested_at", dedupe_within)
                    .dropDuplicatesWithinWatermark(cols)
                    .drop("_ingested_at"))
    feats = features.time_features(kept, tcol) if tcol else kept
    return features.binary_label(feats, spec.target, spec.severe_threshold, spec.label)


def _stream_checkpoint(stream: DataFrame, name: str, checkpoint_dir: str | None) -> str:
    """Explicit folder, else ``<spark.checkpoint.dir>/streams/<name>`` (a shared folder)."""
    if checkpoint_dir:
        return checkpoint_dir
    return f"{ensure_checkpoint_dir(stream.sparkSession).rstrip('/')}/streams/{name}"


def start_ingest(stream: DataFrame, table_dir: str, checkpoint_dir: str | None = None,
                 available_now: bool = True, interval: str = "1 minute",
                 name: str = "incident-ingest") -> StreamingQuery:
    """Append the prepared stream to a Parquet table (exactly-once via the checkpoint,
    which must be a stable shared folder so a restarted job resumes where it stopped)."""
    checkpoint_dir = _stream_checkpoint(stream, name, checkpoint_dir)
    w = (stream.writeStream.format("parquet").outputMode("append")
         .option("path", table_dir).option("checkpointLocation", checkpoint_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def start_severity_counts(stream: DataFrame, target: str, report_dir: str,
                          checkpoint_dir: str | None = None, available_now: bool = True,
                          interval: str = "1 minute", name: str = "severity-counts") -> StreamingQuery:
    """Maintain the severity distribution; each micro-batch rewrites a one-file report."""
    checkpoint_dir = _stream_checkpoint(stream, name, checkpoint_dir)
    counts = stream.groupBy(target).count()

    def publish(batch: DataFrame, _batch_id: int) -> None:
        reports.write_report(batch.orderBy(target), report_dir)

    w = (counts.writeStream.outputMode("complete").foreachBatch(publish)
         .option("checkpointLocation", checkpoint_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def start_pipeline_on_arrival(stream: DataFrame, spec: PipelineSpec, table_dir: str, output_dir: str | None,
                              checkpoint_dir: str | None = None, available_now: bool = True,
                              interval: str = "1 minute", name: str = "pipeline-on-arrival",
                              publish_dir: str | None = None) -> StreamingQuery:
    """Every micro-batch of new files is appended to the prepared table, then the
    whole job (describe, train, evaluate, reports, model) re-runs on that table. With
    ``publish_dir`` its results are published as one set."""
    from ..plans.pipeline import run_pipeline
    checkpoint_dir = _stream_checkpoint(stream, name, checkpoint_dir)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        # a folder for each batch, overwritten if the batch is tried again
        batch.write.mode("overwrite").parquet(f"{table_dir}/batch={batch_id}")
        table = batch.sparkSession.read.schema(batch.schema).parquet(f"{table_dir}/batch=*")
        if not table.isEmpty():
            run_pipeline(batch.sparkSession, spec, table, output_dir, publish_dir=publish_dir)

    w = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()
