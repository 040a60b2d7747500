"""The job on a growing table, batch by batch (P3, S8): nothing stored is read again.

Each batch is cleaned, stripped of every row that history already holds (``ledger``), and
appended as a folder of its own. Its partial state (``operators.partials``) is merged with
the state of the batch before, and the reports of the merged state are published as one
set (``sources.publish``). A batch reads its own rows, the ledger's keys and one small
state; the rows of earlier batches are never opened.

Every step may be repeated: rows and state of a batch are written to folders named by it,
and the ledger ignores a batch's own keys when it is tried again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import evaluate, partials
from ..sources import publish
from .ingest import _stream_checkpoint
from .ledger import KEYS, Ledger


class IncrementalJob:
    """``features`` get statistics, ``levels`` distributions, ``histograms`` cells; ``score``
    (rows -> rows with ``label``, ``prediction`` and ``p1``) gives the evaluation. Reports are
    published after every batch, or when ``publish`` is called if ``publish_each`` is off."""

    def __init__(self, spark: SparkSession, base: str, features: Sequence[str], levels: Sequence[str] = (),
                 histograms: Sequence[str] = (), bins: int = 30, score: Callable[[DataFrame], DataFrame] | None = None,
                 score_bins: int = 1000, buckets: int | None = None, publish_each: bool = True):
        self.spark, self.base = spark, base.rstrip("/")
        self.features, self.levels, self.histograms = list(features), list(levels), list(histograms)
        self.bins, self.score, self.score_bins, self.publish_each = bins, score, score_bins, publish_each
        self.ledger = Ledger(spark, f"{self.base}/ledger", buckets)

    # ---- tables ----

    def _state_path(self, batch: int) -> str:
        return f"{self.base}/state/batch={batch:012d}"

    def _rows_path(self, batch: int) -> str:
        return f"{self.base}/rows/batch={batch:012d}"

    def state_before(self, batch: int | None = None) -> DataFrame | None:
        """The last finished state (before ``batch``), or None."""
        for name in reversed(publish.folders(self.spark, f"{self.base}/state")):
            if ((batch is None or int(name.split("=")[1]) < batch)
                    and publish.exists(self.spark, f"{self.base}/state/{name}/_SUCCESS")):
                return self.spark.read.schema(partials.STATE).parquet(f"{self.base}/state/{name}")
        return None

    def rows(self, schema=None) -> DataFrame:
        """Every row stored so far."""
        r = self.spark.read.option("basePath", f"{self.base}/rows")
        return (r.schema(schema) if schema is not None else r).parquet(f"{self.base}/rows/batch=*").drop("batch")

    # ---- one batch ----

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Take one batch of prepared rows in."""
        columns = batch.columns
        path = self._rows_path(batch_id)
        self.ledger.unseen(batch, batch_id, columns).write.mode("overwrite").parquet(path)
        new = self.spark.read.parquet(path)              # this batch's rows, and only those
        self.ledger.add(new, batch_id)
        before = self.state_before(batch_id)
        after = self._partial(new.drop(*KEYS), before)
        after.coalesce(1).write.mode("overwrite").parquet(self._state_path(batch_id))
        self.ledger.compact()
        if self.publish_each:
            self.publish()

    def _partial(self, rows: DataFrame, before: DataFrame | None) -> DataFrame:
        moments = partials.moments_state(rows, self.features)
        parts = [partials.rows_state(rows), moments]
        edges = partials.edges_of(before) if before is not None else {}
        missing = [f for f in self.histograms if f not in edges]
        if missing:                                      # ranges come from the first batch with values
            own = partials.edges_state(moments.where(F.col("feature").isin(missing)), self.bins)
            edges = {**edges, **partials.edges_of(own)}
            parts.append(own)
        parts.append(partials.cells_state(rows, edges))
        parts += [partials.levels_state(rows, c) for c in self.levels]
        if self.score:
            parts.append(partials.evaluation_state(self.score(rows), score_bins=self.score_bins))
        if before is not None:
            parts.append(before)
        return partials.merge_states(*parts)

    # ---- reports ----

    def reports(self) -> dict[str, DataFrame]:
        state = self.state_before()
        out = {"rows": partials.row_count(state), "column_statistics": partials.column_statistics(state)}
        out |= {f"{c}_distribution": partials.level_counts(state, c, "string") for c in self.levels}
        if self.histograms:
            out["histograms"] = partials.histogram_cells(state)
        if self.score:
            one = partials.evaluation(state).withColumn("auc_roc", F.col("auc_mid"))
            out["evaluation"] = evaluate.metrics_long(one)
        return out

    def publish(self) -> dict:
        run = publish.Run(self.spark, f"{self.base}/published")
        for name, df in self.reports().items():
            run.report(df, name)
        manifest = run.commit()
        publish.prune(self.spark, f"{self.base}/published", keep=2)
        return manifest

    def published(self) -> publish.Published:
        return publish.Published(self.spark, f"{self.base}/published")

    def start(self, stream: DataFrame, checkpoint_dir: str | None = None, available_now: bool = True,
              interval: str = "1 minute", name: str = "incremental-job") -> StreamingQuery:
        """Run on a stream of prepared rows (``ingest.incident_stream`` with
        ``dedupe_within=None``: the ledger does that over the whole history)."""
        checkpoint_dir = _stream_checkpoint(stream, name, checkpoint_dir)
        w = stream.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint_dir)
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
        return w.start()
