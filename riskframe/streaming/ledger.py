"""A ledger of every row ever stored: dedupe over the whole history.

A row's key is 128 bits of hash of its values. The ledger is a table of keys in hash
buckets; a batch is shuffled into the same buckets and anti-joined bucket by bucket, so the
ledger itself is never shuffled and nothing of it comes to the driver. Its cost per batch
is one scan of 16 bytes a row; ``compact`` keeps the number of files a bucket bounded.

Each key carries the batch that brought it. A batch that is tried again ignores its own
keys, so a retry gives what the first try gave, wherever that stopped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import col
from ..session import shuffle_partitions
from ..sources import publish

KEYS = ("k1", "k2")


def row_key(df: DataFrame, columns: list[str] | None = None) -> list[Column]:
    """Two 64-bit hashes of a row's values, over the columns in both orders and salted, equal
    exactly for rows that ``distinct`` takes as equal (but for chance, 2^-128)."""
    columns = columns or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}

    def value(c):
        e = col(c)
        if isinstance(types[c], (T.DoubleType, T.FloatType)):
            e = F.when(e == 0, F.lit(0.0)).otherwise(e)              # one zero
        return e
    vals = [value(c) for c in columns]
    nulls = [col(c).isNull() for c in columns]                       # the hash skips nulls
    return [F.xxhash64(*vals, *nulls).alias(KEYS[0]),
            F.xxhash64(F.lit("second lane"), *nulls, *reversed(vals)).alias(KEYS[1])]


class Ledger:
    """The keys below ``<base>``: one bucketed table, named by ``<base>/CURRENT``."""

    def __init__(self, spark: SparkSession, base: str, buckets: int | None = None):
        self.spark, self.base = spark, base.rstrip("/")
        if publish.exists(spark, f"{self.base}/{publish.POINTER}"):
            self.version, n = publish.read_text(spark, f"{self.base}/{publish.POINTER}").split()
            self.buckets = int(n)
        else:
            self.buckets = buckets or shuffle_partitions(spark)
            self.version = self._new_version()
        self._register()

    def _new_version(self) -> str:
        version = f"keys-{uuid.uuid4().hex[:12]}"
        self._create(version)
        publish.write_text(self.spark, f"{self.base}/{publish.POINTER}", f"{version} {self.buckets}")
        return version

    def _create(self, version: str) -> str:
        name = "ledger_" + version.replace("-", "_")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({KEYS[0]} BIGINT, {KEYS[1]} BIGINT, batch BIGINT) USING parquet "
            f"CLUSTERED BY ({', '.join(KEYS)}) INTO {self.buckets} BUCKETS LOCATION '{self.base}/{version}'")
        return name

    def _register(self) -> None:
        """The table's name in this session's catalog; its files know their bucket."""
        self.name = self._create(self.version)
        self.spark.catalog.refreshTable(self.name)

    def keys(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, rows: DataFrame, batch: int, columns: list[str] | None = None) -> DataFrame:
        """Distinct ``rows`` that no other batch has brought, with their key columns."""
        columns = columns or rows.columns
        row = F.struct(*[col(c) for c in rows.columns])
        # equal rows meet in the tasks that read them, before the shuffle: ``copies`` in the
        # join's condition keeps the planner from moving the join below this aggregate
        keyed = (rows.select(*row_key(rows, columns), row.alias("row")).groupBy(*KEYS)
                 .agg(F.first("row").alias("row"), F.count("*").alias("copies")))
        seen = self.keys().where(F.col("batch") != F.lit(batch)).select(*[F.col(k).alias(f"seen_{k}") for k in KEYS])
        same = (F.col("copies") > 0) & (F.col("k1") == F.col("seen_k1")) & (F.col("k2") == F.col("seen_k2"))
        return keyed.join(seen.hint("merge"), same, "left_anti").select("row.*", *KEYS)

    def add(self, keyed: DataFrame, batch: int) -> None:
        """Append the keys of stored rows; one file a bucket."""
        (keyed.select(*KEYS, F.lit(batch).cast("long").alias("batch")).repartition(self.buckets, *KEYS)
         .write.insertInto(self.name))
        self.spark.catalog.refreshTable(self.name)

    def n_files(self) -> int:
        return publish._parts(self.spark, f"{self.base}/{self.version}")["files"]

    def compact(self, files_per_bucket: int = 16, buckets: int | None = None) -> bool:
        """Rewrite the ledger with one file a bucket once it has more than
        ``files_per_bucket`` each (or into another number of buckets); readers and a stopped
        rewrite keep the old files, which are removed after the switch."""
        if self.n_files() <= files_per_bucket * self.buckets and buckets in (None, self.buckets):
            return False
        old, old_name, old_buckets = self.version, self.name, self.buckets
        self.buckets = buckets or self.buckets
        version = f"keys-{uuid.uuid4().hex[:12]}"
        try:
            name = self._create(version)
            (self.spark.table(old_name).groupBy(*KEYS).agg(F.min("batch").alias("batch"))
             .repartition(self.buckets, *KEYS).write.insertInto(name))
        except Exception:
            self.buckets = old_buckets
            raise
        publish.write_text(self.spark, f"{self.base}/{publish.POINTER}", f"{version} {self.buckets}")
        self.version = version
        self._register()
        self.spark.sql(f"DROP TABLE IF EXISTS {old_name}")
        p, fs = publish._hadoop(self.spark, f"{self.base}/{old}")
        fs.delete(p, True)
        return True
