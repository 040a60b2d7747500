"""Result sets that belong together, published as one.

A run writes everything (tables, reports, the model) below a folder of its own,
``<base>/runs/<id>``. ``commit`` then lists what was written in a manifest (parts, bytes,
rows, a content hash of reports) and switches ``<base>/CURRENT`` to the run by one
overwriting rename. Readers go through ``CURRENT``: they see the set before or the set
after, whole, whenever a writer stops. All files are reached by Hadoop's file system API,
so any store that Spark writes to will do.

Runs that were never committed, and old ones, are removed by ``prune``; a reader that
holds an older run is not disturbed while it is kept.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import files, models, reports

POINTER = "CURRENT"
MANIFEST = "manifest.json"


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder (none if it does not exist)."""
    p, fs = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _hadoop(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all: written aside, then renamed over."""
    p, fs = _hadoop(spark, path)
    aside = f"{path}.{uuid.uuid4().hex[:8]}.part"
    stream = fs.create(_hadoop(spark, aside)[0], True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(_hadoop(spark, aside)[0]), fs.makeQualified(p), options)


def _parts(spark: SparkSession, path: str) -> dict:
    """Number and bytes of the data files below a folder."""
    p, fs = _hadoop(spark, path)
    it, n, size = fs.listFiles(p, True), 0, 0
    while it.hasNext():
        s = it.next()
        if not s.getPath().getName().startswith(("_", ".")):
            n, size = n + 1, size + s.getLen()
    return {"files": n, "bytes": size}


def content_hash(df: DataFrame) -> str:
    """Order-free hash of a small table's rows (repeated rows count)."""
    row = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}))
    r = df.agg(F.count("*"), F.sum(row.cast("decimal(38,0)"))).first()
    return f"{r[0]}:{r[1] or 0}"


class Run:
    """One set of results in the making; nothing of it is visible before ``commit``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.id = f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:8]}"
        self.path = f"{self.base}/runs/{self.id}"
        self.entries: dict[str, dict] = {}

    def table(self, df: DataFrame, name: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> str:
        """S3: part files from every task."""
        path = files.write_table(df, f"{self.path}/{name}", fmt, "errorifexists", partition_by)
        self.entries[name] = {"kind": "table", "format": fmt, "schema": df.schema.json(), **_parts(self.spark, path),
                              "rows": files.read_table(self.spark, path, fmt, df.schema).count()}
        return path

    def report(self, df: DataFrame, name: str) -> str:
        """One CSV file of a bounded table."""
        path = reports.write_report(df, f"{self.path}/{name}")
        back = reports.read_report(self.spark, path, df.schema)
        self.entries[name] = {"kind": "report", "format": "csv", "schema": df.schema.json(),
                              **_parts(self.spark, path), "rows": back.count(), "content": content_hash(back)}
        return path

    def model(self, fitted, features: Sequence[str], name: str = "model") -> str:
        """The fitted pipeline with its coefficient table."""
        path = models.save_model(fitted, features, f"{self.path}/{name}")
        self.entries[name] = {"kind": "model", **_parts(self.spark, path)}
        return path

    def commit(self) -> dict:
        """Write the manifest and make this run the current one; -> the manifest."""
        manifest = {"run": self.id, "entries": self.entries}
        write_text(self.spark, f"{self.path}/{MANIFEST}", json.dumps(manifest, indent=1))
        write_text(self.spark, f"{self.base}/{POINTER}", self.id)
        return manifest


class Published:
    """The set that was current when this was made; later commits do not change it."""

    def __init__(self, spark: SparkSession, base: str, run: str | None = None):
        self.spark, self.base = spark, base.rstrip("/")
        self.id = run or read_text(spark, f"{self.base}/{POINTER}").strip()
        self.path = f"{self.base}/runs/{self.id}"
        self.entries = json.loads(read_text(spark, f"{self.path}/{MANIFEST}"))["entries"]

    def read(self, name: str) -> DataFrame:
        """A table or report with the schema it was written with."""
        e = self.entries[name]
        schema = T.StructType.fromJson(json.loads(e["schema"]))
        if e["kind"] == "report":
            return reports.read_report(self.spark, f"{self.path}/{name}", schema)
        return files.read_table(self.spark, f"{self.path}/{name}", e["format"], schema)

    def model(self, name: str = "model"):
        """S6."""
        return models.load_model(f"{self.path}/{name}")

    def verify(self) -> list[str]:
        """Names of entries whose files, bytes, rows or content are not those of the manifest."""
        bad = []
        for name, e in self.entries.items():
            try:
                now = _parts(self.spark, f"{self.path}/{name}")
                ok = all(now[k] == e[k] for k in now)
                if ok and e["kind"] != "model":
                    df = self.read(name)
                    ok = df.count() == e["rows"] and e.get("content") in (None, content_hash(df))
            except Exception as gone:                   # a missing folder or an unreadable file
                ok = False
                if not ("FileNotFound" in str(gone) or "FAILED_READ_FILE" in str(gone)
                        or "PATH_NOT_FOUND" in str(gone)):
                    raise
            if not ok:
                bad.append(name)
        return bad


def is_published(spark: SparkSession, base: str) -> bool:
    return exists(spark, f"{base.rstrip('/')}/{POINTER}")


def prune(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Remove the runs before the ``keep`` last ones that were committed up to the current
    one (uncommitted runs older than it go too); -> the removed ids."""
    base = base.rstrip("/")
    now = read_text(spark, f"{base}/{POINTER}").strip()
    older = [r for r in folders(spark, f"{base}/runs") if r < now]
    whole = [r for r in older if exists(spark, f"{base}/runs/{r}/{MANIFEST}")]
    kept = set(whole[len(whole) - (keep - 1):] if keep > 1 else [])
    gone = [r for r in older if r not in kept]
    for r in gone:
        p, fs = _hadoop(spark, f"{base}/runs/{r}")
        fs.delete(p, True)
    return gone
