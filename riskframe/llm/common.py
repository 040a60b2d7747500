"""Helpers shared by the operators: table access, row keys, shared scratch tables."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_dir

SPACE = r"[\x20\x09-\x0D]+"          # the white space that ends a word


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """Place of a public vocabulary file (read in place, never copied)."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


_KEPT: dict = {}


def kept(kind: str, key, make):
    """What a worker process keeps between tasks (a memo, an automaton): one thing at a
    time. The next kind, or another key, takes the place of the last, so what the operators
    of a long job keep does not add up in reused workers."""
    if (kind, key) not in _KEPT:
        release()
        _KEPT[kind, key] = make()
    return _KEPT[kind, key]


def release() -> None:
    """Let go of what the worker keeps: for tasks that keep nothing themselves."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()
        _give_back()


def _give_back() -> None:
    """Hand freed memory to the system, where the C library can."""
    import ctypes
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


_SHIPPED: set[str] = set()
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Give the workers this package (once per application): their search path need not
    hold the driver's. Unless the application sets it itself, what goes to a worker at once
    is 4 MB: every running task holds such a batch in the JVM (twice while it grows) and in
    the worker, and 64 MB of whole texts would be most of what an executor has to spare."""
    if not spark.sparkContext.getConf().contains(BATCH):
        spark.conf.set(BATCH, "4m")
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="code-"), "engine_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    f = os.path.join(folder, n)
                    z.write(f, os.path.relpath(f, os.path.dirname(root)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir}/{name}.parquet")


def narrow(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (long) and text (string) columns, whatever else the input carries."""
    ship(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Whole rows in one struct column ``row`` beside id and text, so that no column of
    the input can clash with a helper; ``select("row.*")`` gives them back."""
    ship(docs.sparkSession)
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))


def text_key(text: Column) -> Column:
    """Tells apart rows that share an id but not a text (null and empty differ too)."""
    return F.xxhash64(text, F.length(text))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, survives lost
    executors, gives the planner true sizes."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more, and let the driver drop what it
    still holds of finished jobs, so that Spark's cleaner removes their shuffle files."""
    jvm = spark.sparkContext._jvm
    for t in tables:
        p = jvm.org.apache.hadoop.fs.Path(t.scratch_path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    gc.collect()
    jvm.System.gc()


def shared_folder(spark: SparkSession, name: str) -> str:
    ensure_checkpoint_dir(spark)
    return scratch_dir(spark, name)


def row_slices(offsets, max_bytes: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Cut a batch of rows into runs of at most ``max_bytes`` of text (one row at least)."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = lo + 1
        while hi < n and offsets[hi + 1] - offsets[lo] <= max_bytes:
            hi += 1
        yield lo, hi
        lo = hi


def arrow_schema(df_or_ddl) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string
    s = df_or_ddl if isinstance(df_or_ddl, StructType) else _parse_datatype_string(df_or_ddl)
    return to_arrow_schema(s)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for undirected ``(a, b)`` long edges; the component is its
    smallest node. Large-star / small-star rounds over DataFrames: each round moves
    every node's links to the smallest neighbour, so the depth shrinks geometrically and
    no component is ever gathered in a task or on the driver. Raises if it has not
    settled after ``max_rounds`` (never returns a partial answer)."""
    cur = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .where("u <> v").distinct(), "cc")
    for _ in range(max_rounds):
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        nxt = written(small, "cc")
        # settled: the same links as before (a star round that changes nothing is a fixpoint)
        sums = [d.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
                for d in (cur, nxt)]
        cur = nxt
        if tuple(sums[0]) == tuple(sums[1]):
            return (cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
                    .union(cur.select(F.col("v").alias("node"), F.col("v").alias("component")))
                    .groupBy("node").agg(F.min("component").alias("component")))
    raise RuntimeError(f"components have not settled after {max_rounds} rounds")
