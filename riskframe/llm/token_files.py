"""Token-ID / binary output: encode documents, write their ids to shard files of patched
frame-of-reference blocks in ascending doc_id order, and read the files back.

Rows are range-partitioned and sorted by doc_id; each partition streams one shard (see
``pfor``) into the shared folder, under a name of its own attempt that is renamed once
complete, so a lost executor or a repeated task leaves no half file behind. The manifest
(one row per shard, made from what the tasks report) gives the shards' order.

Defined cases: a null or empty text has only the end id; a null doc_id comes first;
rows that share a doc_id follow each other ordered by their text; an empty table has no
shard. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cumulative import running_totals
from .common import narrow, shared_folder, tokenizer_path, written

MANIFEST = "shard int, path string, n_docs long, n_ids long"


#: Hadoop's names of a store whose files pyarrow reads under another name
SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}


def store_of(url: str):
    """(file system, path) of a shared folder's file for a task without a JVM."""
    from pyarrow import fs
    kind, _, rest = url.partition(":")
    if not rest or "/" in kind:
        return fs.LocalFileSystem(), url
    if kind == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    try:
        return fs.FileSystem.from_uri(f"{SCHEMES.get(kind, kind)}:{rest}")
    except pa.ArrowInvalid as e:
        raise ValueError(f"token shards cannot be written below {url}: tasks reach local (mounted) folders, "
                         f"hdfs, s3 and gs stores; name one in spark.checkpoint.dir or pass a folder") from e


def open_url(url: str, mode: str):
    store, path = store_of(url)
    return store.open_output_stream(path) if "w" in mode else store.open_input_file(path)


def move_url(src: str, dst: str) -> None:
    store, a = store_of(src)
    store.move(a, store_of(dst)[1])


def make_folder(spark: SparkSession, url: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(url)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def write_shards(docs: DataFrame, folder: str | None = None, vocabulary: str | None = None,
                 end_id: int = 2, shards: int | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Write ``docs`` to shard files below ``folder`` (a new shared one by default) and
    return the manifest ``(shard, path, n_docs, n_ids)``."""
    spark = docs.sparkSession
    path = vocabulary or tokenizer_path("byte_bpe_50k.json")
    out = folder or shared_folder(spark, "token-shards")
    store_of(out)                                # fails here, before any work, for an unknown store
    make_folder(spark, out)
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = narrow(docs, id_col, text_col)
    rows = rows.repartitionByRange(n, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    schema = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()),
                        ("n_ids", pa.int64())])

    def write(batches):
        import numpy as np
        from pyspark import TaskContext

        from .bpe_units import encoder
        from .pfor import Writer
        ctx, f, w = TaskContext.get(), None, None
        shard = ctx.partitionId()
        temp = f"{out}/.{shard:06d}-{ctx.taskAttemptId()}.part"
        done = f"{out}/ids-{shard:06d}.pfor"
        enc = encoder(path)
        for b in batches:
            if f is None:
                f = open_url(temp, "wb")
                w = Writer(f)
            doc_ids = b.column(0).to_pylist()
            for lo, hi, lens, ids in enc.encode(b.column(1)):
                # the end id after every document
                lens = lens + 1
                both = np.empty(int(lens.sum()), dtype=np.uint32)
                ends = np.cumsum(lens) - 1
                body = np.ones(len(both), dtype=bool)
                body[ends] = False
                both[ends] = end_id
                both[body] = ids
                w.add(doc_ids[lo:hi], lens, both)
        if w is None:
            return
        n_docs, n_ids = w.close()
        f.close()
        move_url(temp, done)
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([done]),
                                          pa.array([n_docs], pa.int64()), pa.array([n_ids], pa.int64())],
                                         schema=schema)

    return written(rows.mapInArrow(write, MANIFEST), "token-manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """Per document, from the files alone: ``(doc_id, start, n_tokens, ids_crc32, shard)``.
    ``start`` counts the ids of all documents before it. A reader holds one segment and,
    of a document that spans segments, a running checksum."""
    spark = manifest.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    m = running_totals(manifest.select("shard", "path", "n_ids"), "shard", ["n_ids"], prefix="to_")
    m = m.select("shard", "path", "n_ids", (F.col("to_n_ids") - F.col("n_ids")).alias("first"))
    m = m.repartition(tasks, "shard")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64()), ("shard", pa.int32())])

    def read(batches):
        import zlib

        import numpy as np

        from .pfor import Reader
        for b in batches:
            for row in b.to_pylist():
                with open_url(row["path"], "rb") as f:
                    r = Reader(f)
                    if r.n_ids != row["n_ids"]:
                        raise ValueError(f"{row['path']} holds {r.n_ids} ids, not {row['n_ids']}")
                    ends = np.cumsum(r.lens)
                    starts = ends - r.lens
                    crc = np.zeros(len(ends), dtype=np.int64)
                    doc, pos = 0, 0
                    for s in range(len(r.segs)):
                        ids = memoryview(r.segment(s).astype("<u4").tobytes())
                        stop = pos + len(ids) // 4
                        at = pos
                        while at < stop:
                            to = min(int(ends[doc]), stop)
                            crc[doc] = zlib.crc32(ids[4 * (at - pos):4 * (to - pos)], int(crc[doc]))
                            at = to
                            if at == ends[doc]:
                                doc += 1
                        pos = stop
                    null = r.doc_null.astype(bool)
                    for i in range(0, len(ends), 50_000):
                        j = slice(i, i + 50_000)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(r.doc_ids[j], pa.int64(), mask=null[j]),
                             pa.array(starts[j] + row["first"], pa.int64()),
                             pa.array(r.lens[j], pa.int64()), pa.array(crc[j], pa.int64()),
                             pa.array(np.full(len(ends[j]), row["shard"]), pa.int32())], schema=schema)

    return m.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard int")
