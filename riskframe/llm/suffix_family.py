"""Suffix-array dedup by a logarithmic family of indexes.

Texts are UTF-8 bytes. The index keeps the suffixes at *sampled* places: of every window
of ``window`` bytes the place whose next ``context`` bytes have the least fingerprint (the
first such place). Equal windows sample the same place, so two suffixes that share a whole
window meet in the index, at a fraction of the size of a full suffix array.

Documents come in batches. A batch's sampled suffixes are sorted by their text (16 bytes,
then the fingerprint of ``context`` bytes) into a suffix array; equal suffix starts share
an entry with a count. The new array is merge-scanned against every level of the family
(a merge join in suffix order), which reports the suffix starts that both have; then
levels of equal size merge geometrically, as in a binary counter, so every suffix is
rewritten a logarithmic number of times.

Reported suffixes are then extended: regions (all windows that sample one place) that
occur twice are repeats as a whole; of regions that differ around the same suffix one of
each class is compared window by window with the others. Around a suffix start with up to
``group_limit`` different regions that happens in one vectorised task step on the bytes
themselves; beyond, window by window in aggregations, so no group has to fit a task.
Nothing is sampled in effect, capped or formed into pairs. A match needs two independent
64-bit fingerprints to agree.

Defined cases: null is empty; texts shorter than a window stay whole; repeated rows are
occurrences of their own, so they remove each other; null ids are ids; empty tables give
empty results. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, narrow, row_slices, text_key, written

ENTRY = "doc_id long, text_key long, lo int, hi int, left int, s1 long, s2 long, key long, region long, batch int"
ORDER = ["s1", "s2", "key"]                 # suffix order
SLICE = (1 << 19) - 1                       # bytes of text worked on at once


def sampled(data, offsets, window: int, context: int):
    """Sampled suffixes of texts laid end to end: (text, first window, last window, bytes
    before the suffix in the first window, two longs in byte order, key, region)."""
    import numpy as np

    from .fingerprints import BYTE, Runs, U, window_minima
    n = len(data)
    none = tuple(np.zeros(0, np.int64) for _ in range(6)) + (np.zeros(0, U), np.zeros(0, U))
    if n < window:
        return none
    size = np.diff(offsets)
    text = np.repeat(np.arange(len(size), dtype=np.int32), size)
    ra = Runs(BYTE[0][data], 0)
    p = np.arange(n - context + 1)
    key = ra.of(p, p + context) >> U(1)
    del ra, p
    starts = np.arange(n - window + 1)
    ok = text[:n - window + 1] == text[window - 1:]
    _, where = window_minima(key, window - context + 1)
    starts, place = starts[ok], where[:n - window + 1][ok]
    del where, ok
    if not len(starts):
        return none
    change = np.flatnonzero((np.diff(place) != 0) | (np.diff(starts) != 1)) + 1
    lo = starts[np.concatenate(([0], change))]
    hi = starts[np.concatenate((change, [len(starts)])) - 1]
    q = place[np.concatenate(([0], change))]
    t = text[lo].astype(np.int64)
    rb = Runs(BYTE[1][data], 1)
    region = rb.of(lo, hi + window) + (q - lo).astype(U)
    head = data[q[:, None] + np.arange(16)]
    s = np.ascontiguousarray(head).view(">u8").astype(U) ^ U(1 << 63)   # signed longs in byte order
    s = s.view(np.int64)
    return t, lo - offsets[t], hi - offsets[t], q - lo, s[:, 0], s[:, 1], key[q], region


def _each(batches):
    """(rows, bytes, offsets) for slices of (id, text, key, ...) batches."""
    from .fingerprints import text_bytes
    for b in batches:
        col = b.column(1).cast(pa.large_string()).fill_null("")
        for lo, hi in row_slices(text_bytes(col, 0, len(col))[1], SLICE):
            yield (b.slice(lo, hi - lo), *text_bytes(col, lo, hi))


def entries(rows: DataFrame, window: int, context: int, batches: int) -> DataFrame:
    """All sampled suffixes, marked with the batch of their document; no shuffle."""
    rows = rows.select("doc_id", "text", "text_key",
                       F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(batches)).cast("int").alias("batch"))
    names = [x.split()[0] for x in ENTRY.split(", ")]

    def find(bs):
        import numpy as np

        from .suffix_family import _each, sampled
        for b, data, offsets in _each(bs):
            t, lo, hi, left, s1, s2, key, region = sampled(data, offsets, window, context)
            t = pa.array(t)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(t), b.column(2).take(t), *(pa.array(x.astype(np.int32)) for x in (lo, hi, left)),
                 pa.array(s1), pa.array(s2), pa.array(key.view(np.int64)), pa.array(region.view(np.int64)),
                 b.column(3).take(t)], names=names)

    return rows.mapInArrow(find, ENTRY)


class Family:
    """The levels of the index: level k holds 2**k batches, each a sorted table of suffix
    starts ``(s1, s2, key, n)``; at most one table per level."""

    def __init__(self, spark: SparkSession):
        self.spark, self.levels = spark, {}
        self.parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _sorted(self, t: DataFrame, name: str) -> DataFrame:
        return written(t.repartitionByRange(self.parts, *ORDER).sortWithinPartitions(*ORDER), name)

    def add(self, batch: DataFrame) -> DataFrame:
        """Index a batch of suffixes -> keys of the suffix starts that it shares with
        itself or with what the family holds already (written)."""
        new = self._sorted(batch.groupBy(*ORDER).agg(F.count("*").alias("n")), "suffixes-new")
        found = new.where("n > 1").select("key")
        for level in self.levels.values():
            found = found.union(self.merge_scan(new, level))
        found = written(found.distinct(), "suffixes-shared")
        size = 0
        while size in self.levels:
            old = self.levels.pop(size)
            both = new.union(old).groupBy(*ORDER).agg(F.sum("n").alias("n"))
            merged = self._sorted(both, f"suffixes-level{size + 1}")
            discard(self.spark, new, old)
            new, size = merged, size + 1
        self.levels[size] = new
        return found

    @staticmethod
    def merge_scan(new: DataFrame, level: DataFrame) -> DataFrame:
        """Suffix starts that both sorted tables have."""
        return new.hint("merge").join(level.select(*ORDER), ORDER).select("key")


def _contexts(rows: DataFrame, regions: DataFrame, window: int) -> DataFrame:
    """The given regions with their bytes."""
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("lo", pa.int32()),
                        ("hi", pa.int32()), ("left", pa.int32()), ("bytes", pa.binary())])

    def cut(batches):
        import numpy as np

        from .suffix_family import _each
        for b, data, offsets in _each(batches):
            lists = b.column(3)
            n = lists.value_lengths().to_numpy()
            r = lists.flatten()
            key, lo, hi, left = (r.field(i).to_numpy() for i in range(4))
            text = np.repeat(np.arange(len(n)), n)
            first = offsets[text] + lo
            raw = data.tobytes()
            out = [raw[a:z] for a, z in zip(first.tolist(), (offsets[text] + hi + window).tolist())]
            t = pa.array(text)
            yield pa.RecordBatch.from_arrays([pa.array(key), b.column(0).take(t), b.column(2).take(t), pa.array(lo),
                                              pa.array(hi), pa.array(left), pa.array(out, pa.binary())], schema=schema)

    return _with_regions(rows, regions).mapInArrow(
        cut, "key long, doc_id long, text_key long, lo int, hi int, left int, bytes binary")


def _with_regions(rows: DataFrame, regions: DataFrame) -> DataFrame:
    per = regions.groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("key", "lo", "hi", "left")).alias("regions"))
    per = per.withColumnsRenamed({"doc_id": "r_id", "text_key": "r_key"})
    # a repeated row gives its regions repeatedly, which is right: its windows do occur twice
    return rows.join(
        per, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_key") == F.col("r_key"))).select(
        "doc_id", "text", "text_key", "regions")


SPAN = "doc_id long, text_key long, first int, end int"
_SPAN = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("first", pa.int32()), ("end", pa.int32())])


def match_regions(key, lo, hi, left, raw, offsets, window: int):
    """Runs of windows of the given regions (bytes laid end to end) that occur in another
    region with the same key at the same place: (region, first byte, end byte)."""
    import numpy as np

    from .fingerprints import BYTE, Runs, U, mix
    many = (hi - lo + 1).astype(np.int64)
    k = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    row = np.repeat(np.arange(len(many)), many)
    first = offsets[row] + k
    print_ = Runs(BYTE[1][raw], 1).of(first, first + window)
    tag = mix(key.view(U))[row] + (left[row] - k).astype(U) * U(0x9E3779B97F4A7C15)
    ids = mix(tag) ^ print_
    order = np.argsort(ids, kind="stable")
    s = ids[order]
    same = s[1:] == s[:-1]
    twice = np.zeros(len(ids), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    if not len(at):
        return (np.zeros(0, np.int64),) * 3
    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(row[at]) != 0)) + 1
    a = at[np.concatenate(([0], cut))]
    z = at[np.concatenate((cut, [len(at)])) - 1]
    return row[a], lo[row[a]] + k[a], lo[row[z]] + k[z] + window


def _match_groups(contexts: DataFrame, window: int, at_once: int = 1024) -> DataFrame:
    """Spans of regions that share a key: rows come sorted by key, groups are never cut."""
    parts = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = contexts.repartition(parts, "key").sortWithinPartitions("key")

    def match(batches):
        import numpy as np

        from .fingerprints import text_bytes
        from .suffix_family import match_regions

        def flush(t):
            t = t.combine_chunks().to_batches()
            if not t:
                return None
            t = t[0]
            key, lo, hi, left = (t.column(t.schema.get_field_index(c)).to_numpy() for c in ("key", "lo", "hi", "left"))
            raw = t.column(t.schema.get_field_index("bytes")).cast(pa.large_binary())
            data, offsets = text_bytes(raw, 0, len(raw))
            r, a, z = match_regions(key, lo.astype(np.int64), hi.astype(np.int64), left.astype(np.int64), data, offsets,
                                    window)
            r = pa.array(r)
            return pa.RecordBatch.from_arrays([t.column(1).take(r), t.column(2).take(r), pa.array(a.astype(np.int32)),
                                               pa.array(z.astype(np.int32))], schema=_SPAN)

        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            keys = held.column(0).to_numpy()
            while len(keys) > at_once:
                # up to the last group that ends within, or the first whole group
                ends = np.flatnonzero(keys[1:] != keys[:-1]) + 1
                if not len(ends):
                    break
                k = int(np.searchsorted(ends, at_once, side="right"))
                n = int(ends[max(0, k - 1)])
                yield flush(held.slice(0, n))
                held, keys = held.slice(n), keys[n:]
        if held is not None and len(held):
            yield flush(held)

    return rows.mapInArrow(match, SPAN)


def _match_windows(rows: DataFrame, regions: DataFrame, window: int) -> DataFrame:
    """The same for groups of any size: one row per window, met in aggregations."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("at", pa.int32()), ("key", pa.int64()),
                        ("left", pa.int32()), ("print", pa.int64())])

    def find(batches):
        import numpy as np

        from .fingerprints import BYTE, Runs
        from .suffix_family import _each
        for b, data, offsets in _each(batches):
            runs = Runs(BYTE[1][data], 1)
            lists = b.column(3)
            n = lists.value_lengths().to_numpy()
            r = lists.flatten()
            key, lo, hi, left = (r.field(i).to_numpy() for i in range(4))
            text = np.repeat(np.arange(len(n)), n)
            many = (hi - lo + 1).astype(np.int64)
            i = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            text, key, lo, left = (np.repeat(x, many) for x in (text, key, lo, left))
            first = offsets[text] + lo + i
            t = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(t), b.column(2).take(t), pa.array((lo + i).astype(np.int32)), pa.array(key),
                 pa.array((left - i).astype(np.int32)), pa.array(runs.of(first, first + window).view(np.int64))],
                schema=schema)

    w = written(_with_regions(rows, regions).mapInArrow(
        find, "doc_id long, text_key long, at int, key long, left int, print long"), "region-windows")
    same = ["key", "left", "print"]
    twice = w.groupBy(*same).agg(F.count("*").alias("c")).where("c > 1").drop("c")
    return w.join(twice, same).select("doc_id", "text_key", F.col("at").alias("first"),
                                      (F.col("at") + window).cast("int").alias("end"))


def repeated_spans(rows: DataFrame, window: int = 400, context: int = 160, batches: int = 4,
                   group_limit: int = 4096) -> DataFrame:
    """``(doc_id, text_key, spans)``: byte runs ``[first, end)`` covered by windows that also
    start anywhere else; documents without any left out. ``rows``: doc_id, text, text_key."""
    if not 16 <= context <= window:
        raise ValueError("context must be 16 bytes at least and not longer than a window")
    spark = rows.sparkSession
    rows = rows.where("text is not null")
    # one file a task, batches side by side: a folder a batch would sort every task's suffixes
    # and open as many files as there are batches
    every = written(entries(rows, window, context, batches), "suffixes")
    family = Family(spark)
    shared = None
    for b in range(batches):                                   # batches arrive one after the other
        found = family.add(every.where(F.col("batch") == b))
        shared = found if shared is None else shared.union(found)
    discard(spark, *family.levels.values())
    # the grouped side is written: the join then has a plain exchange on both sides, and a key
    # that holds a large part of the rows is split
    keys = written(shared.distinct(), "shared-keys")
    common = written(every.drop("batch", "s1", "s2").join(keys, "key"), "shared-suffixes")
    discard(spark, every, keys)
    rep = F.struct("doc_id", "text_key", "lo", "hi", "left")
    classes = written(common.groupBy("key", "region").agg(F.count("*").alias("n"), F.min(rep).alias("rep")),
                      "region-classes")
    whole = common.join(classes.where("n > 1").select("key", "region"), ["key", "region"]).select(
        "doc_id", "text_key", F.col("lo").alias("first"), (F.col("hi") + window).cast("int").alias("end"))
    several = classes.groupBy("key").agg(F.count("*").alias("c"), F.min("n").alias("least")).where("c > 1 and least = 1")
    several = written(several.drop("least"), "region-groups")
    pick = lambda cond: classes.join(several.where(cond).select("key"), "key").select("key", "rep.*")
    spans = whole.union(_match_groups(_contexts(rows, pick(F.col("c") <= group_limit), window), window))
    if not several.where(F.col("c") > group_limit).isEmpty():
        spans = spans.union(_match_windows(rows, pick(F.col("c") > group_limit), window))
    return spans.groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_set(F.struct("first", "end"))).alias("spans"))


def dedup_bytes(docs: DataFrame, window: int = 400, id_col: str = "doc_id", text_col: str = "text",
                **options) -> DataFrame:
    """Per row ``(doc_id, text_key, n_bytes, n_removed, n_spans, kept)``; ``kept`` is the
    remaining bytes (binary: a cut may fall inside a character)."""
    rows = narrow(docs, id_col, text_col).withColumn("text_key", text_key(F.col("text")))
    spans = written(repeated_spans(rows, window, **options), "repeated-spans")
    discard(docs.sparkSession)
    s = spans.withColumnsRenamed({"doc_id": "s_id", "text_key": "s_key"})
    j = rows.join(s, F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("text_key") == F.col("s_key")), "left")
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_bytes", pa.int64()),
                        ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def cut(batches):
        for b in batches:
            out = []
            for text, spans in zip(b.column(1), b.column(3)):
                raw = (text.as_py() or "").encode("utf-8")
                parts, pos, gone, runs, end = [], 0, 0, 0, -1
                for x in spans.as_py() or ():
                    if x["first"] > end:                       # a new maximal run
                        parts.append(raw[pos:x["first"]])
                        runs += 1
                        end = pos = x["first"]
                    if x["end"] > end:
                        gone += x["end"] - end
                        end = pos = x["end"]
                parts.append(raw[pos:])
                out.append((len(raw), gone, runs, b"".join(parts)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), *(pa.array([o[i] for o in out], schema.field(i + 2).type) for i in range(4))],
                schema=schema)

    return j.select("doc_id", "text", "text_key", "spans").mapInArrow(
        cut, "doc_id long, text_key long, n_bytes long, n_removed long, n_spans long, kept binary")
