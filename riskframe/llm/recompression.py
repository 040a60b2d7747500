"""Substring dedup by recompression: remove long word runs that an earlier document has.

A text's words are parsed bottom-up: the first round gives a new symbol to every run of
exactly two equal words, each later round to the pairs (left, right) whose symbols fall
into the left and right half of the alphabet. Symbols are named by 64-bit fingerprints
of what they stand for, so names agree in all tasks and no naming table is shuffled.
Whether a boundary between symbols survives a round depends only on the symbols beside it;
after the last round a symbol spans at most ``reach`` words, and a boundary is the same
wherever the ``reach`` words on both sides are the same. A window of ``window`` words is
long enough to hold such a boundary, so equal windows, wherever they stand, are parsed
alike inside and agree on the same *anchor*: the boundary whose surrounding symbols have
the least fingerprint.

Spark then compares anchors instead of windows: anchors whose surroundings occur in one
document only are dropped; equal regions (all windows of an anchor) form classes whose
first document is found by aggregation; only that document's regions are looked at window
by window, against the other classes with the same anchor. No pairs are formed, copies
cost one row per anchor, and nothing is sampled or capped. A match needs two independent
64-bit fingerprints (of the anchor's surroundings and of the region or window) to agree.

Defined cases: a null or empty text has no words; a text with fewer words than a window
stays; rows with a null id stay and remove nothing; rows that share an id never remove
each other's words; empty tables give empty results. Other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, narrow, row_slices, text_key, written

ANCHORS = "doc_id long, text_key long, lo int, hi int, left int, key long, region long"


def levels(window: int) -> tuple[int, int]:
    """Rounds of pairing and the reach for a window length: 3 * reach <= window + 1."""
    if window < 5:
        raise ValueError("windows need 5 words or more")
    rounds = 0
    while 3 * (1 << (rounds + 2)) <= window + 1:
        rounds += 1
    return rounds, 1 << (rounds + 1)


def boundaries(names, edge, rounds: int):
    """Places where a symbol starts after all rounds; ``edge[i]``: word i starts a text."""
    import numpy as np

    from .fingerprints import U, mix
    start = np.arange(len(names))
    if len(names) < 2:
        return start
    free = ~edge[1:]                                      # may join its left neighbour
    equal = np.zeros(len(names) + 1, dtype=bool)
    equal[1:-1] = (names[1:] == names[:-1]) & free
    join = equal[1:-1] & ~equal[:-2] & ~equal[2:]         # a run of exactly two
    for r in range(rounds + 1):
        if r:
            half = (mix(names + U(r)) & U(1)).astype(bool)
            join = ~half[:-1] & half[1:] & ~edge[start[1:]]
        head = np.concatenate(([True], ~join))            # symbols that stay a start
        merged = np.concatenate((join, [False]))
        new = names.copy()
        new[merged] = mix(names[merged] * U(0x9E3779B97F4A7C15) + names[np.flatnonzero(merged) + 1] + U(r + 77))
        names, start = new[head], start[head]
        if len(names) < 2:
            break
    return start


def anchors_of(data, offsets, window: int):
    """Anchors of texts laid end to end: (text, first window, last window, words before the
    anchor in the first window, key, region), windows counted from the text's first word."""
    import numpy as np

    from .fingerprints import Runs, U, window_minima, words
    rounds, reach = levels(window)
    at, _, _, (a, b) = words(data, offsets, lanes=(0, 1))
    n = len(a)
    none = tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, U), np.zeros(0, U))
    if n < window:
        return none
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    edge = np.zeros(n, dtype=bool)
    edge[at[:-1][np.diff(at) > 0]] = True
    p = boundaries(a, edge, rounds)
    p = p[(p - reach >= at[text[p]]) & (p + reach <= at[text[p] + 1])]
    ra, rb = Runs(a, 0), Runs(b, 1)
    key = np.full(n, U(0xFFFFFFFFFFFFFFFF))
    key[p] = ra.of(p - reach, p + reach) >> U(1)
    starts = np.arange(n - window + 1)
    ok = text[starts] == text[starts + window - 1]
    _, where = window_minima(key, window - 2 * reach + 1)
    anchor = where[starts + reach]                        # of the window that starts here
    starts, anchor = starts[ok], anchor[ok]
    if not len(starts):
        return none
    change = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(starts) != 1)) + 1
    lo = starts[np.concatenate(([0], change))]
    hi = starts[np.concatenate((change, [len(starts)])) - 1]
    q = anchor[np.concatenate(([0], change))]
    t = text[lo]
    region = rb.of(lo, hi + window) + (q - lo).astype(U)  # and where the anchor stands in it
    return t, lo - at[t], hi - at[t], q - lo, key[q], region


def _batches(batches, work):
    """Apply ``work(doc_ids, text_keys, data, offsets, rows)`` to slices of (id, text, key, ...) batches."""
    from .fingerprints import text_bytes
    for b in batches:
        col = b.column(1).cast(pa.large_string()).fill_null("")
        offs = text_bytes(col, 0, len(col))[1]
        for lo, hi in row_slices(offs):
            data, offsets = text_bytes(col, lo, hi)
            yield work(b.slice(lo, hi - lo), data, offsets)


def anchors(rows: DataFrame, window: int) -> DataFrame:
    """One row per anchor of ``rows`` (doc_id, text, text_key); no shuffle."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()),
                        ("left", pa.int32()), ("key", pa.int64()), ("region", pa.int64())])

    def find(batches):
        import numpy as np

        from .recompression import _batches, anchors_of

        def work(b, data, offsets):
            t, lo, hi, left, key, region = anchors_of(data, offsets, window)
            t = pa.array(t)
            return pa.RecordBatch.from_arrays(
                [b.column(0).take(t), b.column(2).take(t), *(pa.array(x.astype(np.int32)) for x in (lo, hi, left)),
                 pa.array(key.view(np.int64)), pa.array(region.view(np.int64))], schema=schema)

        yield from _batches(batches, work)

    return rows.mapInArrow(find, ANCHORS)


def _windows(rows: DataFrame, regions: DataFrame, window: int) -> DataFrame:
    """Fingerprints of the single windows of the given regions."""
    per_doc = regions.groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("key", "lo", "hi", "left")).alias("regions"))
    per_doc = per_doc.withColumnsRenamed({"doc_id": "r_id", "text_key": "r_key"})
    j = rows.join(per_doc, (F.col("doc_id") == F.col("r_id")) & (F.col("text_key") == F.col("r_key")))
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("at", pa.int32()), ("key", pa.int64()),
                        ("left", pa.int32()), ("print", pa.int64())])

    def find(batches):
        import numpy as np

        from .fingerprints import Runs, words
        from .recompression import _batches

        def work(b, data, offsets):
            at, _, _, (v,) = words(data, offsets, lanes=(1,))
            runs = Runs(v, 1)
            lists = b.column(3)
            n = lists.value_lengths().to_numpy()
            r = lists.flatten()
            key, lo, hi, left = (r.field(i).to_numpy() for i in range(4))
            text = np.repeat(np.arange(len(n)), n)
            many = (hi - lo + 1).astype(np.int64)
            i = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)   # window in its region
            text, key, lo, left = (np.repeat(x, many) for x in (text, key, lo, left))
            first = at[text] + lo + i
            t = pa.array(text)
            return pa.RecordBatch.from_arrays(
                [b.column(0).take(t), b.column(2).take(t), pa.array((lo + i).astype(np.int32)), pa.array(key),
                 pa.array((left - i).astype(np.int32)), pa.array(runs.of(first, first + window).view(np.int64))],
                schema=schema)

        yield from _batches(batches, work)

    return j.select("doc_id", "text", "text_key", "regions").mapInArrow(
        find, "doc_id long, text_key long, at int, key long, left int, print long")


def repeated_spans(docs: DataFrame, window: int = 50) -> DataFrame:
    """``(doc_id, text_key, spans)``: word runs ``[first, end)`` covered by windows that also
    start in a document with a smaller id; documents without any left out."""
    spark = docs.sparkSession
    rows = docs.where("doc_id is not null and text is not null")
    found = written(anchors(rows, window), "anchors")
    shared = found.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).where("a < z")
    common = written(found.join(shared.select("key"), "key"), "shared-anchors")
    discard(spark, found)
    classes = written(common.groupBy("key", "region").agg(
        F.min(F.struct("doc_id", "text_key", "lo", "hi", "left")).alias("rep")), "region-classes")
    first = classes.select("key", "region", F.col("rep.doc_id").alias("first_doc"))
    held = common.join(first, ["key", "region"])
    # whole regions that an earlier document has
    whole = held.where("doc_id > first_doc").select(
        "doc_id", "text_key", F.col("lo").alias("first"), (F.col("hi") + window).alias("end"))
    # of regions that differ around the same anchor: single windows, wherever the class's
    # first document has the region
    several = written(classes.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "region-groups")
    regions = held.where("doc_id = first_doc").join(several, "key").select(
        "key", "doc_id", "text_key", "lo", "hi", "left").distinct()
    single = written(_windows(rows, regions, window), "windows")
    discard(spark)
    same = ["key", "left", "print"]
    least = single.groupBy(*same).agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).where("a < z")
    parts = single.join(least.drop("z"), same).where("doc_id > a").select(
        "doc_id", "text_key", F.col("at").alias("first"), (F.col("at") + window).alias("end"))
    return whole.union(parts).groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_set(F.struct("first", "end"))).alias("spans"))


def dedup_substrings(docs: DataFrame, window: int = 50, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Per row ``(doc_id, text_key, n_words, n_removed, text)``; the text is the words that
    stay, joined by a space."""
    rows = narrow(docs, id_col, text_col).withColumn("text_key", text_key(F.col("text")))
    spans = written(repeated_spans(rows, window), "repeated-spans")
    discard(docs.sparkSession)
    s = spans.withColumnsRenamed({"doc_id": "s_id", "text_key": "s_key"})
    j = rows.join(s, (F.col("doc_id") == F.col("s_id")) & (F.col("text_key") == F.col("s_key")), "left")
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64()),
                        ("n_removed", pa.int64()), ("text", pa.string())])

    def cut(batches):
        import numpy as np
        for b in batches:
            total, gone, out = [], [], []
            for text, spans in zip(b.column(1), b.column(3)):
                text = text.as_py()
                ws = text.encode("utf-8").split() if text else []
                total.append(len(ws))
                if spans.is_valid:
                    keep = np.ones(len(ws) + 1, dtype=np.int64)
                    keep[:] = 0
                    for x in spans.as_py():
                        keep[x["first"]] += 1
                        keep[x["end"]] -= 1
                    keep = (np.cumsum(keep[:-1]) == 0).tolist()
                    ws = [w for w, k in zip(ws, keep) if k]
                gone.append(total[-1] - len(ws))
                out.append(b" ".join(ws))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(out, pa.binary()).cast(pa.string())], schema=schema)

    return j.select("doc_id", "text", "text_key", "spans").mapInArrow(
        cut, "doc_id long, text_key long, n_words long, n_removed long, text string")
