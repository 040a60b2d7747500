"""Benchmark decontamination by a generalised suffix automaton of the test items.

Texts are normalised (A-Z lower-cased; words are runs of digits, letters a-z and
non-ASCII characters). The items' words build one suffix automaton for all items (a
*generalised* one); each document's words are streamed through it, which tracks the
longest match with any item that ends at each word. A match of ``window`` words, or of a
whole shorter item, is a hit; hit words form spans, and documents are cut or dropped by
span length and coverage limits.

The benchmark is taken in blocks of at most ``block_bytes`` of text, each counted before
it is collected, so what is broadcast has a fixed bound however many items there are and
whatever ids they share; each block is matched against all documents. Items of more than
``block_bytes / 16`` words are taken in overlapping pieces; a piece of such long words that
it alone is above the bound is a block of its own.

Defined cases: a null or empty text (document or item) has no word; items without words
never match; repeated items are items of their own; items that share an id count once;
null item ids match but are not listed; repeated document rows each give a row; empty
tables give empty results or no hits. Other columns are ignored or, in
:func:`decontaminate`, passed through, whatever their names.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept, narrow, packed, ship, text_key, written

# normalisation: A-Z to a-z; every other ASCII byte that is no digit or letter to a space
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
             for b in range(256))
HITS = ("doc_id long, text_key long, n_words long, longest long, "
        "spans array<struct<first:long,last:long>>, items array<string>")


def fold_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


class Automaton:
    """Suffix automaton over the word sequences of several items."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for item, words in items:
            if words:
                seq = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
                coded.append((item, seq))
                last = 0
                for c in seq:
                    last = self._extend(last, c)
        # items by the state of each of their windows; short items by the state they end in
        self.items: dict[int, set] = {}
        self.short: dict[int, list[tuple[int, str | None]]] = {}
        self.shortest = min([window, *(len(s) for _, s in coded)])
        for item, seq in coded:
            v = 0
            for i, c in enumerate(seq):
                v = self.next[v][c]
                if i + 1 >= window:
                    self.items.setdefault(self.window_state(v), set()).add(item)
            if len(seq) < window:
                self.short.setdefault(v, []).append((len(seq), item))

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:                       # seen before: split the state if it is longer
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        k = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = k
            p = link[p]
        link[q] = k
        return k

    def window_state(self, v: int) -> int:
        """The state that holds the last ``window`` words of what ends in ``v``."""
        while self.length[self.link[v]] >= self.window:
            v = self.link[v]
        return v

    def match(self, words: list[bytes]):
        """-> (longest match, hit spans [first, last] merged, item ids)."""
        import numpy as np
        spans, found, longest = [], set(), 0
        if len(words) < self.shortest or not self.vocab:
            return 0, spans, found
        get = self.vocab.get
        code = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
        known = np.concatenate(([False], code >= 0, [False]))
        edge = np.flatnonzero(known[1:] != known[:-1])
        nxt, link, length, w = self.next, self.link, self.length, self.window
        for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if hi - lo < self.shortest:          # a match never leaves the items' words
                continue
            v = n = 0
            for i, c in enumerate(code[lo:hi].tolist(), lo):
                while v and c not in nxt[v]:
                    v = link[v]
                    n = length[v]
                if c in nxt[v]:
                    v = nxt[v][c]
                    n += 1
                else:
                    n = 0
                if n > longest:
                    longest = n
                first = i + 1
                if n >= w:
                    found |= self.items[self.window_state(v)]
                    first = i - w + 1
                if self.short:
                    u = v
                    while u > 0:
                        for k, item in self.short.get(u, ()):
                            if k <= n:
                                found.add(item)
                                first = min(first, i - k + 1)
                        u = link[u]
                if first <= i:
                    while spans and first <= spans[-1][1] + 1:
                        first = min(first, spans.pop()[0])
                    spans.append((first, i))
        return longest, spans, found


def item_pieces(items: DataFrame, id_col: str, text_col: str, window: int, piece_words: int) -> DataFrame:
    """``(item_id, piece, words)``: items as normalised words, long ones in pieces that
    overlap by a window less a word, so no window is lost."""
    ship(items.sparkSession)
    rows = items.select(F.col(f"`{id_col}`").cast("string").alias("item_id"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = pa.schema([("item_id", pa.string()), ("piece", pa.int32()), ("words", pa.binary())])

    def cut(batches):
        for b in batches:
            out = []
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = fold_words(text)
                step = max(piece_words, 2 * window) - (window - 1)
                for k, i in enumerate(range(0, max(1, len(words) - window + 1), step)):
                    out.append((item, k, b" ".join(words[i:i + step + window - 1])))
            yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], schema.field(j).type)
                                              for j in range(3)], schema=schema)

    return rows.mapInArrow(cut, "item_id string, piece int, words binary").where("length(words) > 0")


def blocks_of(pieces: DataFrame, block_bytes: int) -> list[DataFrame]:
    """``pieces`` (distinct rows) in blocks of at most ``block_bytes`` of words, or of one row:
    dealt to buckets by their hash, finer until each fits, and the buckets packed. Buckets
    with their sizes are what reaches the driver."""
    place = F.xxhash64("item_id", "words")
    size = F.sum(F.length("words"))
    total = pieces.agg(size).first()[0] or 0
    if total <= block_bytes:
        return [pieces]
    n = 16 * -(-total // block_bytes)
    while True:
        bucket = F.pmod(place, F.lit(n).cast("long"))
        sizes = pieces.groupBy(bucket.alias("k")).agg(size.alias("size"), F.count("*").alias("c")).collect()
        if n > 1 << 60 or all(r["size"] <= block_bytes or r["c"] == 1 for r in sizes):
            break
        n *= 4
    packs: list[list] = []                # [size, buckets]
    for r in sorted(sizes, key=lambda r: (-r["size"], r["k"])):
        fit = next((p for p in packs if p[0] + r["size"] <= block_bytes), None)
        if fit is None:
            packs.append(fit := [0, []])
        fit[0] += r["size"]
        fit[1].append(r["k"])
    return [pieces.where(bucket.isin(ks)) for _, ks in packs]


def find_hits(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id",
              text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
              block_bytes: int = 2 << 20) -> DataFrame:
    """Per document row: ``(doc_id, text_key, n_words, longest, spans, items)``: spans of
    hit words (first and last word, 0-based, merged) and the sorted ids of the items whose
    windows occur."""
    spark = docs.sparkSession
    rows = narrow(docs, id_col, text_col).withColumn("text_key", text_key(F.col("text")))
    # equal words of one id are found alike: one row of them is enough
    pieces = written(item_pieces(items, item_id_col, item_text_col, window, block_bytes // 16)
                     .select("item_id", "words").distinct(), "items")

    passes = []
    for part in blocks_of(pieces, block_bytes):
        block = [(r.item_id, bytes(r.words)) for r in part.collect()]
        held = spark.sparkContext.broadcast(block)
        passes.append(rows.mapInArrow(_matcher(held, window), HITS))
    blocks = len(passes)
    if blocks == 1:
        return passes[0]
    every = passes[0]
    for p in passes[1:]:
        every = every.union(p)
    # the blocks' findings of a document together; equal rows stay as many as they were
    merged = every.groupBy("doc_id", "text_key").agg(
        F.max("n_words").alias("n_words"), F.max("longest").alias("longest"),
        F.sort_array(F.flatten(F.collect_set("spans"))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        (F.count("*") / blocks).cast("int").alias("_n"))
    merged = merged.select("*", F.explode(F.sequence(F.lit(1), F.col("_n")))).drop("_n", "col")
    return merged.mapInArrow(_merge_spans, HITS)


def _matcher(held, window: int):
    def match(batches):
        from . import decontaminate as own
        auto = own.automaton(held, window)
        for b in batches:
            out = []
            for doc, text, key in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                words = own.fold_words(text.as_py())
                longest, spans, items = auto.match(words)
                out.append((doc, key, len(words), longest, [{"first": a, "last": z} for a, z in spans],
                            sorted(x for x in items if x is not None)))
            yield _hits_batch(out)
    return match


def _merge_spans(batches):
    for b in batches:
        out = []
        for r in b.to_pylist():
            spans = []
            for s in r["spans"]:
                if spans and s["first"] <= spans[-1]["last"] + 1:
                    spans[-1]["last"] = max(spans[-1]["last"], s["last"])
                else:
                    spans.append(dict(s))
            out.append((r["doc_id"], r["text_key"], r["n_words"], r["longest"], spans, r["items"]))
        yield _hits_batch(out)


def _hits_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64()),
             ("longest", pa.int64()),
             ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
             ("items", pa.list_(pa.string()))]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(types)],
                                      schema=pa.schema(types))


def automaton(held, window: int) -> Automaton:
    """The block's automaton, built once per worker process (one block is kept)."""
    return kept("automaton", (hash(tuple(held.value)), window),
                lambda: Automaton([(i, w.split()) for i, w in held.value], window))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, max_coverage: float = 0.5,
                  min_span: int = 1, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` without contamination, in its own columns: a document whose hit words are
    more than ``max_coverage`` of its words is dropped; from the others every span of at
    least ``min_span`` hit words is cut out of the text (from its first word's first to its
    last word's last character). Texts without hits are untouched."""
    h = find_hits(docs, items, window, id_col, text_col, **kw)
    size = lambda s: s["last"] - s["first"] + 1
    h = h.select("doc_id", "text_key", "n_words",
                 F.filter("spans", lambda s: size(s) >= min_span).alias("spans"))
    h = h.withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + size(s)))
    # only hit documents travel to the join; rows that share id and text share their spans
    h = written(h.where("n_hit > 0").select(
        F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), "spans",
        (F.col("n_hit") > F.lit(max_coverage) * F.col("n_words")).alias("dropped")
    ).dropDuplicates(["hit_id", "hit_key"]), "hits")
    rows = packed(docs, id_col, text_col)
    j = rows.join(h, F.col("doc_id").eqNullSafe(F.col("hit_id"))
                  & (text_key(F.col("text")) == F.col("hit_key")), "left")
    j = j.where("dropped is null or not dropped")
    new = _cut_spans(F.when(F.col("spans").isNotNull(), F.col("text")), "spans")
    text = F.when(F.col("spans").isNull(), F.col(f"row.`{text_col}`")).otherwise(new)
    return j.select(*[(text.alias(c) if c == text_col else F.col(f"row.`{c}`")) for c in docs.columns])


@F.udf(T.StringType(), useArrow=True)
def _cut_spans(text, spans):
    if text is None:
        return None
    raw = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(FOLD))]
    out, pos = [], 0
    for s in spans:
        out.append(raw[pos:places[s["first"]][0]])
        pos = places[s["last"]][1]
    return (b"".join(out) + raw[pos:]).decode("utf-8", "surrogatepass")
