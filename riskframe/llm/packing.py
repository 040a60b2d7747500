"""Packing: best-fit decreasing into fixed windows, with a segment tree over what is left.

Every document's ids, with an end id, are cut into full windows and a rest. Rests are
packed longest first: each goes to the open window with the least room that still takes
it, which a segment tree indexed by remaining capacity finds in a climb and a descent, or
opens a new one.

A task encodes and packs the rows it reads, in bounded runs; windows that are still open
stay open for its next run. Windows filled to ``SETTLED`` are final. The others, few for
each task, meet those of other tasks in one shuffle, dealt to groups of bounded size, and
are packed again as wholes, best fit decreasing. What is then below ``SETTLED`` is laid end
to end and cut; the one last rest of a group is cut into windows whose lengths are powers
of two, which are not padded. So padding is below 1 - ``SETTLED`` of the windows whatever
the lengths of the documents, and no task holds more than a run and its open windows.

Defined cases: a null or empty text has only the end id; repeated rows and ids are
documents of their own; a null id stays null; an empty table has no piece. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import narrow, tokenizer_path, written

WINDOW = 4096
SETTLED = 0.99                  # share of a window that makes it final
RUN = 2_000_000                 # ids packed at once in a task
OPEN = 1024                     # windows that a task keeps open between runs
GROUP = 1_000_000               # ids of unsettled windows in one group of the second round
VARIANTS = 16                   # windows that one group's last rest may be cut into (bits of WINDOW)

PIECE = "doc_id long, start long, length long, ids binary, doc_tokens long"
PLACED = f"{PIECE}, sequence_id long, offset long, settled boolean"
NAMES = [c.split()[0] for c in PLACED.split(", ")]


class RoomTree:
    """Open windows by remaining capacity. ``has[node]`` tells whether any window below a
    node is open; leaf ``c`` keeps the windows with exactly ``c`` left."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.has = bytearray(2 * self.leaves)
        self.windows: list[list] = [[] for _ in range(size + 1)]

    def put(self, room: int, window) -> None:
        self.windows[room].append(window)
        i = room + self.leaves
        while i and not self.has[i]:
            self.has[i] = 1
            i >>= 1

    def take(self, need: int):
        """``(room, window)`` with the least room of at least ``need``, taken out; or None."""
        has, i = self.has, need + self.leaves
        if not has[i]:
            while i > 1 and (i & 1 or not has[i + 1]):
                i >>= 1                          # climb until a subtree to the right has one
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if has[2 * i] else 2 * i + 1
        room = i - self.leaves
        out = self.windows[room].pop()
        if not self.windows[room]:
            has[i] = 0
            i >>= 1
            while i and not has[2 * i] and not has[2 * i + 1]:
                has[i] = 0
                i >>= 1
        return room, out

    def drain(self):
        """All open windows as (room, window), fullest first; the tree is empty then."""
        out = [(room, w) for room, ws in enumerate(self.windows) for w in ws]
        for ws in self.windows:
            ws.clear()
        self.has = bytearray(len(self.has))
        return out


def best_fit(items, tree: RoomTree, size: int, new):
    """Put ``(length, item)`` pairs, longest first, into the tree's windows or new ones;
    yields the windows that are full. A window is a list of items."""
    for n, item in sorted(items, key=lambda x: -x[0]):
        got = tree.take(n)
        room, window = got if got else (size, new())
        window.append(item)
        if room == n:
            yield window
        else:
            tree.put(room - n, window)


def _placed(pieces, sequence: int, settled: bool):
    """Rows of one window: ids of a piece lie at the offset that the pieces before it leave."""
    at = 0
    for p in pieces:
        yield (*p, sequence, at, settled)
        at += p[2]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    cols = list(zip(*rows)) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=NAMES)


def _packed(rows: list[tuple], size: int = 4_000):
    for lo in range(0, len(rows), size):
        yield _batch(rows[lo:lo + size])


def pack(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, end_id: int = 2,
         id_col: str = "doc_id", text_col: str = "text", run: int = RUN, open_windows: int = OPEN,
         group: int = GROUP) -> DataFrame:
    """A row for each piece: ``(doc_id, start, length, ids, doc_tokens, sequence_id, offset)``;
    ``ids`` are little-endian unsigned 32-bit."""
    path = vocabulary or tokenizer_path("word_bpe_49k.json")
    done = int(SETTLED * window)

    def first(batches):
        from pyspark import TaskContext

        from .packing import RoomTree, _packed, _placed, best_fit
        from .word_units import word_encoder
        enc = word_encoder(path)
        base, made = TaskContext.get().partitionId() << 36, 0
        tree, rests, held, out = RoomTree(window), [], 0, []

        def sequence():
            nonlocal made
            made += 1
            return base + (made - 1) * VARIANTS

        def settle(last):
            nonlocal rests, held
            for w in best_fit(rests, tree, window, list):
                out.extend(_placed(w, sequence(), True))
            rests, held = [], 0
            left = tree.drain()
            for k, (room, w) in enumerate(left):
                full = window - room >= done
                if full or last or k < len(left) - open_windows:
                    out.extend(_placed(w, sequence(), full))
                else:
                    tree.put(room, w)

        for b in batches:
            doc_ids = b.column(0).to_pylist()
            for lo, hi, lens, ids in enc.encode(b.column(1)):
                ends = np.cumsum(lens)
                for k in range(hi - lo):
                    one = np.empty(int(lens[k]) + 1, dtype="<u4")
                    one[:-1] = ids[ends[k] - lens[k]:ends[k]]
                    one[-1] = end_id
                    n, doc = len(one), doc_ids[lo + k]
                    whole = n - n % window
                    for at in range(0, whole, window):           # overlong: full windows first
                        out.append((doc, at, window, one[at:at + window].tobytes(), n, sequence(), 0, True))
                    if n > whole:
                        rests.append((n - whole, (doc, whole, n - whole, one[whole:].tobytes(), n)))
                        held += n - whole
                    if held >= run:
                        settle(False)
                    if len(out) >= 4_000:
                        yield from _packed(out)
                        out = []
        settle(True)
        yield from _packed(out)

    placed = written(narrow(docs, id_col, text_col).mapInArrow(first, PLACED), "packing-placed")
    return placed.where("settled").drop("settled").union(
        _repack(placed.where("not settled"), window, group).drop("settled"))


def _repack(rows: DataFrame, window: int, group: int) -> DataFrame:
    """Unsettled windows packed again, as wholes, in groups of about ``group`` ids each."""
    spark = rows.sparkSession
    total = rows.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // group))
    done = int(SETTLED * window)

    def second(batches):
        from .packing import RoomTree, _packed, _placed, best_fit, end_to_end
        now, items = None, {}

        def flush():
            tree, out = RoomTree(window), []
            whole = [(sum(p[2] for p in w), (s, w)) for s, w in items.items()]
            rest = []
            for w in (*best_fit(whole, tree, window, list), *(w for _, w in tree.drain())):
                pieces = [p for _, ps in w for p in ps]
                if sum(p[2] for p in pieces) >= done:
                    out.extend(_placed(pieces, w[0][0], True))
                else:
                    rest.extend(w)
            out.extend(end_to_end([p for _, ps in rest for p in ps], [s for s, _ in rest], window))
            return _packed(out)

        for b in batches:
            for r in zip(*(b.column(i).to_pylist() for i in range(len(b.schema)))):
                if now is not None and r[0] != now:
                    yield from flush()
                    items = {}
                now = r[0]
                items.setdefault(r[6], []).append(r[1:6])
        if items:
            yield from flush()

    dealt = rows.select(F.pmod(F.xxhash64("sequence_id"), F.lit(groups)).alias("g"), *NAMES[:-1])
    tasks = max(2, min(groups, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return (dealt.repartition(tasks, "g").sortWithinPartitions("g", "sequence_id", "offset")
            .mapInArrow(second, PLACED))


def end_to_end(pieces, names: list[int], window: int):
    """Lay pieces end to end, cut at every full window; the last rest is cut into lengths
    that are powers of two. The windows take over the names of those that the pieces had."""
    total = sum(p[2] for p in pieces)
    sizes = [window] * (total // window)
    k = len(sizes)
    rest = [1 << i for i in reversed(range(window.bit_length())) if total % window >> i & 1]
    # as many names as windows, as none was full; the rest's windows share one name's variants
    marks = [*names[:k], *(names[min(k, len(names) - 1)] + i for i in range(len(rest)))]
    sizes += rest
    at, room = 0, sizes[0] if sizes else 0
    for doc, start, length, ids, tokens in pieces:
        cut = 0
        while cut < length:
            n = min(room, length - cut)
            yield (doc, start + cut, n, ids[4 * cut:4 * (cut + n)], tokens, marks[at], sizes[at] - room, True)
            cut, room = cut + n, room - n
            if not room:
                at += 1
                room = sizes[at] if at < len(sizes) else 0


def padding(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row: sequences, tokens, and the padding of sequences that are no power of two long."""
    size = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    short = F.when(F.col("n").bitwiseAND(F.col("n") - 1) == 0, 0).otherwise(F.lit(window) - F.col("n"))
    return size.agg(F.count("*").alias("sequences"), F.sum("n").alias("tokens"), F.sum(short).alias("padding"))


def sequences(pieces: DataFrame) -> DataFrame:
    """The windows themselves: ``(sequence_id, n_tokens, ids)``; a window bounds the group."""
    part = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.aggregate(part, F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
