"""Spelling variant grouping: FM-index search schemes over the delimited vocabulary.

Words are counted once (each task counts before the shuffle). Two words one edit apart
agree on a half: of two words of which the longer has m letters, either the first
h = (m - 1) // 2 or the last h are the same. So a word is indexed under its first and its
last h letters, and asks for words of its own length and of one letter more. Spark deals
both to blocks by that half (halves with very many words are dealt over several blocks,
and asked in each). A task holds one block at a time: its words, delimited, in a
bidirectional FM-index, a wavelet matrix over each of the two Burrows-Wheeler transforms.
A search matches the half exactly from the middle out to the delimiter, turns round and
goes on across the other half allowing one replaced or inserted letter up to the other
delimiter. Its state is a pair of suffix-rank intervals, one for each direction, kept in
step. All asking words of a block take each step together.

A pair found by both halves is counted under the first. Counting and choosing forms are
aggregations; roots come from pointer doubling. Nothing is capped.

Defined cases: null and empty texts have no words; a null id counts as empty text in the
hash; repeated rows are occurrences of their own; ties go to the smallest word; an empty
table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, narrow, ship, written

UPPER = {c: c + 32 for c in range(65, 91)}
LEAST = 7                       # code points of a word
TWICE = 2                       # occurrences of a word
FACTOR = 10                     # a form is so many times more frequent
DROP = 31                       # runs whose hash this divides lose a code point
BLOCK = 20_000                  # indexed words in one block
ASK = 20_000                    # searches that go on together


def as_counted(run: str, doc_id) -> str:
    """A run as it is counted: lower-cased A-Z, and one code point less where the hash of
    document and run says so."""
    run = run.translate(UPPER)
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % DROP:
        return run
    i = h % len(run)
    return run[:i] + run[i + 1:]


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
               twice: int = TWICE) -> DataFrame:
    """``(word, n)`` of all words of at least ``least`` code points and ``twice`` occurrences."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
    long = f"[A-Za-zÀ-ÿ]{{{least},}}"      # shorter runs cannot give a word

    def count(batches):
        from .spelling import as_counted
        runs, total = re.compile(long), {}
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                here = {}
                for m in runs.finditer(text.as_py() or ""):
                    m = m.group()
                    here[m] = here.get(m, 0) + 1
                for run, n in here.items():
                    w = as_counted(run, doc_id)
                    if len(w) >= least:
                        total[w] = total.get(w, 0) + n
                if len(total) > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(total.keys()), pa.array(total.values(), pa.int64())],
                                                     schema=schema)
                    total = {}
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(total.keys()), pa.array(total.values(), pa.int64())],
                                             schema=schema)

    return (narrow(docs, id_col, text_col).mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= twice))


class Wavelet:
    """Rank, and the symbols of a range, of a sequence of small integers: one bit plane a
    level, most significant first, zeros before ones."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.bits, self.n = bits, len(seq)
        self.zeros, self.count = [], []
        cur = seq
        for k in reversed(range(bits)):
            one = (cur >> k) & 1
            self.zeros.append(len(cur) - int(one.sum()))
            self.count.append(np.concatenate(([0], np.cumsum(one))).astype(np.int32))    # ones before a place
            cur = np.concatenate((cur[one == 0], cur[one == 1]))
        place = np.bincount(seq, minlength=1 << bits)
        self.first = np.concatenate(([0], np.cumsum(place)[:-1]))        # symbols smaller than c in all

    def narrow(self, c, lo, hi):
        """For symbols ``c`` in ranges [lo, hi): (occurrences before lo, before hi, symbols
        smaller than c inside the range)."""
        a, b, base = lo, hi, np.zeros_like(lo)
        less = np.zeros_like(lo)
        for level in range(self.bits):
            one = ((c >> (self.bits - 1 - level)) & 1).astype(bool)
            cnt, z = self.count[level], self.zeros[level]
            a1, b1, s1 = cnt[a], cnt[b], cnt[base]
            less = less + np.where(one, (b - b1) - (a - a1), 0)
            a, b, base = (np.where(one, z + a1, a - a1), np.where(one, z + b1, b - b1),
                          np.where(one, z + s1, base - s1))
        return a - base, b - base, less

    def symbols(self, lo, hi):
        """Distinct symbols of ranges [lo, hi): arrays (range, symbol, occurrences before
        lo, before hi, smaller symbols inside the range), by range and symbol."""
        who = np.arange(len(lo))
        a, b, base = lo, hi, np.zeros_like(lo)
        sym = np.zeros_like(lo)
        for level in range(self.bits):
            cnt, z = self.count[level], self.zeros[level]
            a1, b1, s1 = cnt[a], cnt[b], cnt[base]
            # each range splits in its zeros and its ones, in this order
            two = lambda x, y: np.stack((x, y), axis=1).ravel()
            a, b, base = two(a - a1, z + a1), two(b - b1, z + b1), two(base - s1, z + s1)
            sym, who = two(2 * sym, 2 * sym + 1), np.repeat(who, 2)
            some = b > a
            a, b, base, sym, who = a[some], b[some], base[some], sym[some], who[some]
        size = b - a
        less = np.cumsum(size) - size
        new = np.concatenate(([True], np.diff(who) != 0)) if len(who) else np.zeros(0, bool)
        less = less - np.repeat(less[new], np.diff(np.append(np.flatnonzero(new), len(who))))
        return who, sym, a - base, b - base, less


def suffix_array(t: np.ndarray) -> np.ndarray:
    """By doubling of the sorted prefix; a suffix that ends is smaller."""
    n = len(t)
    rank, k = t.astype(np.int64), 1
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[:n - k] = rank[k:] + 1
        key = rank * (int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        s = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(s[1:] != s[:-1])))
        if rank[order[-1]] == n - 1 or k >= n:
            return order
        k *= 2


class BiIndex:
    """Bidirectional FM-index of words: of ``0 word 0 word 0 .. word 0`` and of its reverse.
    A state is (lo, lo of the reverse, size); it stands for the occurrences of a string."""

    def __init__(self, words: list[str]):
        self.words = words
        text = "\0" + "\0".join(words) + "\0"
        raw = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        self.letters = np.unique(raw)            # symbol s stands for letters[s]; 0 is the delimiter
        t = np.searchsorted(self.letters, raw)
        bits = max(1, int(len(self.letters) - 1).bit_length())
        self.n = len(t)
        self.sa = suffix_array(t)
        back = t[::-1]
        self.wave = (Wavelet(t[self.sa - 1], bits), Wavelet(back[suffix_array(back) - 1], bits))
        self.starts = np.flatnonzero(t == 0)     # delimiter before word k

    def codes(self, letters: np.ndarray) -> np.ndarray:
        """Symbols of code points; -1 where the block has no such letter."""
        at = np.searchsorted(self.letters, letters).clip(max=len(self.letters) - 1)
        return np.where(self.letters[at] == letters, at, -1)

    def whole(self, m: int):
        """The empty string, m times."""
        return np.zeros(m, np.int64), np.zeros(m, np.int64), np.full(m, self.n, np.int64)

    def extend(self, state, c, right: bool):
        """States one symbol longer at the left or right end; symbols of -1 match nothing."""
        near, far, size = (state[1], state[0], state[2]) if right else state
        w = self.wave[right]
        ok = np.maximum(c, 0)
        a, b, less = w.narrow(ok, near, near + size)
        near, far, size = w.first[ok] + a, far + less, np.where(c < 0, 0, b - a)
        return (far, near, size) if right else (near, far, size)

    def branches(self, state, right: bool):
        """All states one symbol longer: (state extended, symbol, new state)."""
        near, far, size = (state[1], state[0], state[2]) if right else state
        w = self.wave[right]
        who, c, a, b, less = w.symbols(near, near + size)
        near, far, size = w.first[c] + a, far[who] + less, b - a
        return who, c, ((far, near, size) if right else (near, far, size))

    def word_at(self, lo: np.ndarray) -> np.ndarray:
        """Words of states whose string starts with the delimiter and holds one word."""
        return np.searchsorted(self.starts, self.sa[lo])


def pick(state, at):
    return tuple(x[at] for x in state)


def search(index: BiIndex, codes: np.ndarray, longer: bool, half: int, prefix: bool):
    """Pairs (asking row, word) where the word is one replaced letter from a row of
    ``codes`` (rows of one length), or with ``longer`` one inserted letter, outside the
    first (``prefix``) or last ``half`` letters."""
    m, size = codes.shape
    out_from, step = (half, 1) if prefix else (size - half - 1, -1)
    right = prefix
    state = index.whole(m)
    row = np.arange(m)
    # the half, from the middle out to its delimiter
    ends = range(half - 1, -1, -1) if prefix else range(size - half, size)
    for j in [*ends, None]:
        state = index.extend(state, np.zeros(len(row), np.int64) if j is None else codes[row, j], not right)
        some = state[2] > 0
        state, row = pick(state, some), row[some]
    # turn round: across the other half up to its delimiter, with no error so far or one
    done_state, done_row = pick(state, slice(0, 0)), row[:0]
    places = list(range(out_from, size if prefix else -1, step))
    for j in [*places, None]:
        if j is None and not longer:
            break
        want = np.zeros(len(row), np.int64) if j is None else codes[row, j]
        who, c, new = index.branches(state, right)
        # a letter that is not the wanted one: replaces it, or stands before it
        other = (c != 0) & (c != want[who])
        fresh, fresh_row = pick(new, other), row[who[other]]
        if longer:          # one equal to the wanted letter is the same word as one inserted later
            fresh, fresh_row = _step(index, fresh, fresh_row, codes, j, right)
        done_state, done_row = _step(index, done_state, done_row, codes, j, right)
        done_state = tuple(np.concatenate(x) for x in zip(done_state, fresh))
        done_row = np.concatenate((done_row, fresh_row))
        if j is None:
            return done_row, index.word_at(done_state[0])
        state, row = _step(index, state, row, codes, j, right)
    done_state, done_row = _step(index, done_state, done_row, codes, None, right)
    return done_row, index.word_at(done_state[0])


def _step(index: BiIndex, state, row, codes, j, right):
    """One exact step: the letter of column j, or the delimiter."""
    if not len(row):
        return state, row
    c = np.zeros(len(row), np.int64) if j is None else codes[row, j]
    state = index.extend(state, c, right)
    some = state[2] > 0
    return pick(state, some), row[some]


def near_pairs(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(word, near, near_n)``: every ordered pair of different words of ``(word, n)`` (written,
    distinct words) one replaced, inserted or deleted code point apart, once."""
    spark = words.sparkSession
    ship(spark)
    blocks = max(1, -(-words.count() // block))

    def halves(df):
        """A row for each side: the half that a word of ``m`` letters and its neighbours share."""
        at = F.expr("explode(array(struct(0 as side, substring(word, 1, h) as half),"
                    " struct(1 as side, right(word, h) as half)))")
        return (df.withColumn("h", F.expr("cast((m - 1) div 2 as int)")).select("word", "n", "m", at.alias("at"))
                .select("word", "n", "m", "at.side", F.xxhash64("at.side", "m", "at.half").alias("key")))

    size = F.length("word")
    own = halves(words.withColumn("m", size))
    asks = halves(words.withColumn("m", F.explode(F.array(size, size + 1))))
    # halves with more words than a block: their words are dealt, who asks for them asks every part
    hot = written(own.groupBy("key").count().where(F.col("count") > block)
                  .select("key", F.ceil(F.col("count") / block).cast("int").alias("parts")), "spelling-hot")
    parts = F.coalesce("parts", F.lit(1))
    own = own.join(hot, "key", "left").withColumn("part", F.pmod(F.hash("word"), parts))
    asks = asks.join(hot, "key", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    where = (F.pmod(F.xxhash64("key", "part"), F.lit(blocks)) * 2 + F.col("side")).alias("block")
    cols = lambda role: [where, F.lit(role).alias("role"), "m", "word", "n"]
    rows = own.select(*cols(0)).union(asks.select(*cols(1)))
    tasks = min(2 * blocks, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.repartition(tasks, "block").sortWithinPartitions("block", "role", "m", "word")
    schema = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])

    def find(batches):
        from .spelling import BiIndex, pairs_of
        now, words, asking = None, {}, {}

        def flush():
            index = BiIndex(list(words)) if words and asking else None
            for (m, size), qs in asking.items() if index else ():
                for lo in range(0, len(qs), ASK):
                    for out in pairs_of(index, words, dict(qs[lo:lo + ASK]), m, size, now % 2 == 0):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()),
                             pa.array(out[2], pa.int64())], schema=schema)

        for b in batches:
            for at, role, m, word, n in zip(*(b.column(i).to_pylist() for i in range(5))):
                if at != now:
                    if now is not None:
                        yield from flush()
                    now, words, asking = at, {}, {}
                if role == 0:
                    words[word] = n
                else:
                    asking.setdefault((m, len(word)), []).append((word, n))
        if now is not None:
            yield from flush()

    return rows.mapInArrow(find, "word string, near string, near_n long")


def pairs_of(index: BiIndex, n_of: dict, asking: dict, m: int, size: int, prefix: bool):
    """Pairs of asking words of one length with indexed words of ``m`` letters, as columns
    (word, near, n of near); pairs of unequal lengths both ways round."""
    half, longer = (m - 1) // 2, m > size
    qs = list(asking)
    raw = np.frombuffer("".join(qs).encode("utf-32-le"), dtype="<u4")
    codes = index.codes(raw).reshape(len(qs), size)
    rows, found = search(index, codes, longer, half, prefix)
    out = ([], [], [])
    for r, k in zip(rows.tolist(), found.tolist()):
        w, v = qs[r], index.words[k]
        if not prefix and w[:half] == v[:half]:
            continue                             # counted where the first half is shared
        out[0].append(w), out[1].append(v), out[2].append(n_of[v])
        if longer:
            out[0].append(v), out[1].append(w), out[2].append(asking[w])
    yield out


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", factor: int = FACTOR,
                    block: int = BLOCK, **kw) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of the vocabulary."""
    words = written(vocabulary(docs, id_col, text_col, **kw), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = near_pairs(words, block).groupBy(F.col("word").alias("near_of")).agg(
        F.count("*").alias("n_near"), best.alias("best"))
    top = -F.col("best.less")
    found = written(
        words.join(near, F.col("word") == F.col("near_of"), "left")
        .withColumn("ok", F.coalesce(top >= factor * F.col("n"), F.lit(False)))
        .select("word", F.when(F.col("ok"), F.col("best.near")).alias("form"), "n",
                F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                F.when(F.col("ok"), top).alias("form_n")), "spelling-forms")
    roots = roots_of(found.where("form is not null").select("word", "form"))
    roots = roots.select(F.col("word").alias("root_of"), F.col("form").alias("root"))
    return found.join(roots, F.col("word") == F.col("root_of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots_of(links: DataFrame) -> DataFrame:
    """The end of every chain of ``(word, form)`` links, as ``(word, form)``. Pointer doubling:
    a form is more frequent than its word, so there is no circle and chains are short."""
    cur = written(links, "spelling-links")
    while True:
        far = cur.select(F.col("word").alias("via"), F.col("form").alias("far"))
        nxt = written(cur.join(far, F.col("form") == F.col("via"), "left").select(
            "word", F.coalesce("far", "form").alias("form"), F.col("far").isNotNull().alias("moved")), "spelling-links")
        discard(cur.sparkSession, cur)
        cur = nxt
        if cur.where("moved").isEmpty():
            return cur.select("word", "form")
        path = cur.scratch_path
        cur = cur.select("word", "form")
        cur.scratch_path = path
