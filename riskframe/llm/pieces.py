"""SentencePiece encoding and decoding: best segmentation by a max-plus parallel scan.

The vocabulary is a public SentencePiece file, its pieces scored as unigrams by rank
(fixed-point log of a Zipf law over the file's order), so scores are integers and sums of
them are exact in any order. A text gets the word mark in front and for every space;
characters without a piece, and word marks that the text itself holds, are spelt in byte
pieces. The segmentation with the highest score wins; ties take the shorter last piece
(the same in every chunk).

Giant documents are split into chunks. A state at a chunk's start says how many of its
characters the piece that straddles the boundary has already taken; a chunk's transfer
matrix holds the best score from every state at its start to every state at its end.
Matrices combine associatively under (max, +), in rounds over pairs of neighbours, which
gives every chunk the best scores of its entry states. From those each chunk tells, for every
state it may be left in, the state it is entered in; these maps compose the same way from
the end backwards. Then each chunk is traced back alone. Ties are settled by the same rule
in both steps, so a text has the same ids in chunks of any size.

Defined cases: null encodes to null pieces and decodes to null; an empty text to no
piece; repeated rows are encoded each by itself; empty tables give empty results. Lone
surrogates cannot occur in Spark strings. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_units import UnitMemo
from .common import kept, narrow, ship, text_key, tokenizer_path, written

MARK = "▁"
SCALE = 1000                    # fixed point: a score of 1 is a thousandth of a nat
BYTE_PENALTY = 20 * SCALE       # below any piece: bytes are the last resort
CHUNK = 1 << 15                 # characters per chunk of a giant document
NEVER = -(1 << 60)
MEMO = 400_000                  # words remembered per worker
CUT = re.compile(f"[^{MARK}](?={MARK})")
# marks or private characters, and spaces that do not stand between two words
IRREGULAR = f"[{MARK}\ue000]|  | \n|\\A[ \n]| \\z"


class Trie:
    """Pieces by their characters. All places of a text walk down together, one character a
    step; the steps ``(node, character) -> node`` are a hash table in flat arrays."""

    ODD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pieces: dict[str, int]):
        codes = {c: k for k, c in enumerate(sorted(set("".join(pieces))), 1)}
        if len(codes) >= 1 << 16:
            raise ValueError("too many different characters")
        self.code = np.zeros(max(map(ord, codes)) + 2, dtype=np.int64)    # 0: in no piece
        self.code[[ord(c) for c in codes]] = list(codes.values())
        step, piece = {}, [-1]
        for p, i in pieces.items():
            node = 0
            for c in p:
                node = step.setdefault(node << 16 | codes[c], len(piece))
                if node == len(piece):
                    piece.append(-1)
            piece[node] = i
        self.piece, self.longest = np.array(piece), max(map(len, pieces))
        bits = (8 * len(step)).bit_length()
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.nodes = np.zeros(1 << bits, dtype=np.int32)
        keys = np.array(list(step))
        for k, node, at in zip(keys.tolist(), step.values(), self._slot(keys).tolist()):
            while self.keys[at] >= 0:
                at = (at + 1) & self.last
            self.keys[at], self.nodes[at] = k, node

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * self.ODD) >> self.shift).astype(np.int64)

    def places(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first character, length, id) of every occurrence of a piece, shorter ones first."""
        raw = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        code = np.zeros(len(raw) + self.longest, dtype=np.int64)
        code[:len(raw)] = self.code[np.minimum(raw, len(self.code) - 1)]
        at = np.flatnonzero(code)
        node = np.zeros(len(at), dtype=np.int64)
        out = []
        for k in range(self.longest):
            key = node << 16 | code[at + k]
            slot = self._slot(key)
            got = self.keys[slot]
            other = np.flatnonzero((got != key) & (got >= 0))
            while len(other):
                slot[other] = (slot[other] + 1) & self.last
                got[other] = self.keys[slot[other]]
                other = other[(got[other] != key[other]) & (got[other] >= 0)]
            on = np.flatnonzero(got == key)
            at, node = at[on], self.nodes[slot[on]].astype(np.int64)
            piece = self.piece[node]
            ends = np.flatnonzero(piece >= 0)
            out.append((at[ends], np.full(len(ends), k + 1), piece[ends]))
        first, length, piece = (np.concatenate(x) for x in zip(*out))
        return first, length, piece


class Vocabulary:
    """Pieces, scores and byte pieces of a SentencePiece file."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.piece = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        self.byte_id = {int(p[3:5], 16): i for i, p in enumerate(self.piece) if sp.is_byte(i)}
        usable = [i for i in range(len(self.piece))
                  if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        total = sum(1.0 / (r + 2) for r in range(len(usable)))
        # (id, score) of each piece
        self.ids: dict[str, tuple[int, int]] = {
            self.piece[i]: (i, -round(SCALE * (math.log(r + 2) + math.log(total)))) for r, i in enumerate(usable)}
        self.longest = max(map(len, self.ids))
        byte_of = {i: b for b, i in self.byte_id.items()}
        self.bytes_of = [bytes([byte_of[i]]) if i in byte_of else p.replace(MARK, " ").encode("utf-8")
                         for i, p in enumerate(self.piece)]
        self.memo: dict[str, tuple[bytes, int]] = {}
        self.trie = Trie({p: i for p, (i, _) in self.ids.items()})
        self.scores = np.zeros(len(self.piece), dtype=np.int64)
        for i, x in self.ids.values():
            self.scores[i] = x
        if any("\n" in p or MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("units need pieces without line ends and with word marks in front only")
        self.tails = {c for c in ".,;:!?" if not any(a.isalpha() and b == c for p in self.ids for a, b in zip(p, p[1:]))}
        self.singles = {p for p in self.ids if len(p) == 1 and p != self.LITERAL}
        self.worth = self.scores.copy()                  # of every id, bytes too
        self.worth[list(byte_of)] = -BYTE_PENALTY
        self.words = Words(self)

    # private character of the marked text: before "1" a word mark, before "0" itself
    LITERAL = "\ue000"

    def marked(self, text: str) -> str:
        """Word marks for the start and for spaces; a mark or private character that the
        text holds itself is kept apart by a private prefix."""
        if MARK in text or self.LITERAL in text:
            text = text.replace(self.LITERAL, self.LITERAL + "0").replace(MARK, self.LITERAL + "1")
        return MARK + text.replace(" ", MARK)

    def spelt(self, c: str) -> list[int]:
        return [self.byte_id[b] for b in c.encode("utf-8")]

    def options(self, s: str, i: int, end: int):
        """Pieces that start at ``i`` of marked text ``s``: ``(next, score, ids)``."""
        c = s[i]
        if c == self.LITERAL and i + 1 < len(s) and s[i + 1] in "01":
            return [(i + 2, -6 * BYTE_PENALTY, self.spelt(MARK if s[i + 1] == "1" else c))]
        out = []
        get = self.ids.get
        for j in range(i + 1, min(end, i + self.longest) + 1):
            k = get(s[i:j])
            if k is not None:
                out.append((j, k[1], (k[0],)))
        if not out or out[0][0] != i + 1:
            ids = self.spelt(c)
            out.append((i + 1, -BYTE_PENALTY * len(ids), ids))
        return out

    def best(self, s: str, first: int = 0, last: int | None = None, limit: int | None = None):
        """Best path from place ``first`` to ``last`` of ``s`` by pieces that start before
        ``limit``. -> (score, ids). Ties: the path whose last piece is shorter."""
        last = len(s) if last is None else last
        score = {first: 0}
        back: dict[int, tuple[int, tuple]] = {}
        for i in range(first, last if limit is None else min(last, limit)):
            base = score.get(i)
            if base is None:
                continue
            for j, x, ids in self.options(s, i, last):
                if j <= last and (j not in score or base + x >= score[j]):
                    score[j] = base + x
                    back[j] = (i, ids)
        if last not in score:
            return NEVER, []
        out, at = [], last
        while at != first:
            at, ids = back[at]
            out.append(ids)
        return score[last], [k for ids in reversed(out) for k in ids]

    def units(self, s: str) -> list[str]:
        """Cut where no piece can straddle, so each unit stands alone on the best path:
        before every word mark that follows another character, around line ends, and between
        a letter and a final stop or comma."""
        parts = s.split(MARK)                   # the text starts with a mark: parts[0] is empty
        out, run, tails = [], 0, self.tails
        for p in parts[1:]:
            run += 1
            if not p:
                continue
            p = MARK * run + p
            run = 0
            if "\n" in p:
                lines = p.split("\n")
                out.append(lines[0])
                for x in lines[1:]:
                    out.append("\n")
                    if x:
                        out.append(x)
                p = out.pop()
            if p[-1] in tails and len(p) > 1 and p[-2].isalpha():
                out.append(p[:-1])
                out.append(p[-1])
            else:
                out.append(p)
        if run:
            out.append(MARK * run)
        return out

    def encode(self, text: str) -> tuple[np.ndarray, int]:
        """Ids and score of a text of ordinary size."""
        ids, _, score = self.encode_rows(pa.array([text], pa.large_string()))
        return ids, int(score[0])

    def encode_rows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of many texts laid end to end, their number and score by text (null: none).
        Distinct words are segmented once; irregular texts are cut by :meth:`units`."""
        rows = texts.cast(pa.large_string()).fill_null("")
        odd = pc.match_substring_regex(rows, IRREGULAR)
        plain = pc.if_else(odd, pa.scalar("", pa.large_string()), rows)
        # a word keeps the line end before it, which stands for its space
        parts = pc.split_pattern(pc.replace_substring(plain, "\n", " \n"), " ")
        offs = parts.offsets.to_numpy()
        words = parts.flatten().dictionary_encode()
        slots = self.words.slots(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        slots = slots[words.indices.to_numpy(zero_copy_only=False)]
        ids = self.words.gather(slots).astype(np.int32)
        lens = np.add.reduceat(self.words.count[slots], offs[:-1] - offs[0]) if len(slots) else np.zeros(0, np.int64)
        total = np.concatenate(([0], np.cumsum(self.worth[ids])))
        ends = np.cumsum(lens)
        score = total[ends] - total[ends - lens]
        odd_at = np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()
        if odd_at:
            out = np.split(ids, ends[:-1])
            for i, (got, x) in zip(odd_at, self.encode_many([rows[i].as_py() for i in odd_at])):
                out[i], lens[i], score[i] = got, len(got), x
            ids = np.concatenate(out)
        return ids, lens, score

    def encode_many(self, texts: list[str | None]) -> list[tuple[np.ndarray, int]]:
        """Ids and score of each text, whatever its spaces: distinct units are segmented once,
        many together."""
        split = [self.units(self.marked(t)) if t else () for t in texts]
        self.ensure(set().union(*split))
        memo = self.memo
        out = []
        for us in split:
            hits = [memo[u] for u in us]
            out.append((np.frombuffer(b"".join([h[0] for h in hits]), dtype="<i4"), sum([h[1] for h in hits])))
        return out

    def ensure(self, units: set[str]) -> None:
        """Have all of ``units`` in the memo; a full memo starts anew."""
        new = [u for u in units if u not in self.memo]
        if len(self.memo) + len(new) > MEMO:
            self.memo.clear()
            new = list(units)
        self.learn(new)

    def learn(self, units: list[str]) -> None:
        """Best segmentations of many units at once, into the memo."""
        order, ids, lens = self.segment(units)
        raw, worth = ids.tobytes(), np.concatenate(([0], np.cumsum(self.worth[ids])))
        ends = np.cumsum(lens)
        for i, a, z in zip(order, (ends - lens).tolist(), ends.tolist()):
            u = units[i]
            # what stands for a private character has a score of its own
            x = self.best(u)[0] if self.LITERAL in u else int(worth[z] - worth[a])
            self.memo[u] = (raw[4 * a:4 * z], x)

    def segment(self, units: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Best segmentations of many units at once: (units in the order of the result, ids
        laid end to end, their number by unit). All places of all pieces come from one walk
        down the trie; places are then settled in order, for all units together. Units that
        need bytes, and very long ones, go one by one."""
        singles = self.singles
        order = [i for i, u in enumerate(units) if 0 < len(u) <= 64 and singles.issuperset(u)]
        plain = set(order) if len(order) < len(units) else ()
        order.sort(key=lambda i: len(units[i]))
        ids, lens = [np.zeros(0, "<i4")], [np.zeros(0, np.int64)]
        for lo in range(0, len(order), 16_384):
            got, n = self._settle([units[i] for i in order[lo:lo + 16_384]])
            ids.append(got)
            lens.append(n)
        rest = [i for i in range(len(units)) if i not in plain] if plain or not order else []
        for i in rest:
            got = self.best(units[i])[1]
            ids.append(np.asarray(got, dtype="<i4"))
            lens.append(np.array([len(got)]))
        return order + rest, np.concatenate(ids), np.concatenate(lens)

    def _settle(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units laid end to end, and their number by unit."""
        n = np.array([len(u) for u in units])
        start = np.cumsum(n + 1) - n - 1
        first, length, piece = self.trie.places("\n".join(units))
        unit = np.searchsorted(start, first, side="right") - 1
        j = first + length - start[unit]
        key = j * 256 + 255 - length                     # by place, longer pieces first
        order = np.argsort(key.astype(np.uint16), kind="stable")
        key, j, length, unit, piece = (x[order] for x in (key, j, length, unit, piece))
        size = int(n.max()) + 1
        score = np.full((size, len(units)), NEVER, dtype=np.int64)
        score[0] = 0
        took = np.zeros((size, len(units)), dtype=np.int64)       # length and id of the last piece
        worth, taken = self.scores[piece], (length << 16) | piece
        cut = np.flatnonzero(np.diff(key)) + 1
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(key)]):
            u, at = unit[lo:hi], int(j[lo])
            best = score[at]
            x = score[at - int(length[lo])][u] + worth[lo:hi]
            win = x >= best[u]                            # ties: the shorter last piece
            u = u[win]
            best[u] = x[win]
            took[at][u] = taken[lo:hi][win]
        at, rows, steps = n.copy(), np.arange(len(units)), []
        while len(rows):
            t = took[at[rows], rows]
            steps.append((rows, t & 0xFFFF))
            at[rows] -= t >> 16
            rows = rows[at[rows] > 0]
        # steps come from the last piece to the first
        row = np.concatenate([r for r, _ in steps[::-1]])
        ids = np.concatenate([p for _, p in steps[::-1]]).astype("<i4")
        return ids[np.argsort(row, kind="stable")], np.bincount(row, minlength=len(units))

    def whole(self, s: str) -> tuple[np.ndarray, int]:
        """Ids and score of marked text that starts and ends at a cut."""
        if s[0] == MARK and self.LITERAL not in s:
            return self.encode(s[1:].replace(MARK, " "))
        us = self.units(s)
        self.ensure(set(us))
        hits = [self.memo[u] for u in us]
        return np.frombuffer(b"".join([h[0] for h in hits]), dtype="<i4"), sum([h[1] for h in hits])

    def cuts(self, s: str, n: int) -> tuple[int, int] | None:
        """First and last place in 1..n where no piece can straddle (see ``units``)."""
        at = [m.start() + 1 for m in CUT.finditer(s, 0, n + 1) if m.start() + 1 <= n]
        return (at[0], at[-1]) if at else None

    def reach(self, s: str, first: int, n: int) -> list[int]:
        """Best scores from ``first`` to places n, n+1, .. (pieces that start before ``n``
        may end beyond it)."""
        m = self.longest
        score = {first: 0}
        for i in range(first, n):
            base = score.get(i)
            if base is not None:
                for j, x, _ in self.options(s, i, len(s)):
                    if base + x > score.get(j, NEVER):
                        score[j] = base + x
        return [score.get(n + b, NEVER) for b in range(m)]

    def transfer(self, s: str, n: int) -> np.ndarray:
        """Transfer matrix of the chunk that owns ``s[:n]``; ``s`` goes on for ``longest``
        characters (or to the text's end). Entry (a, b): best score from ``a`` characters
        taken at its start to ``b`` taken beyond its end. Where the chunk has a place that
        no piece straddles, every path meets there and the matrix is an outer sum."""
        m = self.longest
        out = np.full((m, m), NEVER, dtype=np.int64)
        cut = self.cuts(s, n)
        if cut:
            lo, hi = cut
            left = [self.best(s, a, lo)[0] if a <= lo else NEVER for a in range(m)]
            mid = self.whole(s[lo:hi])[1] if hi > lo else 0
            right = self.reach(s, hi, n)
            for a, x in enumerate(left):
                for b, y in enumerate(right):
                    if x > NEVER and y > NEVER:
                        out[a, b] = x + mid + y
            return out
        for a in range(m):
            if a < n:
                out[a] = self.reach(s, a, n)
            elif a - n < m:
                out[a, a - n] = 0                # the straddling piece takes the whole chunk
        return out

    def entered(self, s: str, n: int, front: np.ndarray):
        """Scores and last pieces of the places of a chunk, from the best scores ``front`` of its
        entry states. A place whose last piece is None is an entry: the piece that ends there
        began before the chunk (at equal scores a piece of the chunk, being shorter, wins)."""
        score = {a: int(x) for a, x in enumerate(front) if x > NEVER}
        back: dict = dict.fromkeys(score)
        for i in range(n):
            base = score.get(i)
            if base is None:
                continue
            for j, x, ids in self.options(s, i, len(s)):
                if j not in score or base + x >= score[j]:
                    score[j] = base + x
                    back[j] = (i, ids)
        return score, back

    @staticmethod
    def walk(back: dict, at: int) -> tuple[int, list]:
        """(entry place, ids of the chunk's pieces) of the best path to a place."""
        out = []
        while back[at] is not None:
            at, ids = back[at]
            out.append(ids)
        return at, [k for ids in reversed(out) for k in ids]

    def entries(self, s: str, n: int, front: np.ndarray) -> np.ndarray:
        """For every state that the chunk can be left in, the state it was entered in by the best
        path (-1 where there is none)."""
        m = self.longest
        cut = self.cuts(s, n)
        if cut:
            lo, hi = cut
            _, back = self.entered(s[:lo], lo, front[:lo + 1])
            entry = self.walk(back, lo)[0]
            return np.array([entry if x > NEVER else -1 for x in self.reach(s, hi, n)], dtype=np.int64)
        _, back = self.entered(s, n, front)
        return np.array([self.walk(back, n + b)[0] if n + b in back else -1 for b in range(m)], dtype=np.int64)

    def trace(self, s: str, n: int, front: np.ndarray, b: int) -> tuple[list[int], int]:
        """Ids of the chunk's pieces on the best path that leaves it in state ``b``, and the
        path's score up to there."""
        cut = self.cuts(s, n)
        if not cut:
            score, back = self.entered(s, n, front)
            return self.walk(back, n + b)[1], score[n + b]
        lo, hi = cut
        score, back = self.entered(s[:lo], lo, front[:lo + 1])
        out, total = self.walk(back, lo)[1], score[lo]
        if hi > lo:
            ids, x = self.whole(s[lo:hi])
            out += ids.tolist()
            total += x
        x, ids = self.best(s, hi, n + b, limit=n)
        return out + ids, total + x

    def decode(self, ids) -> str:
        raw = b"".join([self.bytes_of[k] for k in ids])
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8")


class Words(UnitMemo):
    """Ids of the words between spaces. A word starts with the mark that its space becomes,
    or, after a line end, with that line end alone; the empty word has none."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        super().__init__(MEMO)
        one = lambda c: np.asarray(vocabulary.best(c)[1], dtype=np.uint32)
        self.line_end, self.stops = one("\n"), {c: one(c) for c in sorted(vocabulary.tails)}

    def _learn(self, units: list[str]) -> None:
        tails = [w for w in units if w[-1:] in self.stops and w[-2:-1].isalpha()]
        if tails:
            tailed = set(tails)
            units = [w for w in units if w not in tailed]
            units += [w[:-1] for w in tails]
        new = [w for w in dict.fromkeys(units) if w not in self.memo]
        order, ids, lens = self.vocabulary.segment([w and (w[1:] if w[0] == "\n" else MARK + w) for w in new])
        new = [new[i] for i in order]
        after = np.array([w[:1] == "\n" for w in new], dtype=bool)
        if after.any():
            k = len(self.line_end)
            ids = np.insert(ids, np.repeat((np.cumsum(lens) - lens)[after], k), np.tile(self.line_end, after.sum()))
            lens = lens + k * after
        self._store(new, ids, lens)
        if tails:
            self._store_tailed(tails, self.stops)


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of transfer matrices (associative)."""
    out = np.full((a.shape[0], b.shape[1]), NEVER, dtype=np.int64)
    for k in range(a.shape[1]):
        x = a[:, k][:, None] + b[k][None, :]
        np.maximum(out, np.where((a[:, k][:, None] > NEVER) & (b[k][None, :] > NEVER), x, NEVER), out=out)
    return out


def vocabulary(path: str) -> Vocabulary:
    """One vocabulary and memo per worker process."""
    return kept("pieces", path, lambda: Vocabulary(path))


SCHEMA = "doc_id long, text_key long, ids array<int>, score long, n_chunks int"
_ARROW = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("ids", pa.list_(pa.int32())),
                    ("score", pa.int64()), ("n_chunks", pa.int32())])
_DECODED = _ARROW.append(pa.field("text", pa.string()))
_CHUNK = "doc_id long, text_key long, chunk int, n int, body string"


def encode(docs: DataFrame, vocabulary_path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
           chunk: int = CHUNK, decoded: bool = False) -> DataFrame:
    """Per row ``(doc_id, text_key, ids, score, n_chunks)``; ids are null for a null text.
    With ``decoded`` also the text that the ids decode to (``text``), in the same task."""
    path = vocabulary_path or tokenizer_path("piece_bpe_32k.model")
    rows = narrow(docs, id_col, text_col).withColumn("text_key", text_key(F.col("text")))
    giant = F.coalesce(F.length("text"), F.lit(0)) > chunk

    def small(batches):
        from .pieces import vocabulary
        v = vocabulary(path)
        for b in batches:
            for lo in range(0, len(b), 500):
                part = b.slice(lo, 500)
                texts = part.column(1)
                flat, lens, score = v.encode_rows(texts)
                ends = np.concatenate(([0], np.cumsum(lens)))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()), mask=texts.is_null())
                some = pc.fill_null(pc.greater(pc.binary_length(texts), 0), False).cast(pa.int32())
                cols = [part.column(0), part.column(2), ids, pa.array(score, pa.int64()), some]
                if decoded:
                    flat, ends = flat.tolist(), ends.tolist()
                    back = [v.decode(flat[a:z]) if there else None for a, z, there in zip(
                        ends, ends[1:], texts.is_valid().to_pylist())]
                    cols.append(pa.array(back, pa.string()))
                yield pa.RecordBatch.from_arrays(cols, schema=_DECODED if decoded else _ARROW)

    giants = _giants(rows.where(giant), path, chunk)
    if not decoded:
        return rows.where(~giant).mapInArrow(small, SCHEMA).union(giants)
    return rows.where(~giant).mapInArrow(small, SCHEMA + ", text string").union(decode(giants, path))


def _giants(rows: DataFrame, path: str, chunk: int) -> DataFrame:
    """Giant documents: chunks -> transfer matrices -> states -> ids of every chunk."""
    copies = rows.groupBy("doc_id", "text_key").count()      # equal rows are encoded once
    arrow = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("chunk", pa.int32()),
                       ("n", pa.int32()), ("body", pa.string())])

    def split(batches):
        from .pieces import vocabulary
        v = vocabulary(path)
        for b in batches:
            for doc, text, key in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                s = v.marked(text.as_py())
                at = range(0, len(s), chunk)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * len(at), pa.int64()), pa.array([key] * len(at), pa.int64()),
                     pa.array(range(len(at)), pa.int32()), pa.array([min(chunk, len(s) - i) for i in at], pa.int32()),
                     pa.array([s[i:i + chunk + v.longest] for i in at], pa.string())], schema=arrow)

    chunks = rows.mapInArrow(split, _CHUNK).dropDuplicates(["doc_id", "text_key", "chunk"])
    # one key without nulls for a document's chunks
    doc = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text_key").alias("doc")
    chunks = written(chunks.select(doc, "*"), "pieces-chunks")

    def matrices(batches):
        from .pieces import vocabulary
        v = vocabulary(path)
        for b in batches:
            got = [v.transfer(r["body"], r["n"]).tobytes() for r in b.to_pylist()]
            yield _nodes(b.column(0), b.column(1), got)

    here = lambda *more: chunks.select("doc", F.col("chunk").alias("at"), "n", "body", *more)
    moves = written(here().select("doc", "at", "n", "body").mapInArrow(matrices, NODE), "pieces-moves")
    # best scores of every chunk's entry states: products of the matrices before it
    fronts = _push_down(_tree(moves, _product), _front_root, _front_below)
    fronts = written(fronts.withColumnRenamed("value", "front"), "pieces-fronts")

    def entry_maps(batches):
        from .pieces import vocabulary
        v = vocabulary(path)
        for b in batches:
            got = [v.entries(r["body"], r["n"], np.frombuffer(r["front"], np.int64)).tobytes() for r in b.to_pylist()]
            yield _nodes(b.column(0), b.column(1), got)

    placed = here().join(fronts, ["doc", "at"]).select("doc", "at", "n", "body", "front")
    steps = written(placed.mapInArrow(entry_maps, NODE), "pieces-entries")
    # the state every chunk is left in: the entry maps of the chunks after it, applied to the end
    exits = _push_down(_tree(steps, _composed), _exit_root, _exit_below)
    exits = written(exits.withColumnRenamed("value", "exit"), "pieces-exits")

    def trace(batches):
        from .pieces import vocabulary
        v = vocabulary(path)
        for b in batches:
            got = [v.trace(r["body"], r["n"], np.frombuffer(r["front"], np.int64),
                           int(np.frombuffer(r["exit"], np.int64)[0])) for r in b.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(3)), pa.array([x for _, x in got], pa.int64()),
                 pa.array([ids for ids, _ in got], pa.list_(pa.int32()))],
                names=["doc_id", "text_key", "chunk", "total", "ids"])

    j = (chunks.withColumnRenamed("chunk", "at").join(fronts, ["doc", "at"]).join(exits, ["doc", "at"])
         .select("doc_id", "text_key", F.col("at").alias("chunk"), "n", "body", "front", "exit"))
    parts = j.mapInArrow(trace, "doc_id long, text_key long, chunk int, total long, ids array<int>")
    # a document's ids are one value of the result, so its chunks meet again here
    whole = parts.groupBy("doc_id", "text_key").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"])).alias("ids"),
        F.max_by("total", "chunk").alias("score"), F.count("*").cast("int").alias("n_chunks"))
    c = copies.select(F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key"), "count")
    whole = whole.join(c, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_key") == F.col("c_key")))
    return (whole.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("count"))))
            .select("doc_id", "text_key", "ids", "score", "n_chunks"))


NODE = "doc string, at int, value binary"


def _nodes(doc, at, values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([doc, at, pa.array(values, pa.binary())], names=["doc", "at", "value"])


def _siblings(level: DataFrame) -> DataFrame:
    """``(doc, at, a, b)``: the two nodes below each node of the next level; b may be null."""
    half = F.floor(F.col("at") / 2).cast("int").alias("at")
    left = level.where("at % 2 = 0").select("doc", half, F.col("value").alias("a"))
    right = level.where("at % 2 = 1").select("doc", half, F.col("value").alias("b"))
    return left.join(right, ["doc", "at"], "left").select("doc", "at", "a", "b")


def _tree(leaves: DataFrame, merge) -> list[DataFrame]:
    """Levels of an associative scan over each document's nodes: neighbours are merged pair by
    pair, as many rounds as the longest document's chunks halve. A row is one pair, so a
    document's chunks are never gathered."""
    def up(batches):
        for b in batches:
            yield _nodes(b.column(0), b.column(1), [x if y is None else merge(x, y) for x, y in zip(
                b.column(2).to_pylist(), b.column(3).to_pylist())])

    levels, top = [leaves], leaves.agg(F.max("at")).first()[0] or 0
    while top:
        levels.append(written(_siblings(levels[-1]).mapInArrow(up, NODE), "pieces-level"))
        top //= 2
    return levels


def _push_down(levels: list[DataFrame], root, below) -> DataFrame:
    """States handed down the tree: ``root(value)`` at the top, ``below(state, a, b)`` gives the
    states of a node's two children."""
    def start(batches):
        for b in batches:
            yield _nodes(b.column(0), b.column(1), [root(x) for x in b.column(2).to_pylist()])

    def down(batches):
        for b in batches:
            docs, at, out = [], [], []
            for doc, k, a, z, state in zip(*(b.column(i).to_pylist() for i in range(5))):
                for side, x in enumerate(below(state, a, z)):
                    docs.append(doc), at.append(2 * k + side), out.append(x)
            yield _nodes(pa.array(docs, pa.string()), pa.array(at, pa.int32()), out)

    states = written(levels[-1].mapInArrow(start, NODE), "pieces-states")
    for level in reversed(levels[:-1]):
        j = _siblings(level).join(states.withColumnRenamed("value", "state"), ["doc", "at"])
        states = written(j.select("doc", "at", "a", "b", "state").mapInArrow(down, NODE), "pieces-states")
    return states


def _matrix(raw: bytes) -> np.ndarray:
    x = np.frombuffer(raw, dtype=np.int64)
    return x.reshape(math.isqrt(len(x)), -1)


def _product(a: bytes, b: bytes) -> bytes:
    return combine(_matrix(a), _matrix(b)).tobytes()


def _front_root(matrix: bytes) -> bytes:
    """A document is entered with nothing taken."""
    front = np.full(len(_matrix(matrix)), NEVER, dtype=np.int64)
    front[0] = 0
    return front.tobytes()


def _front_below(front: bytes, a: bytes, b: bytes | None):
    yield front
    if b is not None:
        yield combine(np.frombuffer(front, np.int64)[None, :], _matrix(a)).tobytes()


def _composed(a: bytes, b: bytes) -> bytes:
    """Entry maps of two neighbours as one: from the second's exit to the first's entry."""
    x, y = np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)
    return np.where(y >= 0, x[np.maximum(y, 0)], -1).tobytes()


def _exit_root(_) -> bytes:
    """A document is left with nothing taken beyond its end."""
    return np.zeros(1, dtype=np.int64).tobytes()


def _exit_below(state: bytes, a: bytes, b: bytes | None):
    """The left child is left in the state that the right one is entered in."""
    if b is None:
        yield state
        return
    yield np.frombuffer(b, np.int64)[np.frombuffer(state, np.int64)].tobytes()
    yield state


def decode(encoded: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """Adds ``text`` (null for null ids) to what :func:`encode` returns."""
    ship(encoded.sparkSession)
    path = vocabulary_path or tokenizer_path("piece_bpe_32k.model")
    schema = _DECODED

    def back(batches):
        from .pieces import vocabulary
        v = vocabulary(path)
        for b in batches:
            for lo in range(0, len(b), 500):
                part = b.slice(lo, 500)
                ids = part.column(2)
                flat, at = ids.flatten().to_pylist(), 0
                texts = []
                for n in ids.value_lengths().to_pylist():
                    texts.append(None if n is None else v.decode(flat[at:at + n]))
                    at += n or 0
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(5)), pa.array(texts, pa.string())],
                                                 schema=schema)

    return encoded.select("doc_id", "text_key", "ids", "score", "n_chunks").mapInArrow(back, SCHEMA + ", text string")
