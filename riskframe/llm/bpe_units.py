"""Fast exact use of a byte-level BPE tokenizer: encode distinct words once.

The tokenizer's own splitter always cuts before a space that stands between two
non-space characters, and no merge crosses such a cut. So a text's ids are the
concatenation of the ids of its space-separated words (all but the first with their
leading space), and a distinct word needs the tokenizers library only once while it is
remembered (bounded memo). Texts with other white space runs are cut by the same rule
with a regular expression.
"""

from __future__ import annotations

import os
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import kept, row_slices

CUT = re.compile(r"(?<=\S) (?=\S)")
HEAD = "\n"          # no word that follows a space starts with white space
# two white space characters in a row, one at an end, or one outside ASCII
IRREGULAR = (r"[\x09-\x0D\x1C-\x20]{2}|\A[\x09-\x0D\x1C-\x20]|[\x09-\x0D\x1C-\x20]\z|"
             r"[\x{85}\x{A0}\x{1680}\x{180E}\x{2000}-\x{200B}\x{2028}\x{2029}\x{202F}\x{205F}"
             r"\x{2060}\x{3000}\x{FEFF}]")


def encoder(path: str) -> UnitEncoder:
    """One encoder for each vocabulary and worker process, kept between tasks."""
    return kept("units", path, lambda: UnitEncoder(path))


class UnitMemo:
    """Token ids of units met before, as slots of flat arrays; ``_learn`` stores new units."""

    def __init__(self, max_units: int):
        self.max_units = max_units
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.start = np.zeros(1 << 16, dtype=np.int64)      # by slot: place in ids, length
        self.count = np.zeros(1 << 16, dtype=np.int64)
        self.ids = np.zeros(1 << 18, dtype=np.uint32)
        self.n_ids = 0

    def _store(self, units: list[str], ids: np.ndarray, lens: np.ndarray) -> None:
        k, n = len(self.memo), len(units)
        while k + n > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.count = np.concatenate([self.count, np.zeros_like(self.count)])
        while self.n_ids + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.count[k:k + n] = lens
        self.start[k:k + n] = self.n_ids + np.cumsum(lens) - lens
        self.ids[self.n_ids:self.n_ids + len(ids)] = ids
        self.n_ids += len(ids)
        self.memo.update(zip(units, range(k, k + n)))

    def slots(self, units: list[str]) -> np.ndarray:
        """Slot of each unit: a word that follows a space, or HEAD + a text's first word."""
        found = np.fromiter(map(self.memo.get, units, repeat(-1)), np.int64, len(units))
        missing = np.flatnonzero(found < 0).tolist()
        if missing:
            new = list(dict.fromkeys([units[i] for i in missing]))
            if len(self.memo) + 2 * len(new) > self.max_units:
                self._forget()
                new, missing = list(dict.fromkeys(units)), range(len(units))
            self._learn(new)
            memo = self.memo
            found[missing] = [memo[units[i]] for i in missing]
        return found

    def gather(self, slots: np.ndarray) -> np.ndarray:
        lens = self.count[slots]
        if not len(lens):
            return np.zeros(0, dtype=np.uint32)
        first = np.cumsum(lens) - lens
        at = np.arange(int(lens.sum()), dtype=np.int64) + np.repeat(self.start[slots] - first, lens)
        return self.ids[at]

    def _store_tailed(self, tails: list[str], stops: dict[str, np.ndarray]) -> None:
        """Store units that are another unit, known already, and a final stop."""
        at = np.array([self.memo[u[:-1]] for u in tails])
        last = np.array([u[-1] for u in tails])
        n = self.count[at]
        lens = n.copy()
        for c, x in stops.items():
            lens[last == c] += len(x)
        ends = np.cumsum(lens)
        ids = np.empty(int(lens.sum()), dtype=np.uint32)
        ids[np.arange(int(n.sum())) + np.repeat(ends - lens - np.cumsum(n) + n, n)] = self.gather(at)
        for c, x in stops.items():
            ids[ends[last == c][:, None] + np.arange(-len(x), 0)] = x
        self._store(tails, ids, lens)


class UnitEncoder(UnitMemo):
    """Arrow string arrays -> token ids and their number per row."""

    def __init__(self, path: str, max_units: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tok = Tokenizer.from_file(path)
        self.special = "|".join(re.escape(t.content)
                                for t in self.tok.get_added_tokens_decoder().values())
        # bytes that each id stands for: a byte-level piece has a character for each byte
        self.id_bytes = np.zeros(self.tok.get_vocab_size() + 1, dtype=np.int64)
        byte_chars = set(ByteLevel.alphabet())
        for piece, i in self.tok.get_vocab().items():
            self.id_bytes[i] = len(piece) if set(piece) <= byte_chars else len(piece.encode())
        UnitMemo.__init__(self, max_units)

    def _encode(self, text: str) -> np.ndarray:
        return np.asarray(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids,
                          dtype=np.uint32)

    def _learn(self, units: list[str]) -> None:
        """Encode new units, many in one call: joined, they are cut again where they meet.
        The splitter also cuts between a letter and a final stop or comma."""
        tails = [u for u in units if u.endswith((".", ",")) and u[-2:-1].isalpha() and u[0] != HEAD]
        if tails:
            tailed = set(tails)
            units = [u for u in units if u not in tailed]
            units += [u for u in dict.fromkeys(u[:-1] for u in tails) if u not in self.memo]
        units = dict.fromkeys(units)
        plain = [u for u in units if u and u.strip() == u]      # HEAD is white space as well
        heads = [u for u in units if not u or u.strip() != u] if len(plain) < len(units) else []
        for i in range(0, len(plain), 4_000):
            part = plain[i:i + 4_000]
            joined = " " + " ".join(part)
            ids = self._encode(joined)
            width = map(len, part) if joined.isascii() else (len(u.encode()) for u in part)
            ends = np.cumsum(np.fromiter(width, dtype=np.int64, count=len(part)) + 1)
            cuts = np.searchsorted(np.cumsum(self.id_bytes[ids]), ends) + 1
            self._store(part, ids, np.diff(cuts, prepend=0))
        for i in range(0, len(heads), 1_000):
            part = heads[i:i + 1_000]
            got = [e.ids for e in self.tok.encode_batch_fast(
                [u[1:] if u[:1] == HEAD else " " + u for u in part], add_special_tokens=False)]
            self._store(part, np.array([k for ids in got for k in ids], dtype=np.uint32), np.array([len(x) for x in got]))
        if tails:
            self._store_tailed(tails, {c: self._encode(c) for c in (".", ",")})

    def encode(self, texts: pa.Array, ids: bool = True):
        """Yield ``(lo, hi, lengths, ids or None)`` for runs of rows; a null row is empty."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[
            texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        for lo, hi in row_slices(offsets):
            yield (lo, hi, *self._encode_rows(texts.slice(lo, hi - lo), ids))

    def _encode_rows(self, rows: pa.Array, want_ids: bool):
        odd = pc.match_substring_regex(rows, IRREGULAR)
        if self.special:
            odd = pc.or_(odd, pc.match_substring_regex(rows, self.special))
        plain = pc.if_else(odd, pa.scalar("", pa.large_string()), rows)
        parts = pc.split_pattern(plain, " ")
        offs = parts.offsets.to_numpy()
        offs = offs - offs[0]
        words = parts.flatten().dictionary_encode()
        values = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        heads = offs[:-1]                                   # the first word has no space
        head_words, head_codes = np.unique(codes[heads], return_inverse=True)
        slots_of = self.slots(values + [HEAD + values[i] for i in head_words])
        slots = slots_of[:len(values)][codes] if len(values) else codes
        slots[heads] = slots_of[len(values):][head_codes]
        lens = np.add.reduceat(self.count[slots], heads) if len(slots) else np.zeros(0, np.int64)
        odd_at = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if not len(odd_at):
            return lens, self.gather(slots) if want_ids else None
        # the other rows: the same cut by expression, whole texts where special strings occur
        out = np.split(self.gather(slots), np.cumsum(lens)[:-1])
        for i in odd_at:
            t = rows[int(i)].as_py()
            if self.special and re.search(self.special, t):
                got = self._encode(t)
            else:
                u = CUT.split(t)
                got = self.gather(self.slots([HEAD + u[0]] + u[1:]))
            out[i], lens[i] = got, len(got)
        return lens, np.concatenate(out) if want_ids else None
