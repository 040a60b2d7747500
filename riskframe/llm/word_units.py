"""Fast exact use of a BPE tokenizer with word ends: encode distinct words once.

The tokenizer drops white space and no merge crosses it, so a text's ids are those of its
words laid end to end, and a distinct word needs the tokenizers library only once while it
is remembered (bounded memo, see ``bpe_units``). Words are cut at the six ASCII white
space characters only; any other white space stays inside a word and is the library's. Where the
library ignores capitals, so does the memo, and a stop after a letter is a unit of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .bpe_units import UnitEncoder
from .common import kept

END = "</w>"
STOPS = ".,;:!?"
COMBINING = 0x300                    # below, no character joins the one before it
COMPOSES = r"[^\x00-\x{2FF}]"


def word_encoder(path: str) -> WordEncoder:
    return kept("words", path, lambda: WordEncoder(path))


class WordEncoder(UnitEncoder):
    """Arrow string arrays -> token ids and their number per row."""

    def __init__(self, path: str, max_units: int = 1_000_000):
        super().__init__(path, max_units)
        for piece, i in self.tok.get_vocab().items():
            if piece.endswith(END):
                self.id_bytes[i] -= len(END)
        normal = self.tok.normalizer.normalize_str if self.tok.normalizer else str
        low = [chr(c) for c in range(COMBINING)]
        # capitals mean nothing to the library: words that differ by them alone are one unit
        self.folds = all(normal(c) == normal(c.lower()) for c in low if c.isascii())
        # letters that the normal form keeps as letters: a word is always cut between one and a stop
        self.letters = {c for c in low if c.isalpha() and normal(c).isalpha()}
        stops = {c: self._encode(c) for c in STOPS}
        self.stops = {c: x for c, x in stops.items() if np.array_equal(
            self._encode(f"a{c}"), np.concatenate([self._encode("a"), x]))}

    def _learn(self, units: list[str]) -> None:
        stops, letters = self.stops, self.letters
        tails = [u for u in units if u[-1:] in stops and u[-2:-1] in letters]
        if tails:
            tailed = set(tails)
            units = [u for u in units if u not in tailed]
            units += [u[:-1] for u in tails]
        new = dict.fromkeys(u for u in units if u not in self.memo)
        if "" in new:
            del new[""]
            self._store([""], np.zeros(0, np.uint32), np.array([0]))
        ascii_ = [u for u in new if u.isascii()]
        other = [u for u in new if not u.isascii()] if len(ascii_) < len(new) else []
        for part in (x[i:i + 4_000] for x in (ascii_, other) for i in range(0, len(x), 4_000)):
            joined = " ".join(part)
            if joined.isascii():
                width = [len(u) for u in part]
            else:                                # the normal form decides the bytes of a word
                normal = self.tok.normalizer.normalize_str(joined).split(" ")
                width = [len(u.encode()) for u in normal] if len(normal) == len(part) else None
            ids = self._encode(joined) if width else None
            if width and int(self.id_bytes[ids].sum()) == sum(width):
                cuts = np.searchsorted(np.cumsum(self.id_bytes[ids]), np.cumsum(width)) + 1
                self._store(part, ids, np.diff(cuts, prepend=0))
                continue
            for u in part:                       # white space of other scripts inside a word
                ids = self._encode(u)
                self._store([u], ids, np.array([len(ids)]))
        if tails:
            self._store_tailed(tails, stops)

    def _encode_rows(self, rows: pa.Array, want_ids: bool):
        odd = (pc.match_substring_regex(rows, self.special) if self.special
               else pa.array(np.zeros(len(rows), dtype=bool)))
        plain = pc.if_else(odd, pa.scalar("", pa.large_string()), rows)
        for c in "\n\t\r\x0b\x0c":
            plain = pc.replace_substring(plain, c, " ")
        if self.folds:                           # not where letters and marks may compose
            marks = pc.match_substring_regex(plain, COMPOSES)
            plain = pc.if_else(marks, plain, pc.ascii_lower(plain))
        parts = pc.split_pattern(plain, " ")
        offs = parts.offsets.to_numpy()
        offs = offs - offs[0]
        words = parts.flatten().dictionary_encode()
        slots_of = self.slots(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        slots = slots_of[words.indices.to_numpy(zero_copy_only=False)]
        lens = np.add.reduceat(self.count[slots], offs[:-1]) if len(slots) else np.zeros(0, np.int64)
        odd_at = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if not len(odd_at):
            return lens, self.gather(slots) if want_ids else None
        out = np.split(self.gather(slots), np.cumsum(lens)[:-1])
        for i in odd_at:                         # special strings reach over word borders
            out[i] = self._encode(rows[int(i)].as_py())
            lens[i] = len(out[i])
        return lens, np.concatenate(out) if want_ids else None
