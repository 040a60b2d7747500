"""Vectorised fingerprints of words and of runs of words or bytes (numpy, inside tasks).

A run's fingerprint is a polynomial over random values of its items, modulo 2**64, taken
from running sums, then mixed. Lanes differ in values and base, so two lanes together
give 128 bits.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
MASK = (1 << 64) - 1
BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Powers:
    """Powers of a lane's odd base and of its inverse, grown as needed. A worker keeps them as
    long as it lives: 16 bytes for each item of the longest run of values it ever had."""

    def __init__(self, lane: int):
        self.base = BASES[lane]
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * U(pow(self.base, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * U(pow(self.inverse, k, 1 << 64))])
        return self.up[:n], self.down[:n]


POWERS = (Powers(0), Powers(1))
BYTE = tuple(mix(np.arange(1, 257, dtype=U) * U(0xD6E8FEB86659FD93) + U(lane + 1)) for lane in (0, 1))
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class Runs:
    """Fingerprints of any runs of ``values`` (one lane)."""

    def __init__(self, values: np.ndarray, lane: int):
        up, self.down = POWERS[lane].get(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, dtype=U)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    def of(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[first]) * self.down[first] + (end - first).astype(U))


def words(data: np.ndarray, offsets: np.ndarray, lanes=(0,), piece: int = (1 << 18) - 1):
    """Words of texts laid end to end in ``data`` (text i is ``offsets[i]:offsets[i+1]``).
    -> (word places in each text as offsets, first byte, end byte, fingerprints by lane)."""
    space = SPACE[data]
    before = np.empty(len(data) + 1, dtype=bool)         # a space, or a text's edge
    before[1:] = space
    before[offsets] = True
    first = np.flatnonzero(~space & before[:-1])
    after = np.empty(len(data) + 1, dtype=bool)
    after[:-1] = space
    after[offsets] = True
    end = np.flatnonzero(~space & after[1:]) + 1
    out = []
    for lane in lanes:
        got = np.empty(len(first), dtype=U)
        lo = 0
        while lo < len(first):                           # long data in pieces, cut between words
            hi = max(lo + 1, int(np.searchsorted(end, first[lo] + piece, side="right")))
            at = int(first[lo])
            r = Runs(BYTE[lane][data[at:int(end[hi - 1])]], lane)
            got[lo:hi] = r.of(first[lo:hi] - at, end[lo:hi] - at)
            lo = hi
        out.append(got)
    return np.searchsorted(first, offsets), first, end, out


def text_bytes(column, lo: int, hi: int):
    """Bytes and offsets of rows lo..hi of a large_string Arrow array without nulls."""
    offs = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset + lo:column.offset + hi + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offs[0]:offs[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def window_minima(key: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of every run of ``width`` values: the least and its first place."""
    k, at = key, np.arange(len(key), dtype=np.int64)
    have = 1
    while have < width:
        step = min(have, width - have)
        a, b = k[:-step] if step else k, k[step:]
        right = b < a
        k = np.where(right, b, a)
        at = np.where(right, at[step:], at[:-step])
        have += step
    return k, at
