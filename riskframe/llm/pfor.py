"""Patched frame-of-reference blocks of token ids, and a file of them.

A block holds ``BLOCK`` ids (the last of a segment fewer, padded with the block minimum).
The minimum is subtracted; the differences are packed at the smallest width that holds
``COVER`` of them; those that do not fit go to the segment's exception list (place in the
segment, whole difference). A shard file is

    magic | segments (packed words, then exceptions) | footer | footer length | magic

where the footer holds the document table (ids, lengths), the block index (minimum,
width, place of the first word) and the segment table, so any run of ids can be read
without the rest. All numbers are little-endian.
"""

from __future__ import annotations

import io
import struct

import numpy as np

MAGIC = b"PFORIDS1"
BLOCK = 256                    # ids per block
COVER = 0.9                    # share of a block's ids that the packed width must hold
SEGMENT = 1 << 18              # ids per segment: what a writer or reader holds at once


def pack(ids: np.ndarray, block: int = BLOCK, cover: float = COVER):
    """-> (minimum u4, width u1, words u8 of all blocks, exception places u4, values u4)."""
    n = len(ids)
    nb = -(-n // block)
    v = np.empty(nb * block, dtype=np.uint32)
    v[:n] = ids
    v[n:] = ids[-1] if n else 0
    v = v.reshape(nb, block)
    low = v.min(axis=1) if nb else np.zeros(0, np.uint32)
    d = v - low[:, None]
    at = min(block - 1, max(0, int(np.ceil(cover * block)) - 1))
    held = np.partition(d, at, axis=1)[:, at] if nb else np.zeros(0, np.uint32)
    width = np.ceil(np.log2(held.astype(np.float64) + 1)).astype(np.uint8)
    words_of = (width.astype(np.int64) * block + 63) // 64
    start = np.cumsum(words_of) - words_of
    words = np.zeros(int(words_of.sum()), dtype=np.uint64)
    ex_at, ex_val = [], []
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        x = d[rows].astype(np.uint64)
        over = x >> np.uint64(w) != 0
        if over.any():
            r, c = np.nonzero(over)
            ex_at.append(rows[r] * block + c)
            ex_val.append(x[r, c])
            x[over] = 0
        if w == 0:
            continue
        k = int((int(w) * block + 63) // 64)
        out = np.zeros((k, len(rows)), dtype=np.uint64)
        xt = np.ascontiguousarray(x.T)
        for i in range(block):
            bit = i * int(w)
            q, r = bit >> 6, bit & 63
            out[q] |= xt[i] << np.uint64(r)
            if r + int(w) > 64:
                out[q + 1] |= xt[i] >> np.uint64(64 - r)
        words[start[rows][:, None] + np.arange(k)] = out.T
    where = np.concatenate(ex_at) if ex_at else np.zeros(0, np.int64)
    val = np.concatenate(ex_val) if ex_val else np.zeros(0, np.uint64)
    keep = where < n
    where, val = where[keep], val[keep]
    order = np.argsort(where, kind="stable")
    return low, width, words, where[order].astype("<u4"), val[order].astype("<u4")


def unpack(n: int, low, width, words, ex_at, ex_val, block: int = BLOCK) -> np.ndarray:
    """The ids of consecutive blocks (``n`` of them), the inverse of :func:`pack`."""
    nb = len(low)
    d = np.zeros((nb, block), dtype=np.uint32)
    words_of = (width.astype(np.int64) * block + 63) // 64
    start = np.cumsum(words_of) - words_of
    for w in np.unique(width):
        if w == 0:
            continue
        rows = np.flatnonzero(width == w)
        k = int((int(w) * block + 63) // 64)
        x = np.ascontiguousarray(words[start[rows][:, None] + np.arange(k)].T)
        out = np.empty((block, len(rows)), dtype=np.uint32)
        mask = np.uint64((1 << int(w)) - 1)
        for i in range(block):
            bit = i * int(w)
            q, r = bit >> 6, bit & 63
            y = x[q] >> np.uint64(r)
            if r + int(w) > 64:
                y = y | (x[q + 1] << np.uint64(64 - r))
            out[i] = (y & mask).astype(np.uint32)
        d[rows] = out.T
    flat = d.reshape(-1)
    flat[ex_at] = ex_val
    flat = (flat.reshape(nb, block) + low[:, None]).reshape(-1)
    return flat[:n]


class Writer:
    """Streams documents' ids into a shard; holds one segment and the indexes."""

    def __init__(self, out, block: int = BLOCK, cover: float = COVER, segment: int = SEGMENT):
        self.out, self.block, self.cover, self.segment = out, block, cover, segment - segment % block
        self.pos = out.write(MAGIC)
        self.docs, self.lens, self.nulls = [], [], []
        self.low, self.width, self.segs = [], [], []
        self.held, self.n_held, self.n_ids = [], 0, 0

    def add(self, doc_ids, lengths: np.ndarray, ids: np.ndarray) -> None:
        """Rows in file order; ``doc_ids`` may hold None."""
        self.nulls.append(np.array([x is None for x in doc_ids], dtype=np.uint8))
        self.docs.append(np.array([x or 0 for x in doc_ids], dtype="<i8"))
        self.lens.append(np.asarray(lengths, dtype="<i8"))
        self.held.append(ids)
        self.n_held += len(ids)
        while self.n_held >= self.segment:
            self._flush(self.segment)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.held)
        self.held = [ids[n:]]
        self.n_held -= n
        low, width, words, at, val = pack(ids[:n], self.block, self.cover)
        self.segs.append((self.n_ids, n, self.pos, len(low), len(words), len(at)))
        for part in (words.astype("<u8"), at, val):
            self.pos += self.out.write(part.tobytes())
        self.low.append(low)
        self.width.append(width)
        self.n_ids += n

    def close(self) -> tuple[int, int]:
        """Write the rest and the footer -> (documents, ids)."""
        if self.n_held:
            self._flush(self.n_held)
        cat = lambda xs, t: np.concatenate(xs).astype(t) if xs else np.zeros(0, t)
        docs = cat(self.docs, "<i8")
        foot = struct.pack("<IIQQ", self.block, len(self.segs), len(docs), self.n_ids)
        foot += np.array(self.segs, dtype="<i8").tobytes()
        foot += docs.tobytes() + cat(self.nulls, "u1").tobytes() + cat(self.lens, "<i8").tobytes()
        foot += cat(self.low, "<u4").tobytes() + cat(self.width, "u1").tobytes()
        self.out.write(foot + struct.pack("<Q", len(foot)) + MAGIC)
        return len(docs), self.n_ids


class Reader:
    """Random access to a shard through its footer."""

    def __init__(self, f):
        self.f = f
        size = f.seek(0, io.SEEK_END)
        f.seek(size - 16)
        (length,), tail = struct.unpack("<Q", f.read(8)), f.read(8)
        if tail != MAGIC:
            raise ValueError("not a shard of token ids, or cut off")
        f.seek(size - 16 - length)
        foot = memoryview(f.read(length))
        self.block, ns, nd, self.n_ids = struct.unpack_from("<IIQQ", foot)
        at = [24]

        def take(n, t):
            out = np.frombuffer(foot, dtype=t, count=n, offset=at[0])
            at[0] += out.nbytes
            return out

        self.segs = take(ns * 6, "<i8").reshape(ns, 6)
        self.doc_ids, self.doc_null, self.lens = take(nd, "<i8"), take(nd, "u1"), take(nd, "<i8")
        nb = int(self.segs[:, 3].sum())
        self.low, self.width = take(nb, "<u4"), take(nb, "u1")
        self.first_block = np.cumsum(self.segs[:, 3]) - self.segs[:, 3]

    def segment(self, s: int) -> np.ndarray:
        """All ids of one segment."""
        _, n, pos, nb, nw, ne = (int(x) for x in self.segs[s])
        self.f.seek(pos)
        words = np.frombuffer(self.f.read(8 * nw), dtype="<u8")
        at, val = (np.frombuffer(self.f.read(4 * ne), dtype="<u4") for _ in range(2))
        b = int(self.first_block[s])
        return unpack(n, self.low[b:b + nb], self.width[b:b + nb], words, at, val, self.block)

    def read(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from place ``start``: only the blocks that hold them are unpacked."""
        out = []
        end = min(start + n, self.n_ids)
        s = int(np.searchsorted(self.segs[:, 0], start, side="right")) - 1 if len(self.segs) else 0
        while start < end:
            first, sn, pos, nb, nw, ne = (int(x) for x in self.segs[s])
            lo, hi = start - first, min(end - first, sn)
            b0, b1 = lo // self.block, -(-hi // self.block)
            b = int(self.first_block[s])
            per = (self.width[b:b + nb].astype(np.int64) * self.block + 63) // 64
            w0, w1 = int(per[:b0].sum()), int(per[:b1].sum())
            self.f.seek(pos + 8 * w0)
            words = np.frombuffer(self.f.read(8 * (w1 - w0)), dtype="<u8")
            self.f.seek(pos + 8 * nw)
            at, val = (np.frombuffer(self.f.read(4 * ne), dtype="<u4") for _ in range(2))
            e0, e1 = np.searchsorted(at, [b0 * self.block, b1 * self.block])
            ids = unpack(min(b1 * self.block, sn) - b0 * self.block, self.low[b + b0:b + b1],
                         self.width[b + b0:b + b1], words, at[e0:e1] - b0 * self.block, val[e0:e1],
                         self.block)
            out.append(ids[lo - b0 * self.block:hi - b0 * self.block])
            start, s = first + hi, s + 1
        return np.concatenate(out) if out else np.zeros(0, np.uint32)
