"""Embedding whitening by Chebyshev-filtered subspace iteration.

Entries are put on an integer grid (``floor(scale * c)``), so that equal vectors are equal
bytes and sums are exact. The fit list holds each distinct vector once. Its covariance V is
never formed: a pass over the fit list gives V Q for a narrow block Q (each task centres its
rows, multiplies, and emits one partial product; Spark adds them up). Between passes the
driver holds dimension x block doubles. One round runs a Chebyshev recurrence of such passes,
which damps the spectrum below the block's smallest Ritz value, then QR and Rayleigh-Ritz.
Rounds go on until the residuals of the wanted pairs certify them: |V q - e q| at the
rounding of V q. A block that stops gaining is widened, up to the whole space, where
Rayleigh-Ritz is exact, so the iteration always ends.

Defined cases: rows whose vector is null or holds a null or non-finite entry are dropped;
shorter vectors count as ending in zeros (an empty one is all zeros); entries beyond 64 bits
saturate; repeated rows and ids are rows of their own and get the same values; a null id
stays null. Components of no variance (below 1e-13 of the whole) do not exist: a fit list
of one vector gives no rows, as does an empty table. Other columns are ignored, whatever
their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, ship, written

SCALE = 256                     # grid steps in a unit
ROWS = 4096                     # vectors multiplied at once in a task
GUARD = 12                      # block columns beyond the wanted components
DEGREE = 10                     # passes in a round
FLOOR = 1e-13                   # share of the variance below which there is no component


@dataclass
class Whitening:
    """``n`` fitted vectors with integer sums ``s``; columns of ``vectors`` are the unit
    components with eigenvalues ``values`` of a covariance of trace ``trace``."""
    n: int
    s: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residual: float = 0.0           # largest |V q - e q| over the largest eigenvalue
    passes: int = 0
    identity_error: float = 0.0


def grid(vals: np.ndarray, scale: int) -> np.ndarray:
    v = np.floor(vals * scale)
    out = np.clip(v, -2.0 ** 63, 2.0 ** 62).astype(np.int64)
    big = v >= 2.0 ** 62
    out[big] = [min(int(x), 2 ** 63 - 1) for x in v[big]]
    return out


def to_keys(x: np.ndarray) -> list[bytes]:
    """One canonical byte string for each row: the narrowest width that holds the row, then
    its little-endian entries without the zero bytes at the end."""
    out: list = [b""] * len(x)
    lo, hi = x.min(axis=1, initial=0), x.max(axis=1, initial=0)
    todo = np.ones(len(x), dtype=bool)
    for width in (2, 4, 8):
        top = 2 ** (8 * width - 1)
        at = np.flatnonzero(todo & (lo >= -top) & (hi <= top - 1))
        todo[at] = False
        raw, step, head = x[at].astype(f"<i{width}").tobytes(), width * x.shape[1], bytes([width])
        for k, i in enumerate(at):
            out[i] = head + raw[k * step:(k + 1) * step].rstrip(b"\0")
    zero = np.flatnonzero((lo == 0) & (hi == 0))
    for i in zero:
        out[i] = b"\2"
    return out


def from_keys(keys: list[bytes], dims: int) -> np.ndarray:
    out = np.zeros((len(keys), dims), dtype=np.int64)
    width = np.array([k[0] for k in keys], dtype=np.int64)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        size = int(w) * dims
        raw = b"".join(keys[i][1:].ljust(size, b"\0") for i in at)
        if len(raw) != size * len(at):
            raise ValueError(f"a vector has more than the {dims} fitted dimensions")
        out[at] = np.frombuffer(raw, dtype=f"<i{w}").reshape(len(at), dims)
    return out


def gridded(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
            scale: int = SCALE) -> DataFrame:
    """``(vec_id, x)`` of every usable row, ``x`` the key of its integer vector."""
    ship(rows.sparkSession)
    schema = pa.schema([("vec_id", pa.int64()), ("x", pa.binary())])

    def run(batches):
        from .whitening import grid, to_keys
        for b in batches:
            col = b.column(1)
            col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
            size = pc.list_value_length(col).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            vals = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.cumsum(size)
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(vals))))
            good = col.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[ends - size])
            for d in np.unique(size[good]):
                at = np.flatnonzero(good & (size == d))
                for lo in range(0, len(at), ROWS):
                    part = at[lo:lo + ROWS]
                    x = grid(vals[(ends[part] - d)[:, None] + np.arange(d)], scale)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(part)), pa.array(to_keys(x), pa.binary())], schema=schema)

    return rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                       F.col(f"`{vector_col}`").cast("array<double>").alias("x")).mapInArrow(run, "vec_id long, x binary")


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of every dimension (a row per dimension)."""
    schema = pa.schema([("i", pa.int32()), ("v", pa.string())])

    def run(batches):
        from .whitening import from_keys
        n, total = 0, []
        for b in batches:
            keys = b.column(0).to_pylist()
            for lo in range(0, len(keys), ROWS):
                part = keys[lo:lo + ROWS]
                d = max((len(k) - 2) // k[0] + 1 for k in part)
                x = from_keys(part, d)
                top = max(abs(int(x.min(initial=0))), int(x.max(initial=0)))
                got = (x if top * len(x) < 2 ** 63 else x.astype(object)).sum(axis=0)
                total += [0] * (d - len(total))
                for i, v in enumerate(got):
                    total[i] += int(v)
                n += len(part)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, len(total)), pa.int32()), pa.array([str(v) for v in (n, *total)])], schema=schema)

    got = (fit.mapInArrow(run, "i int, v string")
           .groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect())
    by = {r["i"]: int(r["v"]) for r in got}
    return by.get(-1, 0), [by[i] for i in range(max(by, default=-1) + 1)]


def centred(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """x - s / n: the whole part of the mean is taken off exactly, the rest in doubles."""
    whole = [v // n for v in s]
    rest = np.array([(v - w * n) / n for v, w in zip(s, whole)])
    whole = np.array(whole, dtype=np.int64)
    safe = np.abs(x).max(initial=0) < 2 ** 62
    y = (x - whole).astype(np.float64) if safe else x.astype(np.float64) - whole
    return y - rest


def _moments(fit: DataFrame, n: int, s: list[int], q: np.ndarray, own: bool = False) -> tuple[np.ndarray, float]:
    """(V q, trace V), or with ``own`` (qᵀ V q, trace V): one pass; every task emits one
    partial product, added up by Spark."""
    held = fit.sparkSession.sparkContext.broadcast((n, s, q))
    schema = pa.schema([("i", pa.int64()), ("v", pa.float64())])

    def run(batches):
        from .whitening import centred, from_keys
        n, s, q = held.value
        total, trace = 0.0, 0.0
        for b in batches:
            keys = b.column(0).to_pylist()
            for lo in range(0, len(keys), ROWS):
                y = centred(from_keys(keys[lo:lo + ROWS], len(s)), n, s)
                z = y @ q
                total = total + (z.T if own else y.T) @ z
                trace += float((y * y).sum())
        if not isinstance(total, float):
            v = np.concatenate((total.ravel(), [trace])) / n
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(v))), pa.array(v)], schema=schema)

    got = fit.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
    held.unpersist()
    v = np.zeros(len(got))
    v[got["i"].to_numpy()] = got["v"].to_numpy()
    return v[:-1].reshape(-1, q.shape[1]), float(v[-1])


def subspace(product, dims: int, wanted: int, guard: int = GUARD, degree: int = DEGREE, seed: int = 7,
             max_rounds: int = 200):
    """Largest ``wanted`` eigenpairs of a symmetric positive operator given by ``product``
    (block -> V block): ``(values, vectors, largest relative residual, passes)``."""
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.standard_normal((dims, min(dims, wanted + guard))))[0]
    passes, last = 0, np.inf
    for _ in range(max_rounds):
        w = product(q)
        passes += 1
        h = q.T @ w
        e, u = np.linalg.eigh((h + h.T) / 2)
        order = np.argsort(-e, kind="stable")
        e, q, w = e[order], q @ u[:, order], w @ u[:, order]
        top = max(float(e[0]), 0.0)
        if top == 0.0:
            return e[:wanted], q[:, :wanted], 0.0, passes
        worst = float(np.linalg.norm((w - q * e)[:, :wanted], axis=0).max()) / top
        # certified: at the rounding of V q, or as near to it as the arithmetic comes
        if worst < 4e-15 or q.shape[1] == dims or (worst < 1e-13 and worst > last / 2):
            return e[:wanted], q[:, :wanted], worst, passes
        if worst > last / 8:                     # the block is too narrow for this spectrum
            more = min(dims, 2 * q.shape[1]) - q.shape[1]
            q = np.linalg.qr(np.hstack([q, rng.standard_normal((dims, more))]))[0]
            last = np.inf
            continue
        last = worst
        half = max(float(e[-1]), 1e-12 * top) / 2        # damped: [0, smallest Ritz value]
        sigma = first = half / (top - half) if top > 1.0001 * half else 1.0
        y0, y = q, (w - half * q) * (sigma / half)
        for _ in range(degree - 1):
            new = 1 / (2 / first - sigma)
            y0, y = y, (product(y) - half * y) * (2 * new / half) - (sigma * new) * y0
            sigma = new
            passes += 1
        q = np.linalg.qr(y)[0]
    raise RuntimeError(f"the components have not settled after {max_rounds} rounds")


def fit_whitening(vectors: DataFrame, components: int = 4, **kw) -> Whitening | None:
    """Fit on the distinct vectors of ``gridded`` rows; None if nothing varies."""
    fit = written(vectors.select("x").distinct(), "whitening-fit")
    n, s = _sums(fit)
    model = None
    if n and s:
        trace = 0.0

        def product(q):
            nonlocal trace
            v, trace = _moments(fit, n, s, q)
            return v

        e, q, worst, passes = subspace(product, len(s), min(components, len(s)), **kw)
        real = e > FLOOR * trace
        if trace > 0 and real.any():
            e, q = e[real], q[:, real]
            q = q * np.sign(q[np.abs(q).argmax(axis=0), np.arange(q.shape[1])])
            model = Whitening(n, s, e, q, trace, worst, passes)
            got, _ = _moments(fit, n, s, q / np.sqrt(e), own=True)
            model.identity_error = float(np.abs(got - np.eye(len(e))).max())
    discard(fit.sparkSession, fit)
    return model


OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
       "identity_error double, deviation_exact decimal(38,0)")


def whiten(vectors: DataFrame, model: Whitening | None) -> DataFrame:
    """A row for each of the ``gridded`` rows and component (numbered from 1 by falling
    variance). ``deviation`` is the exact sum of (n x - s)² over the dimensions, null where
    it passes 64 bits; ``deviation_exact`` holds it up to 38 digits."""
    spark = vectors.sparkSession
    if model is None:
        return spark.createDataFrame([], OUT)
    held = spark.sparkContext.broadcast(model)
    names = [c.split()[0] for c in OUT.split(", ")]

    def run(batches):
        from .whitening import centred, from_keys
        m = held.value
        k, d = len(m.values), len(m.s)
        scaled = m.vectors / np.sqrt(m.values)
        s = np.array(m.s, dtype=object)
        s_top, s_square = int(max(abs(s))), int((s * s).sum())
        small = s.astype(np.int64) if s_top < 2 ** 62 else s
        for b in batches:
            for lo in range(0, len(b), ROWS):
                part = b.slice(lo, ROWS)
                x = from_keys(part.column(1).to_pylist(), d)
                top = max(abs(int(x.min())), int(x.max()))
                a = x if top * top * d < 2 ** 62 else x.astype(object)
                c = x if top * s_top * d < 2 ** 62 else x.astype(object)
                dev = (m.n * m.n * (a * a).sum(axis=1).astype(object)
                       - 2 * m.n * (c * small).sum(axis=1).astype(object) + s_square)
                dev = [int(v) for v in dev]
                rows = np.repeat(np.arange(len(part)), k)
                count = len(rows)
                white = (centred(x, m.n, m.s) @ scaled).ravel()
                short = pa.array([v if v < 2 ** 63 else None for v in dev], pa.int64())
                exact = pa.array([Decimal(v) if v < 10 ** 38 else None for v in dev], pa.decimal128(38, 0))
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1), len(part)), pa.int32()),
                     pa.array(np.full(count, m.n)), short.take(at), pa.array(white),
                     pa.array(np.tile(m.values / m.trace, len(part))),
                     pa.array(np.full(count, m.identity_error)), exact.take(at)], names=names)

    return vectors.mapInArrow(run, OUT)
