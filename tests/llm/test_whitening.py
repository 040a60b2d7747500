"""Whitening against numpy's dense eigen-solver and exact integer sums."""
import math

import numpy as np
import pytest

import __spark_entry__ as entry
from riskframe.llm import whitening as t

KIND = "vec_id long, embedding array<float>"


def brute(rows, k=4):
    """x by id, the distinct list, and (values, vectors, trace) of its covariance."""
    good = [(i, [math.floor(256 * float(c)) + 0 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(x) for _, x in good), default=0)
    good = [(i, tuple(x) + (0,) * (d - len(x))) for i, x in good]
    fit = sorted({x for _, x in good})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[(n * a - b) / n for a, b in zip(x, s)] for x in fit]).reshape(n, d)
    v = y.T @ y / max(n, 1)
    e, q = np.linalg.eigh(v)
    order = np.argsort(-e)[:k]
    return good, n, s, e[order], q[:, order], np.trace(v)


def check(got, rows, k=4):
    good, n, s, e, q, trace = brute(rows, k)
    assert len(got) == len(good) * min(k, len(e))
    want = {}
    for i, x in good:
        want.setdefault(i, []).append(x)
    sign = {}
    for r in got:
        c = r["component"] - 1
        near = [x for x in want[r["vec_id"]] if sum((n * a - b) ** 2 for a, b in zip(x, s)) == r["deviation"]]
        assert near and r["n"] == n and r["deviation_exact"] == r["deviation"]
        z = [float((np.array(x) - np.array(s) / n) @ q[:, c] / math.sqrt(e[c])) for x in near]
        if c not in sign and abs(z[0]) > 1e-3:
            sign[c] = math.copysign(1, z[0] * r["whitened"])
        assert min(abs(sign.get(c, 1) * r["whitened"] - v) for v in z) < 1e-7
        assert r["explained"] == pytest.approx(e[c] / trace, rel=1e-10)
        assert r["identity_error"] < 1e-8


def run(spark, rows, kind=KIND, **kw):
    x = t.gridded(spark.createDataFrame(rows, kind).repartition(3))
    return t.whiten(x, t.fit_whitening(x, **kw)).collect()


def test_query_on_whole_table(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(entry.queries()["op12_whitening"](spark, d).collect(), rows)


def test_repeats_nulls_and_lengths(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(c) for c in rng.normal(size=6) * [9, 5, 3, 2, 1, 1]]) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(30)]              # a third are one vector
    rows += [(7, rows[3][1]), (200, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (202, [float("nan")] * 6),
             (203, [math.inf] + [0.0] * 5), (204, []), (205, [1.5, -2.0]), (206, [-0.0] * 6)]
    check(run(spark, rows), rows)


def test_null_id_and_clashing_names(spark):
    from pyspark.sql import functions as F
    rows = [(None, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [0.5, 0.7])]
    df = spark.createDataFrame(rows, KIND)
    for c in ("x", "n", "component", "i", "v", "whitened"):
        df = df.withColumn(c, F.lit("x"))
    x = t.gridded(df)
    got = t.whiten(x, t.fit_whitening(x)).collect()
    assert len(got) == 6 and sum(r["vec_id"] is None for r in got) == 2


def test_nothing_varies(spark):
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    assert run(spark, []) == [] and run(spark, [(1, None), (2, [])]) == []


def test_deviation_beyond_64_bits(spark):
    rows = [(i, [(-1.0) ** i * 1e9 * i, 5.0]) for i in range(9)]
    got = run(spark, rows, "vec_id long, embedding array<double>")
    good, n, s, *_ = brute(rows)
    want = {i: sum((n * a - b) ** 2 for a, b in zip(x, s)) for i, x in good}
    assert max(want.values()) > 2 ** 63
    for r in got:
        assert int(r["deviation_exact"]) == want[r["vec_id"]]
        assert r["deviation"] == (want[r["vec_id"]] if want[r["vec_id"]] < 2 ** 63 else None)


def test_keys_are_canonical():
    rng = np.random.default_rng(3)
    for top in (3, 2 ** 15, 2 ** 31, 2 ** 62):
        x = rng.integers(-top, top, size=(20, 5))
        x[::4, 2:] = 0
        x[5] = 0
        keys = t.to_keys(x)
        assert (t.from_keys(keys, 5) == x).all()
        assert t.to_keys(np.hstack([x, np.zeros((20, 3), np.int64)])) == keys


@pytest.mark.parametrize("spectrum", ["flat", "equal", "steep", "pairs", "few"])
def test_subspace_on_hard_spectra(spectrum):
    rng = np.random.default_rng(5)
    d = 80
    e = {"flat": 1 + 0.001 * np.arange(d), "equal": np.ones(d), "steep": 10.0 ** -np.arange(d).clip(max=30),
         "pairs": np.repeat(np.arange(1, 41), 2) * 1.0, "few": np.r_[[3, 2.0], np.zeros(d - 2)]}[spectrum]
    o = np.linalg.qr(rng.standard_normal((d, d)))[0]
    v = (o * e) @ o.T
    got, q, worst, _ = t.subspace(lambda b: v @ b, d, 4)
    assert got == pytest.approx(np.sort(e)[::-1][:4], rel=1e-9, abs=1e-12) and worst < 1e-13
    assert np.abs(q.T @ q - np.eye(4)).max() < 1e-12
