import random

import numpy as np
import pytest

from riskframe.llm import recompression as R
from riskframe.llm.fingerprints import window_minima
from tests.llm.oracle import same_as_oracle


def brute(docs, w):
    first = {}
    split = {d: (t or "").encode().split() for d, t in docs}
    for d, ws in split.items():
        for i in range(len(ws) - w + 1):
            k = tuple(ws[i:i + w])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, ws in split.items():
        hit = set()
        for i in range(len(ws) - w + 1):
            if first[tuple(ws[i:i + w])] < d:
                hit |= set(range(i, i + w))
        out.append((d, len(ws), len(hit), b" ".join(x for i, x in enumerate(ws) if i not in hit).decode()))
    return sorted(out)


def got(df):
    return sorted((r.doc_id, r.n_words, r.n_removed, r.text) for r in df.collect())


@pytest.mark.parametrize("window,alphabet", [(5, 2), (12, 2), (12, 6), (50, 30)])
def test_random_copies_match_brute_force(spark, make_docs, with_clashes, window, alphabet):
    rng = random.Random(window + alphabet)
    base = [[f"w{rng.randrange(alphabet)}" for _ in range(4 * window)] for _ in range(5)]
    docs = []
    for i in range(80):
        a, b = rng.choice(base), rng.choice(base)
        x, y = sorted(rng.sample(range(4 * window), 2))
        t = a[:x] + b[y - x:y] + [f"u{i}"] * rng.randint(0, 3) + a[y:]
        for _ in range(rng.randint(0, 2)):
            t[rng.randrange(len(t))] = "zz"
        docs.append((i, rng.choice([" ", "\n", " \t"]).join(t)))
    docs += [(200, None), (201, ""), (202, "w0 " * 300), (203, "w0 " * 299), (204, "w0 w1 " * 100), (205, "w0 w1 " * 90)]
    want = brute(docs, window)
    assert got(R.dedup_substrings(with_clashes(make_docs(docs), "lo", "hi", "region", "s_id"), window)) == want
    assert any(x[2] for x in want) and any(x[1] and not x[2] for x in want)


def test_ids_repeats_and_empty(spark, make_docs):
    t = " ".join(f"a{i}" for i in range(60))
    rows = R.dedup_substrings(make_docs([(3, t), (3, t), (3, "x " + t), (None, t), (8, t), (9, t + " end")])).collect()
    gone = sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in rows)
    assert gone == [(False, 3, 0), (False, 3, 0), (False, 3, 0), (False, 8, 60), (False, 9, 60), (True, 0, 0)]
    assert R.dedup_substrings(make_docs([])).count() == 0


def test_symbols_are_bounded_and_context_free():
    """Boundaries depend only on ``reach`` words to both sides and are never farther apart."""
    rng = np.random.default_rng(1)
    rounds, reach = R.levels(50)
    assert (rounds, reach) == (3, 16) and R.levels(5)[1] == 2
    with pytest.raises(ValueError):
        R.levels(4)
    for alphabet in (1, 2, 5, 1000):
        core = rng.integers(0, alphabet, 400).astype(np.uint64)
        seen = []
        for k in (0, 3, 50):
            names = np.concatenate((rng.integers(0, 9, k).astype(np.uint64), core, rng.integers(0, 9, 7).astype(np.uint64)))
            b = R.boundaries(names, np.arange(len(names)) == 0, rounds)
            assert np.diff(b).max() <= reach
            seen.append({int(x) - k for x in b if k + reach <= x <= k + 400 - reach})
        assert seen[0] == seen[1] == seen[2]


def test_window_minima():
    rng = np.random.default_rng(2)
    k = rng.integers(0, 9, 200).astype(np.uint64)
    for w in (1, 2, 5, 19, 200):
        m, at = window_minima(k, w)
        for i in range(len(k) - w + 1):
            assert m[i] == k[i:i + w].min() and at[i] == i + int(k[i:i + w].argmin())


def test_oracle(spark):
    same_as_oracle(spark, "op4_substring_dedup")
