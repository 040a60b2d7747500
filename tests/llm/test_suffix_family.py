import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest

from riskframe.llm import fingerprints
from riskframe.llm import suffix_family as t
from riskframe.llm.common import narrow
from riskframe.llm.queries import QUERIES
from riskframe.llm.suffix_family import dedup_bytes


def brute(docs, w):
    """(n_bytes, n_removed, n_spans, kept) per row."""
    raw = [(t or "").encode() for t in docs]
    seen = Counter(hash(r[i:i + w]) if w > 64 else r[i:i + w] for r in raw for i in range(len(r) - w + 1))
    out = []
    for r in raw:
        hit = bytearray(len(r) + 1)
        last = -1
        for i in range(len(r) - w + 1):
            if seen[hash(r[i:i + w]) if w > 64 else r[i:i + w]] > 1:
                for k in range(max(i, last + 1), i + w):
                    hit[k] = 1
                last = i + w - 1
        runs = sum(1 for i in range(len(r)) if hit[i] and not (i and hit[i - 1]))
        out.append((len(r), sum(hit), runs, bytes(b for b, h in zip(r, hit) if not h)))
    return out


def got(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect())


def mutated(rng, n, size, alphabet):
    base = ["".join(rng.choice(alphabet) for _ in range(size)) for _ in range(4)]
    out = []
    for _ in range(n):
        a, b = rng.choice(base), rng.choice(base)
        i, j = sorted(rng.sample(range(size), 2))
        t = list(a[:i] + b[i:j] + a[rng.randint(0, size - 1):])
        for _ in range(rng.randint(0, 3)):
            t[rng.randrange(len(t))] = rng.choice(alphabet)
        out.append("".join(t))
    return out


@pytest.mark.parametrize("limit", [4096, 2])
def test_near_copies_match_brute_force(spark, make_docs, with_clashes, limit):
    rng = random.Random(11)
    ts = mutated(rng, 60, 300, "abcdefé ") + [None, "", "short", "ab" * 200, "x" * 300, "x" * 45]
    want = sorted((False, i, *b) for i, b in enumerate(brute(ts, 40)))
    out = dedup_bytes(with_clashes(make_docs(ts), "s1", "s2", "batch"), window=40, context=16, batches=3, group_limit=limit)
    assert got(out) == want
    assert any(w[3] for w in want) and any(w[5] for w in want)


def test_repeated_rows_and_null_ids(spark, make_docs):
    t = "the quick brown fox jumps over the lazy dog and runs away"
    docs = make_docs([(1, t), (1, t), (None, "unlike " * 3 + "anything else in here, really"), (2, "no repeat in this one at all, ever")])
    rows = got(dedup_bytes(docs, window=30, context=16, batches=2))
    assert [r[3] for r in rows] == [len(t), len(t), 0, 0]
    assert dedup_bytes(make_docs([]), window=30, context=16).count() == 0


def test_whole_table_matches_brute_force(spark):
    d = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").orderBy("doc_id").collect()]
    want = {i: (n, g, s, hashlib.sha256(k).hexdigest())
            for (i, _), (n, g, s, k) in zip(docs, brute([t for _, t in docs], 400))}
    rows = QUERIES["op10_suffix_dedup"](spark, d).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want
    assert len(rows) == len(docs) and any(v[1] for v in want.values())


def test_a_worker_keeps_little_of_much_text(monkeypatch):
    """Slices are small, and so are the tables of powers that a worker keeps after them."""
    rng = random.Random(3)
    texts = ["".join(rng.choices("abcdef ", k=2000)) for _ in range(1500)]
    monkeypatch.setattr(fingerprints, "POWERS", (fingerprints.Powers(0), fingerprints.Powers(1)))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    slices = list(t._each([batch]))
    assert sum(len(d) for _, d, _ in slices) == 3_000_000 and sum(len(b) for b, _, _ in slices) == len(texts)
    for _, data, offsets in slices:
        t.sampled(data, offsets, 400, 160)
    assert max(len(p.up) for p in fingerprints.POWERS) <= 1 << 19


def test_batches_to_workers_are_small(spark, make_docs):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes]), pa.array([len(b)])], names=["size", "n"])

    docs = narrow(make_docs([c * 1_000_000 for c in "abcdefghijklmnopqrst"]).coalesce(1))
    got = docs.mapInArrow(sizes, "size long, n long").collect()
    assert sum(r.n for r in got) == 20 and max(r.size for r in got) < 8_000_000
