import random
import re

import pyarrow as pa
import pytest

from riskframe.llm import common, fingerprints
from riskframe.llm import jaccard as J
from riskframe.llm.queries import QUERIES


def shingle_set(text, n=5):
    ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(ws) < n:
        return frozenset([tuple(ws)]) if ws else frozenset()
    return frozenset(tuple(ws[i:i + n]) for i in range(len(ws) - n + 1))


def brute(docs, n=5):
    sets = [(i, shingle_set(t, n)) for i, t in docs]
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)):
                k = len(a & b)
                if 100 * k >= 80 * (len(a) + len(b) - k):
                    up[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(sets):
        low[root(i)] = min(low.get(root(i), d), d)
    return sorted((d, len(s), low[root(i)]) for i, (d, s) in enumerate(sets))


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_filters_hold_for_all_sizes():
    for a in range(1, 300):
        for b in range(a, min(299, a * 100 // 80) + 1):
            # the least intersection that links
            k = next(k for k in range(a + 1) if 100 * k >= 80 * (a + b - k))
            need = max(1, J.least_overlap(b) * 10 // 100)
            # elements outside the prefixes: the last n - prefix(n); all common ones there at worst
            shared = k - min(a - J.prefix(a), b - J.prefix(b))
            assert min(J.prefix(a) - (a - k), J.prefix(b) - (b - k)) >= 0
            assert J.common(a) >= need and shared >= 1


@pytest.mark.parametrize("seed", [1, 2])
def test_random_near_copies(spark, make_docs, with_clashes, seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    passage = [word() for _ in range(40)]
    docs = []
    for _ in range(12):
        base = [word() for _ in range(rng.choice([3, 5, 6, 8, 11, 14, 20, 60, 150]))]
        for _ in range(rng.randint(1, 12)):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                k = rng.randrange(len(t))
                t[k:k + 1] = rng.choice([[word()], [], [t[k], word()]])
                t = t or [word()]
            docs.append(" ".join(t))
        docs.append(" ".join([word() for _ in range(60)] + passage))
        docs.append(" ".join(passage + [word()]))
    docs = list(enumerate(docs)) + [(900, None), (901, " \n"), (902, docs[0].upper()), (903, "w1 w2 w3 w4"),
                                    (904, "w1 w2 w3 w4")]
    rng.shuffle(docs)
    assert got(J.jaccard_components(with_clashes(make_docs(docs), "n", "cls", "token"))) == brute(docs)


def test_large_groups(spark, make_docs):
    rng = random.Random(8)
    base = [f"b{i}" for i in range(120)]
    docs = []
    for i in range(250):
        t = list(base)
        for _ in range(rng.randint(0, 3)):
            t[rng.randrange(120)] = f"x{i}"
        docs.append((i, " ".join(t)))
    docs += [(1000 + i, " ".join(base[:60] + [f"y{i}_{k}" for k in range(60)])) for i in range(150)]
    assert got(J.jaccard_components(make_docs(docs))) == brute(docs)


def test_empty_and_repeated_rows(spark, make_docs):
    assert J.jaccard_components(make_docs([])).count() == 0
    t = "one two three four five six seven eight"
    rows = J.jaccard_components(make_docs([(3, t), (3, t), (None, t), (7, t + " nine"), (5, "")])).collect()
    by = sorted((r.doc_id is None, r.doc_id or 0, r.component_id) for r in rows)
    assert by == [(False, 3, 3), (False, 3, 3), (False, 5, 5), (False, 7, 3), (True, 0, 3)]


def test_whole_table_matches_brute_force(spark):
    d = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    want = brute(docs)
    assert got(QUERIES["op8_ngram_jaccard"](spark, d)) == want
    assert any(c != i for i, _, c in want)


def test_parity_bits_bound_the_difference():
    import numpy as np
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(900) < keep], rng.integers(0, 1 << 63, more, dtype=np.uint64)]))
            for keep in (0, 0.02, 0.5, 0.95, 1) for more in (0, 1, 40)]
    at = np.cumsum([0] + [len(x) for x in sets])
    bits = J.parity_bits(at, np.concatenate(sets))
    assert bits.shape == (len(sets), J.BITS)
    for x, a in zip(sets, bits):
        for y, b in zip(sets, bits):
            apart = sum(bin(int(v) & (2 ** 64 - 1)).count("1") for v in a ^ b)
            assert apart <= len(np.setxor1d(x, y))
            if len(np.setxor1d(x, y)) == 1:
                assert apart == 1


def test_last_round_alone_finds_every_link(spark, make_docs, monkeypatch):
    """No leader rounds: all links come from the filtered pairs."""
    rng = random.Random(12)
    base = [f"w{k}" for k in range(60)]
    docs = []
    for i in range(120):
        x = list(base)
        for _ in range(rng.randrange(5)):
            x[rng.randrange(60)] = f"v{rng.randrange(30)}"
        docs.append((i, " ".join(x)))
    links = J.list_links
    monkeypatch.setattr(J, "list_links", lambda rows, sets, n, percent: links(rows, sets, n, percent, rounds=0))
    out = got(J.jaccard_components(make_docs(docs)))
    assert out == brute(docs) and len({c for _, _, c in out}) > 3


def test_a_worker_keeps_little_of_much_text(monkeypatch):
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choices("abcdef", k=5)) for _ in range(400)) for _ in range(1500)]
    monkeypatch.setattr(fingerprints, "POWERS", (fingerprints.Powers(0), fingerprints.Powers(1)))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    at = 0
    for b, data, offsets in J._slices([batch]):
        ends, values = J.shingles(data, offsets, 5)
        assert [int(x) for x in ends[1:] - ends[:-1]] == [len(shingle_set(x)) for x in texts[at:at + len(b)]]
        at += len(b)
    assert at == len(texts) and max(len(p.up) for p in fingerprints.POWERS) <= 1 << 18


def test_what_other_operators_keep_is_let_go():
    common.kept("anything", 1, lambda: [1])
    common.release()
    assert not common._KEPT


def test_disk_is_given_back_between_the_steps(spark, make_docs, monkeypatch):
    """op8's disk: the listed shingles go before the inverted lists are made, and a list table is
    never beside the next one's shuffles of its own join."""
    live, seen = set(), {}
    names = {}

    def write(df, name, f=J.written):
        out = f(df, name)
        names[out.scratch_path] = name
        live.add(out.scratch_path)
        seen.setdefault(name, []).append({names[p] for p in live})
        return out

    def drop(s, *tables, f=J.discard):
        live.difference_update(t.scratch_path for t in tables)
        f(s, *tables)
    monkeypatch.setattr(J, "written", write)
    monkeypatch.setattr(J, "discard", drop)
    base = [f"w{k}" for k in range(40)]
    docs = [(i, " ".join([*base[:i % 7], f"v{i % 5}", *base[i % 7:]])) for i in range(30)]
    assert got(J.jaccard_components(make_docs(docs))) == brute(docs)
    for name in ("whole-sets", "inverted-lists"):
        assert all("shingle-sets" not in x for x in seen[name])
    assert len(seen["lists-held"]) == 4 and all("list-sizes" not in x for x in seen["lists"][1:])


def test_listed_shingles_and_texts_are_shuffled_in_parts(spark, make_docs, monkeypatch):
    """op8's disk: neither all listed shingles nor all texts are in shuffle files at once, and the
    join with the texts is the same at every size, so that a small run tells of a large one."""
    made = {}

    def write(df, name, f=J.written):
        plan = df._jdf.queryExecution().executedPlan().toString()
        out = f(df, name)
        made.setdefault(name, []).append((out.count(), plan))
        return out
    monkeypatch.setattr(J, "written", write)
    base = [f"w{k}" for k in range(40)]
    docs = [(i, " ".join([*base[:i % 37], f"v{i % 29}", *base[i % 37:]])) for i in range(60)]
    docs += [(100, docs[3][1]), (101, None), (102, "")]
    assert got(J.jaccard_components(make_docs(docs))) == brute(docs)
    assert len(made["whole-sets"]) == len(made["tokens"]) == J.PARTS > 1
    for name in ("whole-sets", "tokens"):
        rows = [n for n, _ in made[name]]
        assert max(rows) < sum(rows), (name, rows)
    assert all("SortMergeJoin" in p and "BroadcastHashJoin" not in p for _, p in made["whole-sets"])
