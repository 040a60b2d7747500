import random

import numpy as np
import pyarrow as pa
import pytest

from riskframe.llm import pieces
from riskframe.llm.common import tokenizer_path
from riskframe.llm.queries import QUERIES

V = pieces.Vocabulary(tokenizer_path("piece_bpe_32k.model"))


def brute_score(s):
    """Best score of marked text by plain dynamic programming over all pieces."""
    best = [0] + [None] * len(s)
    for i in range(len(s)):
        if best[i] is None:
            continue
        for j, x, _ in V.options(s, i, len(s)):
            if best[j] is None or best[i] + x > best[j]:
                best[j] = best[i] + x
    return best[-1]


def texts(n, seed, size=60):
    rng = random.Random(seed)
    al = ["the", "ing", " ", "  ", "é", "ß", "中", "▁", "", "\n", "\t", "a", "Z", "7", "𝄞", "tion", "0", "1"]
    return ["".join(rng.choice(al) for _ in range(rng.randint(0, size))) for _ in range(n)]


def test_units_give_the_best_score_and_round_trip():
    for t in texts(400, 1):
        ids, score = V.encode(t)
        assert V.decode(ids.tolist()) == t
        assert score == (brute_score(V.marked(t)) if t else 0)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 40])
def test_chunks_combine_to_the_same_score(n):
    for t in texts(60, n, 40) + ["internationalization" * 6, "x" * 50, "中" * 30]:
        if not t:
            continue
        s = V.marked(t)
        at = list(range(0, len(s), n))
        parts = [(s[i:i + n + V.longest], min(n, len(s) - i)) for i in at]
        ms = [V.transfer(*p) for p in parts]
        front = ms[0]
        for m in ms[1:]:
            front = pieces.combine(front, m)
        assert front[0, 0] == brute_score(s)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 20])
def test_chunks_settle_ties_like_whole_texts(n):
    """Equal scores everywhere: only the tie rule decides, and it is the same in chunks."""
    keep = V.scores.copy(), dict(V.ids)
    try:
        for p, (i, _) in V.ids.items():
            V.ids[p] = (i, -100 * len(p))        # every segmentation of a plain text scores the same
        for t in ["internationalization" * 3, "theingtion" * 9, "a" * 70, "thing▁then" * 5]:
            s = V.marked(t)
            at = list(range(0, len(s), n))
            parts = [(s[i:i + n + V.longest], min(n, len(s) - i)) for i in at]
            front = np.full((1, V.longest), pieces.NEVER)
            front[0, 0] = 0
            fronts = []
            V.memo.clear()
            V.whole = lambda x: [(np.asarray(ids, "<i4").tobytes(), y) for u in V.units(x) for y, ids in [V.best(u)]]
            for p in parts:
                fronts.append(front[0])
                front = pieces.combine(front, V.transfer(*p))
            maps = [V.entries(*p, f) for p, f in zip(parts, fronts)]
            b, ids = 0, []
            for p, f, m in reversed(list(zip(parts, fronts, maps))):
                ids = V.trace(*p, f, b)[0] + ids
                b = int(m[b])
            score, whole = V.best(s)
            assert b == 0 and ids == whole and front[0, 0] == score
    finally:
        V.scores, V.ids = keep
        V.memo.clear()
        del V.whole


def test_combine_is_associative():
    rng = np.random.default_rng(3)
    a, b, c = (np.where(rng.random((4, 4)) < .2, pieces.NEVER, -rng.integers(0, 99, (4, 4))) for _ in range(3))
    left = pieces.combine(pieces.combine(a, b), c)
    assert (left == pieces.combine(a, pieces.combine(b, c))).all()


def test_spark_chunks_equal_whole_texts(spark, make_docs, with_clashes):
    ts = texts(60, 9, 300) + ["ab" * 500, "long word " * 200, None, "", "ab" * 500]
    docs = with_clashes(make_docs([(i, t) for i, t in enumerate(ts)] + [(0, ts[0]), (None, "null id " * 30)]))
    for chunk in (23, 64, 1 << 15):
        rows = pieces.decode(pieces.encode(docs, chunk=chunk)).collect()
        assert len(rows) == len(ts) + 2
        for r in rows:
            t = "null id " * 30 if r.doc_id is None else ts[r.doc_id]
            assert r.text == t
            assert r.ids is None if t is None else (r.ids, r.score) == (V.encode(t)[0].tolist(), V.encode(t)[1])
            if t and len(t) > chunk:
                assert r.n_chunks > 1
    assert pieces.encode(make_docs([])).count() == 0


def test_whole_table_round_trip(spark):
    d = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op7_sentencepiece"](spark, d).collect()}
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs) and all(r.round_trip for r in rows.values())
    assert any(r.n_chunks > 1 for r in rows.values())
    for x in docs[::40]:
        ids, score = V.encode(x.text)
        assert (rows[x.doc_id].n_pieces, rows[x.doc_id].score) == (len(ids), score)


def test_rows_are_cut_into_words_that_are_segmented_once(monkeypatch):
    rows = [*texts(300, 8), *(" ".join(x.split()) for x in texts(300, 9)), "", "\n", "\n\na.\n b,\nc. d", " a", "a ",
            "a \nb", "the the. the\nthe, the", "\ue0001 the"]
    seen = []
    segment = V.segment
    monkeypatch.setattr(V, "segment", lambda units: seen.extend(units) or segment(units))
    V.words._forget()
    V.memo.clear()
    flat, lens, score = V.encode_rows(pa.array([*rows, None]))
    ends = np.cumsum(lens)
    for x, n, z, worth in zip(rows, lens, ends, score):
        assert (int(worth), flat[z - n:z].tolist()) == (V.best(V.marked(x)) if x else (0, []))
    assert lens[-1] == score[-1] == 0
    seen.clear()
    V.words._forget()
    V.encode_rows(pa.array(["the ring. the ring, ring! the", "the\nring the ring."]))
    assert sorted(seen) == sorted(["\u2581the", "\u2581ring", "ring"])


def test_trie_finds_every_piece():
    pieces_ = {"a": 1, "ab": 2, "abc": 3, "bc": 4, "c": 5, "é": 6, "éa": 7, "bcbc": 8}
    rng = random.Random(2)
    text = "".join(rng.choice("abcé\n中") for _ in range(500))
    got = sorted(zip(*(x.tolist() for x in pieces.Trie(pieces_).places(text))))
    assert got == sorted((i, len(p), k) for p, k in pieces_.items() for i in range(len(text)) if text.startswith(p, i))
