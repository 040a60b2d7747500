import itertools

import numpy as np
import pytest

from riskframe.llm import langid
from riskframe.llm.queries import QUERIES

PIECES = ["a", "ab", "b", "c", "bc", "▁", "▁a", "▁ab", "abc"]


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(2)
    p = rng.random((len(PIECES), 2))
    return langid.Model(["x", "y"], np.array([0.5, 0.5]), PIECES, p / p.sum(axis=0))


def segmentations(s, index):
    if not s:
        yield []
        return
    known = False
    for k in range(1, len(s) + 1):
        if s[:k] in index:
            known |= k == 1
            for rest in segmentations(s[k:], index):
                yield [index[s[:k]], *rest]
    if not known:
        for rest in segmentations(s[1:], index):
            yield [-1, *rest]


def test_forward_sums_all_segmentations(model):
    sc = langid.Scorer(model)
    words = ["".join(w) for n in range(1, 6) for w in itertools.product("abz", repeat=n)]
    got = sc.log_words(words)
    for w, x in zip(words, got):
        want = sum(np.prod([sc.p[k] for k in seg], axis=0) for seg in segmentations("▁" + w, sc.index))
        assert np.allclose(x, np.log(want), rtol=1e-5)


def test_expected_counts(model):
    sc = langid.Scorer(model)
    words, n = ["abc", "ab", "cab", "bz"], np.array([2.0, 1.0, 3.0, 1.0])
    want = np.zeros(len(PIECES) + 1)
    for w, c in zip(words, n):
        segs = list(segmentations("▁" + w, sc.index))
        ps = np.array([np.prod([sc.p[k, 1] for k in seg]) for seg in segs])
        for seg, p in zip(segs, ps / ps.sum()):
            for k in seg:
                want[k] += c * p
    order = np.argsort([len(w) for w in words], kind="stable")
    got = sc.expected([words[i] for i in order], n[order], 1)
    assert np.allclose(got, want[:-1])


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    rows = QUERIES["op9_language_id"](spark, d).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    assert len(rows) == len(lang) and all(0.0 <= r.score <= 1.0 for r in rows)
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    out = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]
    assert sum(out) / len(out) > 0.98


def test_edge_cases(spark, make_docs, with_clashes):
    train = make_docs(["the cat and the dog", "le chat et le chien", "der hund und die katze", None],
                      ["en", "fr", "de", None])
    m = langid.fit(train)
    assert m.langs == ["de", "en", "fr"]
    docs = with_clashes(make_docs([None, "", " 12 ²! ", "the dog", "the dog", "LE CHIEN", "x" * 500, "日本"]), "lang_pred")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, m).collect()}
    assert [got[i] for i in (0, 1, 2)] == [("und", 0.0)] * 3
    assert got[3] == got[4] and got[3][0] == "en" and got[5][0] == "fr"
    assert got[6][0] in m.langs and got[7][0] in m.langs
    none = langid.fit(train.where("lang is null"))
    assert {r.lang_pred for r in langid.predict(docs, none).collect()} == {"und"}
    assert langid.predict(make_docs([]), m).count() == 0
    capped = langid.fit(train.unionAll(train), docs_per_language=1, max_languages=2)
    assert len(capped.langs) == 2


def test_every_label_is_learnt(spark, make_docs):
    names = [f"{a}{b}" for a in "abcdefghijklmnopqr" for b in "abcdefghijklmnopq"]      # 306 labels
    own = {n: " ".join((n[0] * 2 + n[1] * 2, n[1] * 3 + n[0] * 3)) for n in names}
    train = make_docs([own[n] for n in names for _ in range(2)], [n for n in names for _ in range(2)])
    m = langid.fit(train)
    assert m.langs == sorted(names) and abs(m.prior.sum() - 1) < 1e-9 and np.allclose(m.prob.sum(axis=0), 1)
    rows = langid.predict(make_docs([own[n] for n in names]), m).collect()
    good = sum(r.lang_pred == names[r.doc_id] for r in rows)
    assert len(rows) == len(names) and good > 256


def test_labels_under_one_id_are_learnt(spark, make_docs):
    """All rows of a language under one id, some of them copies of one row."""
    de = [(77, f"der Hund und die Katze laufen {w} durch den Wald") for w in ("heute", "schnell", "wieder")] * 700
    en = [(i, f"the dog and the cat are running through the forest {i}") for i in range(900)]
    for same in (de, [(77, de[0][1])] * 2100):
        m = langid.fit(make_docs(same + en, ["de"] * len(same) + ["en"] * len(en)))
        got = langid.predict(make_docs(["die Katze und der Hund", "the cat and the dog"]), m).orderBy("doc_id").collect()
        assert [r["lang_pred"] for r in got] == ["de", "en"]


def test_long_words_are_scored_whole():
    rng = np.random.default_rng(2)
    pieces = sorted([langid.MARK, "a", "b", "ab", "ba", "aba", langid.MARK + "a", "bbb"])
    p = rng.random((len(pieces), 2))
    sc = langid.Scorer(langid.Model(["x", "y"], np.array([.5, .5]), pieces, p / p.sum(axis=0)))
    for n in (5, 40, 59):
        w = "".join(rng.choice(list("abc"), n))
        assert np.allclose(sc.log_long(w), sc.log_words([w])[0], rtol=1e-5)
    w = "ab" * 5000                                       # far below the least double
    half = sc.log_long("ab" * 2500)
    assert np.isfinite(sc.log_long(w)).all() and np.allclose(sc.log_long(w) / half, 2, rtol=1e-2)
    one, two = sc.score([w, "ab " + w]), sc.score([w])
    assert one[0][0] == two[0][0] and w not in sc.rows and "ab" in sc.rows
