import random
import re

import pytest

from riskframe.llm import decontaminate as D
from riskframe.llm.decontaminate import Automaton, decontaminate, find_hits
from riskframe.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t)) if t else []


def brute(docs, items, w=10):
    """{doc_id: (n_words, hit places, item ids)}"""
    wins = {}
    for i, t in items:
        ws = words(t)
        for k in range(max(1, len(ws) - w + 1)) if ws else ():
            wins.setdefault(tuple(ws[k:k + w]), set()).add(str(i))
    sizes = {len(x) for x in wins}
    out = {}
    for d, t in docs:
        ws, hit, found = words(t), set(), set()
        for n in sizes:
            for k in range(len(ws) - n + 1):
                own = wins.get(tuple(ws[k:k + n]))
                if own:
                    hit |= set(range(k, k + n))
                    found |= own
        out[d] = (len(ws), hit, sorted(found))
    return out


def got(df):
    return {r.doc_id: (r.n_words, {i for s in r.spans for i in range(s["first"], s["last"] + 1)}, r["items"])
            for r in df.collect()}


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_whole_tables_match_brute_force(spark):
    d = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    want = brute(docs, items)
    import hashlib
    rows = QUERIES["op6_decontamination"](spark, d).collect()
    assert len(rows) == len(docs) and any(r.contaminated for r in rows)
    for r in rows:
        n, hit, found = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, len(hit), len(found), bool(hit))
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_random_texts_small_alphabet(spark, make_docs, block_bytes):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(["a", "B", "c3", "é"]) for _ in range(n))
    docs = [(i, text(rng.randint(0, 60))) for i in range(150)] + [(900, None), (901, ""), (902, " .,!")]
    items = [(i, text(rng.randint(1, 14))) for i in range(40)] + [(41, None), (42, ""), (43, "?!")]
    h = find_hits(make_docs(docs), bench(spark, items), window=6, block_bytes=block_bytes)
    assert got(h) == brute(docs, items, 6)


def test_longest_match_and_no_match_across_items():
    a = Automaton([("1", [b"a", b"b", b"c"]), ("2", [b"d", b"e"])], 3)
    assert a.match([b"a", b"b"])[0] == 2
    longest, spans, items = a.match([b"c", b"d", b"x", b"a", b"b", b"c", b"d"])
    assert longest == 3 and spans == [(3, 5)] and items == {"1"}


def test_cut_and_drop(spark, make_docs, with_clashes):
    item = "one two three four five six seven eight nine ten eleven"
    docs = make_docs([f"Clean start, {item.upper()}; clean end of the text with more words here and there now.",
                      item, "nothing here", None, "", f"x {item}", "nothing here"])
    out = decontaminate(with_clashes(docs), bench(spark, [(1, item), (2, item)]), max_coverage=0.6)
    assert out.columns == with_clashes(docs).columns
    rows = {r.doc_id: r.text for r in out.collect()}
    assert rows[0] == "Clean start, ; clean end of the text with more words here and there now."
    assert set(rows) == {0, 2, 3, 4, 6} and rows[2] == rows[6] == "nothing here" and rows[3] is None


def test_empty_tables_and_repeated_rows(spark, make_docs):
    item = "a b c d e f g h i j"
    none = bench(spark, [])
    assert find_hits(make_docs([]), bench(spark, [(1, item)])).count() == 0
    assert [r.spans for r in find_hits(make_docs([item]), none).collect()] == [[]]
    twice = find_hits(make_docs([(1, item), (1, item), (1, "x"), (None, item)]), bench(spark, [(None, item), (3, item)]),
                      block_bytes=20)
    assert sorted((r.doc_id is None, r.n_words, r["items"]) for r in twice.collect()) == [
        (False, 1, []), (False, 10, ["3"]), (False, 10, ["3"]), (True, 10, ["3"])]


def test_very_long_text(spark, make_docs):
    item = " ".join(f"w{i}" for i in range(12))
    long = " ".join(f"v{i % 977}" for i in range(200_000))
    r = find_hits(make_docs([long + " " + item + " " + long]), bench(spark, [(1, item)])).first()
    assert r.n_words == 400_012 and [tuple(s) for s in r.spans] == [(200_000, 200_011)]


@pytest.mark.parametrize("item", [7, None])
def test_items_that_share_an_id_are_dealt_to_blocks(spark, make_docs, monkeypatch, item):
    rng = random.Random(8)
    items = [(item, " ".join(rng.choice(["ab", "cd", "ef", "gh"]) for _ in range(12))) for _ in range(60)]
    items += [(9, " ".join("x" * 60 + str(k) for k in range(8)))] + items[:20]
    docs = [(i, f"z {t} z") for i, (_, t) in enumerate(items[:65])] + [(99, "ab cd")]
    blocks, matcher = [], D._matcher
    monkeypatch.setattr(D, "_matcher", lambda held, window: blocks.append(held.value) or matcher(held, window))
    h = got(find_hits(make_docs(docs), bench(spark, items), window=6, block_bytes=400))
    want = {d: (n, hit, [x for x in found if x != "None"])
            for d, (n, hit, found) in brute(docs, items, 6).items()}
    assert h == want
    assert len({x for b in blocks for x in b}) == sum(map(len, blocks)) == 61
    assert all(sum(len(w) for _, w in b) <= 400 or len(b) == 1 for b in blocks)
