"""Packing against the tokenizers library, a plain best fit and the rules of a window."""
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from riskframe.llm import packing as t
from riskframe.llm.word_units import WordEncoder

TOK = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text):
    return TOK.encode(text or "", add_special_tokens=False).ids + [2]


def check(pieces, texts, window=4096):
    """Every id in one piece, windows gapless and within size; -> padding share."""
    docs, seqs = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p["doc_id"]].append(p)
        seqs[p["sequence_id"]].append(p)
    want = defaultdict(list)
    for i, x in texts:
        want[i].append(ids_of(x))
    assert set(docs) == set(want)
    for i, ps in docs.items():
        assert sorted(p["doc_tokens"] for p in ps if p["start"] == 0) == sorted(map(len, want[i]))
        if len(want[i]) == 1:
            ps.sort(key=lambda p: p["start"])
            got = b"".join(p["ids"] for p in ps)
            assert np.frombuffer(got, "<u4").tolist() == want[i][0]
            assert [p["start"] for p in ps] == np.cumsum([0] + [p["length"] for p in ps])[:-1].tolist()
    pad = 0
    for ps in seqs.values():
        ps.sort(key=lambda p: p["offset"])
        ends = np.cumsum([p["length"] for p in ps])
        assert [p["offset"] for p in ps] == [0, *ends[:-1].tolist()] and ends[-1] <= window
        assert all(p["length"] == len(p["ids"]) // 4 > 0 for p in ps)
        n = int(ends[-1])
        pad += 0 if n & (n - 1) == 0 else window - n
    return pad / max(1, sum(p["length"] for p in pieces))


def test_query_on_whole_table(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    texts = [tuple(r) for r in docs.collect()]
    pieces = t.pack(docs)
    assert check(pieces.collect(), texts) < 0.01
    assert pieces.drop("ids").distinct().count() == pieces.count()
    got = entry.queries()["op11_packing"](spark, d).collect()
    want = {i: ids_of(x) for i, x in texts}
    assert sum(r["length"] for r in got) == sum(map(len, want.values()))
    for r in got:
        ids = want[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes()) and r["doc_tokens"] == len(want[r["doc_id"]])


def test_faults_and_clashing_names(spark, make_docs, with_clashes):
    words = "the quick brown fox JUMPED over Ångström".split()
    rnd = random.Random(2)
    texts = [(i, " ".join(rnd.choices(words, k=rnd.randrange(1, 400)))) for i in range(120)]
    texts += [(1, None), (2, ""), (3, " \n\t "), (None, "a b"), (5, texts[5][1]), (200, "x" * 30_000),
              (201, "a<|endoftext|>b <|startoftext|>"), (202, "é q  r\x0bs\x85t"), (203, "don't stop 12 345!!!")]
    df = with_clashes(make_docs(texts).repartition(4), "ids", "length", "sequence_id", "settled", "g")
    for kw in ({}, {"run": 3_000, "open_windows": 2, "group": 5_000}, {"window": 64, "run": 500, "group": 900}):
        window = kw.get("window", 4096)
        assert check(t.pack(df, **kw).collect(), texts, window) < 0.02
    assert t.pack(make_docs([])).collect() == []


def test_lengths_that_do_not_pair_up(spark, make_docs):
    """Documents just over half a window: no two share one, so most of them are cut."""
    texts = [(i, " ".join(["a"] * 2100)) for i in range(60)]
    assert check(t.pack(make_docs(texts).repartition(3), open_windows=4).collect(), texts) < 0.01


def test_sequences_and_padding(spark, make_docs):
    pieces = t.pack(make_docs([" ".join(["b"] * n) for n in (4095, 10, 20, 5000, 1)]))
    r = t.padding(pieces).first()
    seqs = t.sequences(pieces).collect()
    assert r["sequences"] == len(seqs) and r["tokens"] == 4096 + 11 + 21 + 5001 + 2 and r["padding"] == 0
    assert all(len(s["ids"]) == 4 * s["n_tokens"] for s in seqs)


def test_tree_is_best_fit():
    rnd = random.Random(4)
    for size in (1, 7, 64, 100):
        tree, plain = t.RoomTree(size), []
        for k in range(3000):
            need = rnd.randint(1, size)
            if rnd.random() < 0.5:
                tree.put(need, k)
                plain.append(need)
            else:
                fits = [r for r in plain if r >= need]
                got = tree.take(need)
                assert (got[0] if got else None) == (min(fits) if fits else None)
                if fits:
                    plain.remove(got[0])
        assert [r for r, _ in tree.drain()] == sorted(plain) and tree.take(1) is None


def test_one_end_id_for_empty_tables_of_empty_texts(spark, make_docs):
    got = t.pack(make_docs(["", None, ""])).orderBy("offset").collect()
    assert sum(r["length"] for r in got) == 3 and all(r["ids"] == b"\2\0\0\0" or r["length"] > 1 for r in got)
    assert {r["doc_tokens"] for r in got} == {1}


def test_capitals_and_stops_are_encoded_once_and_as_by_the_library():
    enc = WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    encoded = []
    plain = enc._encode
    enc._encode = lambda text: encoded.append(text) or plain(text)
    texts = ["Apple apple, APPLE. aPPle! apple; apple? Apple:", "It's I'LL. x's. 'S. 's.", "H\u0331a. H\u0331 h\u0331",
             "\u0130. a\u0130. A\u030aA.", "\u00dfA. \u1e9e. \u00c9t\u00c9. \u00e9t\u00e9", "\u03a3\u03a3. a\u2019S.", "A.B. A. b.", "7. 7.a .", None, ""]
    for lo, hi, lens, ids in enc.encode(pa.array(texts)):
        got = [x.tolist() for x in np.split(ids, np.cumsum(lens)[:-1])]
        assert got == [ids_of(x)[:-1] for x in texts[lo:hi]]
    words = [w for x in encoded for w in x.split(" ")]
    assert words.count("apple") == 1 and not [w for w in words if w != "apple" and w.lower().startswith("apple")]
