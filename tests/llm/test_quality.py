import re
from collections import Counter
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

from riskframe.llm import quality as Q
from riskframe.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    ws = WORD.findall(text or "")
    lines, dup, seen = (text or "").split("\n"), 0, set()
    for x in lines:
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    tri = Counter(zip(ws, ws[1:], ws[2:]))
    hit = {j for i in range(len(ws) - 2) if tri[tuple(ws[i:i + 3])] > 1 for j in range(i, i + 3)}
    sym = sum(c in "#*$%&|<>" for c in text or "")
    return (len(ws), sum(map(len, ws)), sym, dup, len(hit), len(ws) < 50 or 100 * len(hit) > 50 * len(ws))


def row(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_whole_table_base_measures(spark):
    d = "/root/testdata/sf0.01"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = QUERIES["op3_quality_rules"](spark, d).collect()
    assert len(rows) == len(text)
    for r in rows:
        assert row(r) == brute(text[r.doc_id])
        assert not (r.base_failed and r.kept) and r.kept == (not r.base_failed and r.failed_rules == "")


def test_measures_edge_cases(spark, make_docs, with_clashes):
    ts = [None, "", " \t\n\x0b", "a b c", "a b c a b c", "a a a a", "\n".join(["x", "x", " ", " ", "x "]), "é𝄞 ü|<>",
          "a b\x85c d", "a b c d a b c x b c d", "w " * 500, "long " + "z" * 100_000]
    docs = with_clashes(make_docs(ts), "w", "l", "stratum", "x")
    assert {r.doc_id: row(r) for r in Q.measures(docs).collect()} == {i: brute(t) for i, t in enumerate(ts)}
    assert Q.measures(make_docs([])).count() == 0


@pytest.mark.parametrize("share", [0.005, 0.1])
def test_binomial_tail_is_exact(spark, share):
    cases = [(n, k) for n in (0, 1, 7, 60, 400) for k in (0, 1, 2, 5, 20, 60) if k <= n]
    df = spark.createDataFrame(cases, "n long, k long").select("n", "k", Q.binomial_tail(F.col("n"), F.col("k"), share).alias("p"))
    a = Fraction(share)
    for r in df.collect():
        want = float(sum(comb(r.n, j) * a**j * (1 - a) ** (r.n - j) for j in range(r.k + 1)))
        assert r.p == (pytest.approx(want, rel=1e-9) if r.k <= r.n * share else 1.0)


def make_measured(spark, n_good, bad_hits, stratum="s"):
    cols = "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, " \
           "n_repeat_words long, base_failed boolean, good boolean"
    rows = [(i, stratum, 100, 500, 0, 10, 0, 0, False, True) for i in range(n_good)]
    rows += [(10_000 + i, stratum, 100, 500, 500, 10, 0, 0, False, False) for i in range(bad_hits)]
    return spark.createDataFrame(rows, cols)


def test_cutoffs_need_evidence(spark):
    few = Q.cutoffs(make_measured(spark, 100, 30)).where("chosen").collect()
    assert few == []                                    # 100 good documents prove nothing at 0.5 %
    many = {r.rule: r for r in Q.cutoffs(make_measured(spark, 2500, 30)).where("chosen").collect()}
    assert set(many) == {"symbols"} and many["symbols"].poor_rejected == 30 and many["symbols"].good_rejected == 0
    both = make_measured(spark, 2500, 30).unionAll(make_measured(spark, 60, 30, None))
    t = Q.cutoffs(both)
    assert {r.stratum for r in t.where("chosen").collect()} == {"s"}
    out = Q.judge(both.drop("good"), t).groupBy("stratum", "kept").count().collect()
    assert {(r.stratum, r.kept): r["count"] for r in out} == {("s", True): 2500, ("s", False): 30, (None, True): 90}


def test_certified_sequence_stops(spark):
    d = make_measured(spark, 2500, 30).withColumn("n_symbols", F.when((F.col("doc_id") < 200), 60).otherwise(F.col("n_symbols")))
    t = {r.cutoff: r for r in Q.cutoffs(d).where("rule = 'symbols'").collect()}
    assert t[0.15].certified and not t[0.1].certified and not t[0.05].certified     # 200 of 2500 good ones at 0.12


def test_labels(spark, make_docs):
    docs = make_docs([(i, "word " * 60 + str(i)) for i in range(5)])
    m = Q.measures(docs)
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, 1), (2, None), (None, 1), (77, 1)], "doc_id long, quality int")
    assert {r.doc_id: r.good for r in Q.with_labels(m, labels).collect()} == {0: False, 1: True}
    out = Q.quality_rules(docs.unionAll(docs), labels.limit(0))
    assert out.count() == 10 and out.where("kept <> (not base_failed)").count() == 0
