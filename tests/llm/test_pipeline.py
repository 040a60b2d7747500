import re

import pytest

import corpus_pipeline
from riskframe.llm.common import written
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_jaccard import brute as components
from tests.llm.test_line_dedup import brute as duplicate_lines

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), name)
        out.append((name, docs))
    return {n: d for n, d in out}


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(steps):
    cols = steps["documents"].dtypes
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_jaccard", "decontamination",
                                                      "sentencepiece"]
    for n in ("language_id", "line_dedup", "ngram_jaccard", "decontamination"):
        assert steps[n].dtypes == cols
        assert steps[n].where("n_chars <> length(text)").count() == 0


def test_language_keeps_documents_with_words(steps):
    before, after = texts(steps["documents"]), texts(steps["language_id"])
    assert all(after[k] == before[k] for k in after)
    assert len(after) >= 0.98 * sum(bool(re.search(r"[^\W\d_]", t or "")) for t in before.values())


def test_line_dedup_takes_effect(steps):
    before, after = texts(steps["language_id"]), texts(steps["line_dedup"])
    gone = duplicate_lines(list(before.items()), 1, 8)
    for k, t in before.items():
        kept = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[k])
        assert after.get(k, "") == (kept if kept.strip(" \t\n\x0b\x0c\r") or not gone[k] else "")


def test_one_document_of_each_group(steps):
    before, after = texts(steps["line_dedup"]), texts(steps["ngram_jaccard"])
    assert sorted(after) == sorted({c for _, _, c in components(list(before.items()))})
    assert all(after[k] == before[k] for k in after)


def test_no_benchmark_passage_is_left(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = texts(steps["ngram_jaccard"]), texts(steps["decontamination"])
    was = contaminated(list(before.items()), items)
    for k, (n, hit, _) in was.items():
        assert (k in after) == (len(hit) <= 0.5 * n)
        if not hit:
            assert after[k] == before[k]
    assert any(h for _, h, _ in was.values())


def test_last_stage_and_run(spark, steps):
    from riskframe.llm.common import tokenizer_path
    from riskframe.llm.pieces import Vocabulary
    v = Vocabulary(tokenizer_path("piece_bpe_32k.model"))
    want = {k: v.encode(t)[0].tolist() for k, t in texts(steps["decontamination"]).items()}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: list(r.ids) for r in rows} == want and all(r.round_trip for r in rows)
    import __spark_entry__
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run


def test_stages_with_odd_rows(spark, make_docs, with_clashes):
    """Nulls, empty texts, repeats and clashing columns pass all stages."""
    text = "the words of this short document are all quite ordinary and there are ten of them or more\nsecond line"
    docs = make_docs([(1, text), (1, text), (2, None), (3, ""), (None, text + " x"), (5, "12 34"), (6, text + "\nthird line of it")])
    docs = with_clashes(docs.unionByName(spark.read.parquet(f"{SF}/documents.parquet").where("doc_id > 150")), "row", "tokens")
    cols = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), name)
        assert name == "sentencepiece" or docs.columns == cols
    ids = [r.doc_id for r in docs.collect()]
    assert 2 not in ids and 3 not in ids and 5 not in ids and 1 in ids
    empty = make_docs([])
    for name, stage in corpus_pipeline.STAGES:
        empty = written(stage(spark, empty, SF), name)
        assert empty.count() == 0
