import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskframe.llm import pfor, token_counts, token_files
from riskframe.llm.bpe_units import UnitEncoder
from riskframe.llm.common import tokenizer_path
from riskframe.llm.queries import QUERIES

PATH = tokenizer_path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def ids_of(tok, texts):
    return [e.ids for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def unit_ids(enc, texts):
    out = []
    for _, _, lens, ids in enc.encode(pa.array(texts, pa.string())):
        out += [x.tolist() for x in np.split(ids, np.cumsum(lens)[:-1])]
    return out


def test_units_equal_the_library(tok):
    rng = random.Random(1)
    al = [" ", " ", "\n", "a", "é", "1", ".", "'s", "\t", "　", "\x1c", "\x85", "<|endoftext|>", "中", "​", "²", " ",
          "  ", "\0", "a.", "b,", "\r\n", "word"]
    texts = ["".join(rng.choice(al) for _ in range(rng.randint(0, 30))) for _ in range(4000)] + [None, ""]
    assert unit_ids(UnitEncoder(PATH), texts) == ids_of(tok, texts)


def test_a_full_memo_forgets_and_goes_on(tok):
    texts = [f"some w{i} words, and x{i}y." for i in range(300)]
    enc = UnitEncoder(PATH, max_units=50)
    for i in range(0, 300, 10):
        assert unit_ids(enc, texts[i:i + 10]) == ids_of(tok, texts[i:i + 10])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 60), max_size=700), st.sampled_from([8, 64, 256]),
       st.sampled_from([0.5, 0.9, 1.0]))
def test_pack_unpack(values, block, cover):
    ids = np.array(values, dtype=np.uint32)
    low, width, words, at, val = pfor.pack(ids, block, cover)
    assert (pfor.unpack(len(ids), low, width, words, at, val, block) == ids).all()


def test_shard_random_access():
    rng = np.random.default_rng(4)
    out = io.BytesIO()
    w = pfor.Writer(out, segment=1024)
    every, docs = [], []
    for i in range(60):
        lens = rng.integers(0, 300, 5)
        ids = np.where(rng.random(lens.sum()) < .05, rng.integers(0, 2**31, lens.sum()), rng.integers(0, 900, lens.sum()))
        w.add([None if i == 3 else 5 * i + k for k in range(5)], lens, ids.astype(np.uint32))
        every.append(ids)
        docs += lens.tolist()
    every = np.concatenate(every)
    assert w.close() == (300, len(every))
    r = pfor.Reader(out)
    assert r.lens.tolist() == docs and r.doc_null.sum() == 5 and r.n_ids == len(every)
    assert (np.concatenate([r.segment(s) for s in range(len(r.segs))]) == every).all()
    for _ in range(200):
        a = int(rng.integers(0, len(every)))
        n = int(rng.integers(0, 3000))
        assert (r.read(a, n) == every[a:a + n]).all()
    assert out.tell() and len(out.getvalue()) < 4 * len(every)
    with pytest.raises(ValueError):
        pfor.Reader(io.BytesIO(out.getvalue()[:-4]))


def want_files(tok, docs):
    out, start = {}, 0
    for d, t in sorted(docs):
        ids = ids_of(tok, [t])[0] + [2]
        out[d] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


def test_op5_whole_table(spark, tok):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op5_token_files"](spark, SF).collect()}
    assert got == want_files(tok, docs)


def test_files_edge_cases(spark, make_docs, with_clashes, tok):
    long = "very long text, " * 30_000                      # spans several segments
    docs = [(5, "b c"), (2, None), (9, ""), (1, long), (7, "x")]
    m = token_files.write_shards(with_clashes(make_docs(docs), "shard", "path"), shards=3)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_shards(m).collect()}
    assert got == want_files(tok, [(d, t or "") for d, t in docs])
    assert token_files.read_shards(token_files.write_shards(make_docs([]))).count() == 0
    twice = token_files.read_shards(token_files.write_shards(make_docs([(1, "a"), (1, "a"), (None, "b")]))).collect()
    assert sorted((r.start, r.n_tokens, r.doc_id is None) for r in twice) == [(0, 2, True), (2, 2, False), (4, 2, False)]


def test_op1_whole_table(spark, tok):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").collect()
    lens = [(r.lang, len(x)) for r, x in zip(docs, ids_of(tok, [r.text for r in docs]))]
    rows = QUERIES["op1_token_counts"](spark, SF).collect()
    strata = {"all": [n for _, n in lens], **{f"lang:{k}": [n for g, n in lens if g == k] for k in {g for g, _ in lens}}}
    assert {(r.stratum, r.n_tokens) for r in rows} == {(k, n) for k, v in strata.items() for n in v}
    for r in rows:
        v, L = strata[r.stratum], r.n_tokens
        assert r.n_docs == v.count(L) and r.docs_ge == sum(n >= L for n in v) and r.docs_over == sum(n > L for n in v)
        assert r.tokens_ge == sum(n for n in v if n >= L) and r.truncated_tokens == sum(min(n, L) for n in v)
        assert r.tokens_lost == sum(v) - r.truncated_tokens and r.stratum_docs == len(v)
        assert r.share_fit == sum(n <= L for n in v) / len(v)


def test_counts_edge_cases(spark, make_docs, with_clashes):
    docs = with_clashes(make_docs([(1, None), (1, None), (2, ""), (3, "one two three")], ["en", "en", None, None]), "stratum",
                        "n_tokens")
    h = token_counts.length_histogram(token_counts.encoded_lengths(docs, stratum_col="lang"))
    assert sorted((r.stratum or "", r.n_tokens, r.n_docs) for r in h.collect()) == [("", 0, 1), ("", 3, 1), ("en", 0, 2)]
    sums = token_counts.suffix_sums(h, bucket=2)
    got = {(r.stratum, r.n_tokens): (r.docs_ge, r.truncated_tokens, r.tokens_lost) for r in sums.collect()}
    assert got == {(None, 0): (2, 0, 3), (None, 3): (1, 3, 0), ("en", 0): (2, 0, 0)}
    at = {(r.stratum, r.limit): (r.docs_fit, r.docs_over, r.truncated_tokens, r.tokens_lost)
          for r in token_counts.at_limits(h, [2, 10]).collect()}
    assert at[(None, 2)] == (1, 1, 2, 1) and at[("en", 10)] == (2, 0, 0, 0)
    q = {(r.stratum, r.share): r.n_tokens for r in token_counts.quantiles(sums, [0.5, 1.0]).collect()}
    assert q == {(None, 0.5): 0, (None, 1.0): 3, ("en", 0.5): 0, ("en", 1.0): 0}
    empty = token_counts.length_histogram(token_counts.encoded_lengths(make_docs([])))
    assert token_counts.suffix_sums(empty).count() == 0


def test_new_first_words_are_encoded_together_and_as_by_the_library():
    """op5's CPU seconds: a call for every text's first word, a second lookup of every word."""
    import pyarrow as pa
    import public_tokenizers
    from riskframe.llm.bpe_units import UnitEncoder
    e = UnitEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [f"first{k} word{k % 7}. x{k % 3}, é. end\nline{k}, ." for k in range(500)] + ["", None, "one", " two  three "]
    tok, calls = e.tok, []

    class Counted:
        def encode_batch_fast(self, batch, **more):
            calls.append(len(batch))
            return tok.encode_batch_fast(batch, **more)

    e.tok = Counted()
    (_, _, lens, ids), = e.encode(pa.array(texts, pa.string()))
    want = [x.ids for x in tok.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
    assert lens.tolist() == [len(x) for x in want] and ids.tolist() == [k for x in want for k in x]
    assert len(calls) < 20, len(calls)
