"""Spelling groups against all pairs of the vocabulary."""
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
from riskframe.llm import spelling as t


def brute_words(rows):
    c = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            c[run] += 1
    return {w: n for w, n in c.items() if len(w) >= 7 and n >= 2}


def brute_near(words):
    """Words that share a deletion variant (or are one) at the same place: one edit apart."""
    by = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            by[w[:i], w[i + 1:]].add(w)
    near = defaultdict(set)
    for group in by.values():
        for w in group:
            near[w] |= group - {w}
    for w in words:
        for i in range(len(w)):
            v = w[:i] + w[i + 1:]
            if v in words:
                near[w].add(v)
                near[v].add(w)
    return near


def brute(rows):
    n = brute_words(rows)
    near = brute_near(n)
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def rows_of(df):
    return [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]


def test_query_on_whole_table(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    got = rows_of(entry.queries()["op13_spelling"](spark, d))
    assert len(got) == len(set(got)) and set(got) == brute(rows)


@pytest.mark.parametrize("block", [20_000, 25, 3])
def test_chains_hot_halves_and_faults(spark, make_docs, with_clashes, block):
    rnd = random.Random(block)
    texts = []
    base = "abcdefghij"
    for k, w in enumerate([base, base[:-1], base[:-2], base[:-2] + "z"]):     # chains of forms
        texts += [(k, " ".join([w] * 12 ** (3 - k if k < 3 else 0) * 2))]
    for i in range(300):                                                     # a third share both halves
        w = "aaaaaaa" if i % 3 == 0 else "".join(rnd.choices("abÀÿ", k=7))
        w = list(w)
        w[rnd.randrange(7)] = rnd.choice("abcdefghÉ")
        texts.append((10 + i, f"{''.join(w)} {''.join(w)}{rnd.choice(['', 'a'])} {''.join(w).upper()}"))
    texts += [(None, "nullidword nullidword"), (5, None), (6, ""), (7, "short w\n\t" + "x" * 3000), (8, "x" * 3000),
              (9, "éàüöäßñ Éàüöäßñ éàüöäßñ Ÿbcdefgh"), (3, "abcdefghij"), (3, "abcdefghij")]
    got = rows_of(t.spelling_groups(with_clashes(make_docs(texts).repartition(4), "word", "n", "form", "role", "m"),
                                    block=block))
    want = brute(texts)
    assert len(got) == len(set(got)) and set(got) == want
    assert any(f is not None and f != r for _, f, r, *_ in want)             # a chain of two forms
    assert rows_of(t.spelling_groups(make_docs([]))) == []


def test_index_states_stay_in_step():
    """Both intervals of a state stand for the occurrences of its string."""
    rnd = random.Random(3)
    for _ in range(30):
        words = sorted({"".join(rnd.choices("abcd", k=rnd.randint(1, 6))) for _ in range(40)})
        ix = t.BiIndex(words)
        text = "\0" + "\0".join(words) + "\0"
        loop = text * 2
        for _ in range(20):
            s, state = "", ix.whole(1)
            for _ in range(rnd.randint(1, 5)):
                c = rnd.choice("abcd\0")
                right = rnd.random() < 0.5
                s = s + c if right else c + s
                state = ix.extend(state, ix.codes(np.array([ord(c)])), right)
                places = {p for p in range(len(text)) if loop.startswith(s, p)}
                assert int(state[2][0]) == len(places)
                if places:
                    lo = int(state[0][0])
                    assert set(ix.sa[lo:lo + len(places)].tolist()) == places
                else:
                    break


def test_search_against_all_pairs():
    rnd = random.Random(1)
    for _ in range(40):
        letters = "abc"[:rnd.randint(1, 3)]
        draw = lambda more, k: {"".join(rnd.choices(letters + more, k=rnd.randint(3, 7))) for _ in range(k)}
        words = sorted(draw("", 60))
        near = brute_near({*words})
        ix = t.BiIndex(words)
        for size in range(3, 8):
            qs = [w for w in words if len(w) == size]
            if not qs:
                continue
            codes = ix.codes(np.frombuffer("".join(qs).encode("utf-32-le"), "<u4")).reshape(len(qs), size)
            for longer in (False, True):
                half = (size + longer - 1) // 2
                got = set()
                for prefix in (True, False):
                    rows, found = t.search(ix, codes, longer, half, prefix)
                    one = [(qs[a], words[b]) for a, b in zip(rows, found)]
                    assert len(one) == len(set(one))
                    got |= set(one)
                assert got == {(w, v) for w in qs for v in near[w] if len(v) == size + longer}
