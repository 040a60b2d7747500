import random
import re

from pyspark.sql import functions as F

from riskframe.llm import line_dedup as L
from tests.llm.oracle import same_as_oracle

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    return any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute(docs, low, near):
    """Numbers of the removed lines; docs sorted by id."""
    seen, out = [], {}
    for d, t in sorted(docs):
        gone = []
        for i, x in enumerate(t.split("\n") if t is not None else ()):
            w = WORD.findall(x)
            if len(w) >= low:
                if any(w == o or (len(w) >= near and len(o) >= near and one_edit(w, o)) for o in seen):
                    gone.append(i)
                seen.append(w)
        out[d] = gone
    return out


def check(spark, docs, df, low, near):
    want = brute(docs, low, near)
    text = dict(docs)
    rows = L.dedup_lines(df, low, near).select("doc_id", "text", "n_lines", "n_removed").collect()
    assert len(rows) == len(docs)
    for r in rows:
        lines = text[r.doc_id].split("\n") if text[r.doc_id] is not None else []
        assert (r.n_lines, r.n_removed) == (len(lines), len(want[r.doc_id])), r.doc_id
        kept = [x for i, x in enumerate(lines) if i not in want[r.doc_id]]
        assert r.text == (None if text[r.doc_id] is None else "\n".join(kept))
    return want


def test_random_lines_match_brute_force(spark, make_docs, with_clashes):
    rng = random.Random(3)
    lines = []
    for _ in range(60):
        lines.append([rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(1, 9))])
    for _ in range(240):
        x = list(rng.choice(lines))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            k = rng.randrange(len(x))
            x[k:k + 1] = rng.choice([["q"], [], [x[k], "r"], [x[k], x[k]]])
            x = x or ["z"]
        lines.append(x)
    rng.shuffle(lines)
    docs = []
    for i in range(60):
        own = [rng.choice([" ", "\t", "  "]).join(x) for x in lines[5 * i:5 * i + 5]] + rng.choice([[], ["", " \t"], ["\r"]])
        docs.append((i, "\n".join(own)))
    docs += [(100, None), (101, ""), (102, "\n\n")]
    want = check(spark, docs, with_clashes(make_docs(docs), "line_no", "k1", "row", "removed", "text_key"), 3, 4)
    assert sum(map(len, want.values())) > 50


def test_template_lines_and_long_lines(spark, make_docs):
    docs = [(i, f"this line is number {i} of a very long list\nown {i}") for i in range(300)]
    long = " ".join(f"w{k}" for k in range(5000))
    docs += [(400, long), (401, long + " more"), (402, long.replace("w2500 ", "x ")), (403, long.replace("w10 ", "y "))]
    want = check(spark, docs, make_docs(docs), 5, 8)
    assert sum(map(len, want.values())) == 299 + 3


def test_repeated_rows_nulls_and_empty(spark, make_docs):
    t = "one two three four five six seven eight\nother words stand here"
    rows = L.dedup_lines(make_docs([(4, t), (4, t), (None, t), (9, t)]), 5, 8).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in rows) == [
        (False, 4, 1), (False, 4, 1), (False, 9, 1), (True, 0, 0)]
    assert L.dedup_lines(make_docs([])).count() == 0


def test_one_edit_columns(spark):
    rng = random.Random(5)
    rows = [([rng.choice("ab") for _ in range(rng.randint(1, 5))], [rng.choice("ab") for _ in range(rng.randint(1, 5))])
            for _ in range(300)]
    got = spark.createDataFrame(rows, "a array<string>, b array<string>").select(
        "a", "b", L.one_edit(F.col("a"), F.col("b")).alias("x")).collect()
    assert all(r.x == one_edit(list(r.a), list(r.b)) for r in got)


def test_plan_is_native(spark, make_docs):
    plan = L.dedup_lines(make_docs(["a b c d e f g h i"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_oracle(spark):
    same_as_oracle(spark, "op2_line_dedup")


def test_short_lines_without_a_floor(spark, make_docs):
    docs = [(1, "Les.\nAll rights reserved.\na b\nx"), (2, "Les.\nAll  rights reserved.\na c\ny"),
            (3, "Les.\nAll rights kept\na\nb c d e f"), (4, "b c d e g\nx")]
    want = check(spark, docs, make_docs(docs), 1, 2)
    assert want == {1: [], 2: [0, 1, 2], 3: [0, 1], 4: [0, 1]}


def test_documents_are_never_joined_by_a_broadcast(spark, make_docs, monkeypatch):
    """op2's disk: what is joined to the documents grows with them, so small inputs take the same
    plan, and every step of the witnesses gives its shuffle files back."""
    from riskframe.llm import line_dedup as t
    freed = []
    monkeypatch.setattr(t, "discard", lambda s, *tables, f=t.discard: freed.append(len(tables)) or f(s, *tables))
    out = t.dedup_lines(make_docs([(1, "a b c d\nsame line here"), (2, "a b x d\nsame line here\nother"), (3, None)]))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" in plan
    assert {r.doc_id: r.n_removed for r in out.collect()} == {1: 0, 2: 2, 3: 0}
    assert freed.count(0) >= 6


def test_no_frame_over_what_follows_and_few_variants_go_on(spark, make_docs, monkeypatch):
    """op2's CPU: a sum over all later words, taken anew for each word, is quadratic in a line;
    variants that stand once are not joined again and again."""
    plans, rows = {}, {}

    def write(df, name, f=L.written):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString().lower()
        out = f(df, name)
        rows[name] = out.count()
        return out
    monkeypatch.setattr(L, "written", write)
    docs = [(i, " ".join(f"w{k}" for k in range(30)) + f" x{i}" + "".join(f" y{i}z{k}" for k in range(5 * (i % 3))))
            for i in range(40)]
    want = brute(docs, 1, 2)
    got = {r.doc_id: r.n_removed for r in L.dedup_lines(make_docs(docs)).collect()}
    assert got == {d: len(x) for d, x in want.items()} and sum(got.values()) == 13
    assert "unboundedfollowing" not in plans["line-variants"]
    # totals of a line are taken below the generator, once for each line
    assert plans["line-variants"].index("aggregate(") > plans["line-variants"].index("generate posexplode")
    assert rows["line-variants"] > 1000 and rows["line-alike"] < 50
