"""Quality rules with risk-controlled cutoffs. DataFrame and SQL functions only.

Base measures and base failures come first. On top, each rule (a ratio that is high in
poor text) gets a cutoff per stratum. A grid of cutoffs, fixed beforehand, is tested on
labelled documents from the most lenient to the strictest: the exact binomial tail
P(Bin(n, a) <= k) is the p-value of "this cutoff rejects more than a share a of the good
documents", where k of n good labelled documents are rejected. A cutoff is certified
while all p-values up to it stay below delta / (strata x rules) (fixed sequence within a
rule, Bonferroni across rules and strata). Each rule may reject alpha / rules of the good
documents, so all rules together reject at most alpha of them in every stratum, with
probability 1 - delta. Among the certified cutoffs the one that rejects most poor
labelled documents, less ``cost`` times the good ones, is taken; without a certified
cutoff the rule rejects nothing in that stratum.

Equal three-word windows are found by 64-bit hashes within one document.

Defined cases: a null or empty text has no word (all counts 0) and fails the base rule;
a null stratum is a stratum; labels that are null are ignored, a document labelled twice
takes the lower label; without labels nothing but the base rule rejects; repeated rows
are judged one by one; empty tables give empty results. Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, written

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
RULES = {                                    # rule -> (numerator, denominator, cutoffs from lenient to strict)
    "symbols": ("n_symbols", "word_chars", (2.0, 1.0, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05)),
    "dup_lines": ("n_dup_lines", "n_lines", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3)),
    "repeats": ("n_repeat_words", "n_words", (0.45, 0.4, 0.35, 0.3, 0.25, 0.2)),
    "long_words": ("word_chars", "n_words", (40.0, 30.0, 25.0, 20.0, 16.0, 14.0, 12.0)),
}
ALPHA, DELTA, COST = 0.02, 0.05, 5.0


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once (a lambda variable)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def repeat_words(w: Column) -> Column:
    """Words inside three-word windows that occur twice or more in ``w``: windows sorted by
    hash, those with an equal neighbour kept, their places put in order again, and the
    words they cover counted."""
    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(
        F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))

    def places(s):
        same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        twice = F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    def covered(p):
        gaps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(
        let(F.sort_array(windows), lambda s: let(places(s), covered)))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             stratum_col: str | None = "lang") -> DataFrame:
    """``(doc_id, stratum, n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words, base_failed)`` per row, in one pass without a shuffle."""
    stratum = F.col(f"`{stratum_col}`").cast("string") if stratum_col else F.lit(None).cast("string")
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), stratum.alias("stratum"),
                    F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    t = F.col("text")
    solid = F.translate(t, WHITE, "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.translate(x, WHITE, "") != "")
    d = d.select(
        "doc_id", "stratum",
        F.char_length(solid).cast("long").alias("word_chars"),
        (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"),
                                      (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
            ).alias("l"),
        let(words(t), lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                         repeat_words(w).alias("n_repeat_words"))).alias("w"))
    d = d.select("doc_id", "stratum", "w.n_words", "word_chars", "n_symbols", "l.n_lines", "l.n_dup_lines",
                 "w.n_repeat_words")
    return d.withColumn("base_failed", (F.col("n_words") < 50)
                        | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def value(rule: str) -> Column:
    num, den, _ = RULES[rule]
    return F.coalesce(F.col(num) / F.nullif(F.col(den), F.lit(0)), F.lit(0.0))


def binomial_tail(n: Column, k: Column, share: float) -> Column:
    """P(Bin(n, share) <= k), exact; 1 where k is beyond the mean (no such cutoff can be
    certified, so its tail need not be summed). Terms by their ratio, in logarithms."""
    odds = F.log(F.lit(share / (1.0 - share)))
    first = n * F.log(F.lit(1.0 - share))

    def step(a, j):
        term = a["t"] + F.log((n - j + 1) / j) + odds
        top = F.greatest(a["s"], term)
        return F.struct(term.alias("t"), (top + F.log(F.exp(a["s"] - top) + F.exp(term - top))).alias("s"))

    total = F.aggregate(F.sequence(F.lit(1).cast("long"), k), F.struct(first.alias("t"), first.alias("s")),
                        step, lambda a: F.exp(a["s"]))
    return (F.when(k > n * share, F.lit(1.0)).when(k < 1, F.exp(first)).otherwise(total))


def cutoffs(labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA, cost: float = COST) -> DataFrame:
    """``(stratum, rule, cutoff, n_good, good_rejected, poor_rejected, p_value, certified,
    chosen)`` from measured documents with a ``good`` flag (base failures left out)."""
    grid = F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(i).alias("step"), F.lit(c).alias("cutoff"), (value(r) >= c).alias("hit"))
        for r, (_, _, cs) in RULES.items() for i, c in enumerate(cs)])).alias("g")
    one = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    t = (labelled.where("not base_failed").select("stratum", "good", grid)
         .groupBy("stratum", "g.rule", "g.step", "g.cutoff")
         .agg(one(F.col("good")).alias("n_good"), one(F.col("good") & F.col("g.hit")).alias("good_rejected"),
              one(~F.col("good") & F.col("g.hit")).alias("poor_rejected")))
    # a row per stratum, rule and cutoff: written, so that the strata can be counted first
    t = written(t, "cutoff-counts")
    tests = max(1, t.select(F.struct("stratum").alias("s")).agg(F.count_distinct("s")).first()[0]) * len(RULES)
    t = t.withColumn("p_value", binomial_tail(F.col("n_good"), F.col("good_rejected"), alpha / len(RULES)))
    down = Window.partitionBy("stratum", "rule").orderBy("step")
    t = t.withColumn("certified", F.max("p_value").over(down) <= delta / tests)
    gain = F.when(F.col("certified"), F.col("poor_rejected") - cost * F.col("good_rejected"))
    best = Window.partitionBy("stratum", "rule").orderBy(F.desc_nulls_last("gain"), "step")
    t = t.withColumn("gain", gain).withColumn("r", F.row_number().over(best))
    return t.select("stratum", "rule", "cutoff", "n_good", "good_rejected", "poor_rejected", "p_value",
                    "certified", ((F.col("r") == 1) & F.coalesce(F.col("gain") > 0, F.lit(False))).alias("chosen"))


def with_labels(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                label_col: str = "quality") -> DataFrame:
    """Measured documents that have a label, with ``good`` (label above 0)."""
    lab = (labels.select(F.col(f"`{id_col}`").cast("long").alias("label_id"), F.col(f"`{label_col}`").alias("q"))
           .where("q is not null and label_id is not null").groupBy("label_id").agg((F.min("q") > 0).alias("good")))
    return measured.join(lab, F.col("doc_id") == F.col("label_id")).drop("label_id")


def judge(measured: DataFrame, table: DataFrame) -> DataFrame:
    """Adds ``kept`` (and the rules that reject, ``failed_rules``) by the chosen cutoffs.

    The cutoffs are written first (a row per stratum), so the planner knows their size: it
    broadcasts them if they are small and splits hot strata if they are not."""
    wide = table.where("chosen").groupBy(F.col("stratum").alias("cut_stratum")).agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES])
    wide = written(wide, "cutoffs")
    j = measured.join(wide, F.col("stratum").eqNullSafe(F.col("cut_stratum")), "left")
    hit = lambda r: F.coalesce(value(r) >= F.col(f"cut_{r}"), F.lit(False))
    failed = F.filter(F.array(*[F.when(hit(r), F.lit(r)) for r in RULES]), lambda x: x.isNotNull())
    return (j.select(*measured.columns, F.concat_ws(",", failed).alias("failed_rules"))
            .withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == "")))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  stratum_col: str | None = "lang", alpha: float = ALPHA, delta: float = DELTA,
                  cost: float = COST) -> DataFrame:
    """Measures, base failures and the verdict for every row. The texts are read once: their
    measures are written (a few numbers a row) and used for cutoffs and verdicts."""
    m = written(measures(docs, id_col, text_col, stratum_col), "quality-measures")
    return judge(m, cutoffs(with_labels(m, labels), alpha, delta, cost))
