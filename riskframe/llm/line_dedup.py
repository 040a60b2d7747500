"""Line dedup by a deletion-neighbourhood join. DataFrame and SQL functions only.

A line is its words (runs of non-space). A line with a word (``min_words`` or more) is a
duplicate of an earlier line with the same words; lines of ``near_words`` or more also of
an earlier line within one word edit (a word put in, left out or replaced). The neighbourhood
of a line is the line with any one of its words deleted. Two lines are one edit apart if
and only if both give the same variant by deleting at the same place, or a variant of one
is the other. Variants are emitted as hashed keys; equal keys meet in aggregations that
keep the earliest line of each key (never pairs within a key), and the words of a line
and its witness are compared before the line goes. Lines are judged on the input: a line
goes if an earlier line is equal or one edit away, whether or not that one stays.

Only lines that can have a neighbour emit variants: one edit leaves the first or the last
half of a line as it was, so a line none of whose half keys occurs in another line has no
neighbour. A variant's key is a sum of (word, place) hashes, taken for all places of a
line at once from running sums, so long lines cost no more than their length.

Earliest means by (doc_id, hash of the text, line number). Defined cases: null and empty
texts have no lines to remove; lines with fewer words than ``min_words`` (empty ones too)
always stay; rows that share id and text are one document, kept or cut alike; null ids
come first; empty tables give empty results. Other columns pass through whatever their
names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, narrow, packed, text_key, written

WHITE = " \t\x0b\x0c\r\n"
POS = ("doc_id", "text_key", "line_no")
CLASS = ("k1", "k2")
OWN = ("c_id", "c_key", "c_line")          # a class by the place of its first line


def tidy(text: Column) -> Column:
    """A text with one space between the words of each line and none around a line. Most
    texts are so already; the others are mended whole, once, before they are cut."""
    odd = F.startswith(text, F.lit(" ")) | F.endswith(text, F.lit(" "))
    for c in ("  ", " \n", "\n ", "\t", "\x0b", "\x0c", "\r"):
        odd = odd | F.contains(text, F.lit(c))
    flat = F.regexp_replace(text, r"[ \t\x0B\x0C\r]+", " ")
    return F.when(odd, F.btrim(F.regexp_replace(flat, " ?\n ?", "\n"), F.lit(" "))).otherwise(text)


def _lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_key, line_no, line, n)`` of the lines that have words, tidy."""
    d = docs.select("doc_id", "text_key", F.posexplode(F.split(tidy(F.col("text")), "\n")).alias("line_no", "line"))
    d = d.where("line <> ''")
    return d.withColumn("n", F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit(""))) + 1)


def _keys(line: str = "line") -> list[Column]:
    return [F.xxhash64(line).alias("k1"), F.xxhash64(F.lit("second"), line).alias("k2")]


def _half_keys() -> Column:
    """First and last half of a line, cut as for itself (and lines as long) and as the longer
    of a pair."""
    n, line = F.col("n"), F.col("line")

    def pair(h):
        part = lambda k: F.call_function("substring_index", line, F.lit(" "), k)
        return F.array(F.xxhash64(F.lit("first"), h, part(h)), F.xxhash64(F.lit("last"), h, part(-h)))

    own, longer = F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")
    return F.when((own == longer) | (longer == 0), pair(own)).otherwise(F.concat(pair(own), pair(longer)))


def _place_hash(word: str, place: Column, seed: str) -> Column:
    """44 bits of a (word, place) pair: sums over any line stay within a long."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), word, place.cast("int")), 20)


def duplicate_lines(docs: DataFrame, min_words: int = 1, near_words: int = 2) -> DataFrame:
    """``(doc_id, text_key, removed)``: numbers of the lines to remove, documents without
    any left out. ``docs`` has doc_id, text and text_key."""
    if near_words < 2:
        raise ValueError("a line of one word is one edit from every other: near_words is at least 2")
    spark = docs.sparkSession
    pos = F.struct(*POS)
    first = [F.col(f"first.{p}").alias(o) for p, o in zip(POS, OWN)]
    found = _lines(docs)
    if min_words > 1:                     # a line that is left has a word
        found = found.where(F.col("n") >= min_words)
    lines = written(found.select(
        *POS, *_keys(), F.when(F.col("n") >= near_words, _half_keys()).alias("halves")), "lines")
    classes = written(lines.groupBy(*CLASS).agg(
        F.min(pos).alias("first"), F.count("*").alias("copies"),
        F.any_value("halves", ignoreNulls=True).alias("halves")).select(*CLASS, *first, "copies", "halves"),
        "line-classes")
    discard(spark)                        # after each step: what it shuffled is not needed again

    # classes that share a half with another class
    halves = classes.where(F.col("halves").isNotNull()).select(*OWN, F.explode("halves").alias("half"))
    # written (as other grouped sides of joins below): the join then has a plain exchange on
    # both sides, so that hot keys split; merged at every size, as they grow with the corpus
    shared = written(halves.groupBy("half").agg(F.count("*").alias("c")).where("c > 1").select("half"), "line-halves")
    discard(spark)
    near = written(halves.join(shared.hint("merge"), "half").select(*OWN).distinct(), "line-near")
    discard(spark, shared)

    # their words, from the documents that hold their first lines
    homes = written(near.select(F.col("c_id").alias("home_id"), F.col("c_key").alias("home_key")).distinct(), "line-homes")
    # homes grow with the corpus, as what is removed does: merged at every size, never broadcast
    at_home = docs.join(homes.hint("merge"), F.col("doc_id").eqNullSafe(F.col("home_id"))
                        & (F.col("text_key") == F.col("home_key")), "left_semi")
    own = _lines(at_home).where(F.col("n") >= near_words)
    words = written(own.join(near, _same(POS, OWN)).select(*OWN, F.split("line", " ").alias("words"), "n")
                    .dropDuplicates(list(OWN)), "line-words")          # rows may be repeated
    discard(spark, near, homes)

    witness = written(_witnesses(words), "line-witnesses")
    discard(spark, words)
    w = witness.select(*[F.col(o).alias(f"w_{o}") for o in OWN], F.lit(True).alias("is_near"))
    gone = written(classes.drop("halves").join(w.hint("merge"), _same(OWN, [f"w_{o}" for o in OWN]), "left")
                   .where("copies > 1 or is_near").select(*CLASS, *OWN, "is_near"), "line-gone")
    discard(spark, classes, witness)
    later = pos > F.struct(*[F.col(o).alias(p) for p, o in zip(POS, OWN)])
    hit = lines.drop("halves").join(gone, list(CLASS)).where(F.col("is_near") | later)
    out = written(hit.groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias("removed")), "line-removed")
    discard(spark, lines, gone)
    return out


def _same(a, b) -> Column:
    """Places are equal; document ids may be null."""
    return (F.col(a[1]) == F.col(b[1])) & (F.col(a[2]) == F.col(b[2])) & F.col(a[0]).eqNullSafe(F.col(b[0]))


def _witnesses(words: DataFrame) -> DataFrame:
    """Classes with a verified line one edit away that is earlier than their first."""
    spark = words.sparkSession
    v = ["vx", "vy"]
    zero = F.lit(0).cast("long")
    total = lambda seed, shift: F.aggregate(
        F.transform("words", lambda word, i: _place_hash(word, i + shift, seed)), zero, lambda a, h: a + h)
    whole = written(words.select(*OWN, "n", total("x", 0).alias("vx"), total("y", 0).alias("vy")), "line-wholes")
    # what follows a deleted word moves a place to the left: all places moved (a total of the
    # line), but those before it (a running sum) as they are. Every frame only grows: a sum
    # over what follows would be taken anew for each word
    # a select of its own: beside the generator the totals would be taken again for each word
    w = words.select(*OWN, "n", "words", *[total(s, -1).alias(f"t{s}") for s in ("x", "y")])
    w = w.select(*OWN, "n", "tx", "ty", F.posexplode("words").alias("i", "word"))
    here = {s: _place_hash("word", F.col("i"), s) for s in ("x", "y")}
    w = w.select(*OWN, "n", "i", *[c for s, h in here.items() for c in (
        (h - _place_hash("word", F.col("i") - 1, s)).alias(f"d{s}"), (F.col(f"t{s}") - h).alias(f"t{s}"))])
    upto = Window.partitionBy(*OWN).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    variants = written(w.select(*OWN, "n", "i", *[
        (F.sum(f"d{s}").over(upto) + F.col(f"t{s}")).alias(f"v{s}") for s in ("x", "y")]), "line-variants")
    discard(spark)                        # the shuffled words of every line, for one

    who = F.struct(*OWN)
    short = whole.select(*OWN, *v, (F.col("n") + 1).alias("n"))      # as variants of a line with a word more
    # only sums that stand twice can be neighbours; the other variants, mostly nearly all, go
    key = [*v, "n"]
    often = written(variants.select(*key).union(short.select(*key)).groupBy(*key).agg(F.count("*").alias("c"))
                    .where("c > 1").drop("c"), "line-often")
    discard(spark)
    alike = written(variants.join(often.hint("merge"), key), "line-alike")
    discard(spark, variants, often)
    # lines that became equal by deleting at the same place: one replaced word
    least = written(alike.groupBy(*key, "i").agg(F.min(who).alias("m"), F.count("*").alias("c")), "line-least")
    discard(spark)
    replaced = written(alike.join(least.where("c > 1").drop("c"), [*key, "i"])
                       .where(F.col("m") < who).select(*OWN, "m"), "line-found")
    discard(spark)
    # a variant of the longer line is the shorter one: one word more or less
    longer = written(alike.join(short.select(*key, who.alias("m")), key).where(F.col("m") < who).select(*OWN, "m"),
                     "line-found")
    discard(spark, alike)
    shorter = written(short.join(least.groupBy(*key).agg(F.min("m").alias("m")), key)
                      .where(F.col("m") < who).select(*OWN, "m"), "line-found")
    best = written(replaced.union(longer).union(shorter).groupBy(*OWN).agg(F.min("m").alias("m")), "line-best")
    discard(spark, least, whole, replaced, longer, shorter)

    # verify: the words of both, by their common start and end
    a = words.select(*[F.col(o).alias(f"a_{o}") for o in OWN], F.col("words").alias("a"))
    b = words.select(*[F.col(o).alias(f"b_{o}") for o in OWN], F.col("words").alias("b"))
    j = best.join(a, _same(OWN, [f"a_{o}" for o in OWN])).select(*OWN, *[F.col(f"m.{o}").alias(f"m_{o}") for o in OWN], "a")
    j = j.join(b, _same([f"m_{o}" for o in OWN], [f"b_{o}" for o in OWN]))
    return j.where(one_edit(F.col("a"), F.col("b"))).select(*OWN)


def one_edit(a: Column, b: Column) -> Column:
    """Whether two word arrays are at most one word edit apart: cut their common start off
    and compare what follows the first difference."""
    na, nb = F.size(a), F.size(b)
    pairs = F.transform(F.sequence(F.lit(0), F.least(na, nb)),
                        lambda i: F.when(F.get(a, i).eqNullSafe(F.get(b, i)) & (i < F.least(na, nb)), F.lit(None))
                        .otherwise(i))
    p = F.array_min(pairs)                                   # first place where they differ
    rest = lambda x, n, skip: F.slice(x, p + 1 + skip, F.greatest(n - p - skip, F.lit(0)))
    return ((na == nb) & (rest(a, na, 1) == rest(b, nb, 1))) | ((na == nb + 1) & (rest(a, na, 1) == rest(b, nb, 0))) \
        | ((nb == na + 1) & (rest(a, na, 0) == rest(b, nb, 1)))


def dedup_lines(docs: DataFrame, min_words: int = 1, near_words: int = 2, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``row`` (the input row), ``text`` (without its duplicate lines), ``n_lines`` (0 for
    null) and ``n_removed`` for every row of ``docs``."""
    thin = narrow(docs, id_col, text_col).withColumn("text_key", text_key(F.col("text")))
    gone = duplicate_lines(thin.where("text is not null"), min_words, near_words).select(
        F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"), "removed")
    # the text moves once, inside its row
    rows = packed(docs, id_col, text_col).select("row", "doc_id", text_key(F.col("text")).alias("text_key"))
    j = rows.join(gone.hint("merge"), F.col("doc_id").eqNullSafe(F.col("gone_id"))
                  & (F.col("text_key") == F.col("gone_key")), "left")
    j = j.withColumn("text", F.col(f"row.`{text_col}`").cast("string"))
    parts = F.split("text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("removed"))
    kept = F.when(F.col("removed").isNull(), F.col("text")).otherwise(
        F.array_join(F.get(F.transform(F.array(parts), lambda p: F.transform(stay, lambda i: F.get(p, i))), F.lit(0)),
                     "\n"))
    return j.select("row", "doc_id", kept.alias("text"),
                    F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).cast("long").alias("n_lines"),
                    F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"))
