"""Stages of the corpus pipeline: an operator's decisions applied to the documents.

Each takes ``(spark, docs, sf_dir)``; all but the last return the columns of ``docs``.
``n_chars``, where there is one, follows the text. Rows that share an id and a text share
every decision; null texts have no language and go in the first stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, packed, table, text_key, written

NEAR_WORDS = 8                  # in shorter lines one word's edit is another line, not a copy
MIN_SCORE = 0.5                 # a language is accepted if it is likelier than all others together


def _rows(df: DataFrame, columns: list[str], types: dict, text: Column | None = None) -> DataFrame:
    """The input's columns out of ``row``, with a new text (and its length)."""
    def col(c):
        if text is None or c not in ("text", "n_chars"):
            return F.col(f"row.`{c}`").alias(c)
        return (text if c == "text" else F.length(text)).cast(types[c]).alias(c)
    return df.select(*[col(c) for c in columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language (no letter), or whose best language is less
    likely than the others together."""
    from . import langid as t
    model = t.fit(docs.where(~t.held_out()))
    good = t.with_prediction(docs, model).where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE))
    return _rows(good, docs.columns, dict(docs.dtypes))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines that an earlier document has (or the same one, earlier), lines of at least
    ``NEAR_WORDS`` words also if they are one edit from one; a document that loses every line
    that had words goes."""
    from . import line_dedup as t
    discard(spark)                        # shuffle files of the stage before
    x = t.dedup_lines(docs, near_words=NEAR_WORDS)
    x = x.where((F.col("n_removed") == 0) | (F.btrim("text", F.lit(t.WHITE)) != ""))
    return _rows(x, docs.columns, dict(docs.dtypes), F.col("text"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component: the one with the smallest id (rows that share
    that id are one document)."""
    from . import jaccard as t
    discard(spark)
    c = t.jaccard_components(docs)
    keep = c.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("keep_id"), F.col("text_key").alias("keep_key"))
    keep = written(keep.distinct(), "jaccard-kept")
    j = packed(docs).join(keep, F.col("doc_id").eqNullSafe(F.col("keep_id"))
                          & (text_key(F.col("text")) == F.col("keep_key")), "left_semi")
    return _rows(j, docs.columns, dict(docs.dtypes))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out; drops documents that are mostly benchmark text."""
    from . import decontaminate as t
    discard(spark)
    out = t.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    if "n_chars" not in docs.columns:
        return out
    kind = dict(docs.dtypes)["n_chars"]
    return out.withColumn("n_chars", F.length("text").cast(kind))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as piece ids, with their score and whether they decode to their text."""
    from . import pieces as t
    discard(spark)
    x = t.encode(docs, decoded=True)
    return x.select("doc_id", F.size("ids").alias("n_pieces"), "ids", "score",
                    (text_key(F.col("text")) == F.col("text_key")).alias("round_trip"))
