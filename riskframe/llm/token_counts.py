"""Token counts: exact histogram of encoded document lengths and what it answers.

Documents are aggregated by (stratum, encoded length); every later question reads that
histogram, never the texts again. Suffix sums over it give, for every context limit L,
the documents and tokens beyond L and the tokens that remain when documents are cut at L.

Defined cases: a null or empty text has length 0; repeated rows count each time; a null
stratum is a stratum of its own; an empty table gives an empty histogram. Columns other
than the text and the stratum are ignored, whatever their names.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, tokenizer_path

#: lengths per bucket of the two-level suffix sums
BUCKET = 1024


def encoded_lengths(docs: DataFrame, vocabulary: str | None = None, text_col: str = "text",
                    stratum_col: str | None = None) -> DataFrame:
    """``(stratum, n_tokens)`` per row of ``docs``, encoded with a byte-level BPE file."""
    ship(docs.sparkSession)
    path = vocabulary or tokenizer_path("byte_bpe_50k.json")
    stratum = F.col(f"`{stratum_col}`").cast("string") if stratum_col else F.lit("all")
    schema = pa.schema([("stratum", pa.string()), ("n_tokens", pa.int64())])

    def count(batches):
        from .bpe_units import encoder
        enc = encoder(path)
        for b in batches:
            for lo, hi, lens, _ in enc.encode(b.column(1), ids=False):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(lens, pa.int64())], schema=schema)

    return (docs.select(stratum.alias("stratum"), F.col(f"`{text_col}`").cast("string").alias("text"))
            .mapInArrow(count, "stratum string, n_tokens long"))


def length_histogram(lengths: DataFrame) -> DataFrame:
    """``(stratum, n_tokens, n_docs)``; counted in each task before the shuffle."""
    return lengths.groupBy("stratum", "n_tokens").agg(F.count("*").alias("n_docs"))


def suffix_sums(hist: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """For every stratum and length L that occurs: ``n_docs`` and ``n_tokens_at`` of that
    length, documents and tokens of length >= L and > L, tokens left when every document
    is cut at L, tokens lost by that, and the share of documents that fit.

    Two levels: sums inside a bucket of lengths, plus the totals of the buckets above, so
    no task holds a whole stratum's lengths (only its buckets, one row per ``bucket``
    lengths).
    """
    h = hist.select("stratum", "n_tokens", "n_docs",
                    F.floor(F.col("n_tokens") / bucket).alias("_b"),
                    (F.col("n_tokens") * F.col("n_docs")).alias("n_tokens_at"))
    tops = h.groupBy("stratum", "_b").agg(F.sum("n_docs").alias("_d"), F.sum("n_tokens_at").alias("_t"))
    above = Window.partitionBy("stratum").orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("stratum")
    tops = tops.select("stratum", "_b", F.coalesce(F.sum("_d").over(above), F.lit(0)).alias("_da"),
                       F.coalesce(F.sum("_t").over(above), F.lit(0)).alias("_ta"),
                       F.sum("_d").over(whole).alias("stratum_docs"),
                       F.sum("_t").over(whole).alias("stratum_tokens"))
    t = tops.select(F.col("stratum").alias("_s"), F.col("_b").alias("_bb"), "_da", "_ta",
                    "stratum_docs", "stratum_tokens")
    down = Window.partitionBy("stratum", "_b").orderBy(F.desc("n_tokens"))
    j = h.join(t, F.col("stratum").eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_bb")))
    j = j.select("stratum", "n_tokens", "n_docs", "n_tokens_at", "stratum_docs", "stratum_tokens",
                 (F.sum("n_docs").over(down) + F.col("_da")).alias("docs_ge"),
                 (F.sum("n_tokens_at").over(down) + F.col("_ta")).alias("tokens_ge"))
    over_docs, over_tokens = F.col("docs_ge") - F.col("n_docs"), F.col("tokens_ge") - F.col("n_tokens_at")
    kept = F.col("stratum_tokens") - over_tokens + F.col("n_tokens") * over_docs
    return j.select("stratum", "n_tokens", "n_docs", "n_tokens_at", "docs_ge", "tokens_ge",
                    over_docs.alias("docs_over"), kept.alias("truncated_tokens"),
                    (F.col("stratum_tokens") - kept).alias("tokens_lost"),
                    "stratum_docs", "stratum_tokens",
                    ((F.col("stratum_docs") - over_docs) / F.col("stratum_docs")).alias("share_fit"))


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """Totals for any context limits, also lengths that do not occur: ``(stratum, limit,
    docs_fit, docs_over, truncated_tokens, tokens_lost)``."""
    n, d = F.col("n_tokens"), F.col("n_docs")
    lim = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])).alias("limit")
    h = hist.select("stratum", "n_tokens", "n_docs", lim)
    cut = F.least(n, F.col("limit"))
    return h.groupBy("stratum", "limit").agg(
        F.sum(F.when(n <= F.col("limit"), d).otherwise(0)).alias("docs_fit"),
        F.sum(F.when(n > F.col("limit"), d).otherwise(0)).alias("docs_over"),
        F.sum(cut * d).alias("truncated_tokens"), F.sum((n - cut) * d).alias("tokens_lost"))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """Smallest length that at least a share of the documents fit: ``(stratum, share,
    n_tokens)`` from :func:`suffix_sums`."""
    q = F.explode(F.array(*[F.lit(float(x)) for x in shares])).alias("share")
    s = sums.select("stratum", "n_tokens", "docs_over", "stratum_docs", q)
    fit = F.col("stratum_docs") - F.col("docs_over") >= F.ceil(F.col("share") * F.col("stratum_docs"))
    return s.where(fit).groupBy("stratum", "share").agg(F.min("n_tokens").alias("n_tokens"))
