"""The operators bound to the tables of a data directory: one query each, with the
production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark: SparkSession, d: str) -> DataFrame:
    """Suffix sums of the exact token-length histogram, over all documents and by language."""
    from . import token_counts as t
    docs = table(spark, d, "documents")
    # a row per language and length: written, as several aggregates read it
    hist = written(t.length_histogram(t.encoded_lengths(docs, stratum_col="lang")), "length-histogram")
    both = hist.select(F.concat(F.lit("lang:"), F.coalesce("stratum", F.lit("null"))).alias("stratum"),
                       "n_tokens", "n_docs").union(hist.select(F.lit("all").alias("stratum"), "n_tokens", "n_docs"))
    return t.suffix_sums(both.groupBy("stratum", "n_tokens").agg(F.sum("n_docs").alias("n_docs")))


@query
def op5_token_files(spark: SparkSession, d: str) -> DataFrame:
    """Every document's ids written to shard files and read back from them."""
    from . import token_files as t
    return t.read_shards(t.write_shards(table(spark, d, "documents"))).drop("shard")


@query
def op6_decontamination(spark: SparkSession, d: str) -> DataFrame:
    """Documents' words inside 10-word windows of benchmark items."""
    from . import decontaminate as t
    h = t.find_hits(table(spark, d, "documents"), table(spark, d, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"] + 1)
    return h.select("doc_id", "n_words", n_hit.alias("n_hit"),
                    F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                    (n_hit > 0).alias("contaminated"), "longest")


@query
def op9_language_id(spark: SparkSession, d: str) -> DataFrame:
    """Predicted language of every document; the held-out fold is never learnt from."""
    from . import langid as t
    docs = table(spark, d, "documents")
    model = t.fit(docs.where(~t.held_out()))
    return t.predict(docs, model).select("doc_id", t.held_out().alias("held_out"), "lang_pred", "score")


@query
def op3_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    """Base measures, base failures and the verdict of the risk-controlled cutoffs."""
    from . import quality as t
    return (t.quality_rules(table(spark, d, "documents"), table(spark, d, "labels"))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "failed_rules"))


@query
def op7_sentencepiece(spark: SparkSession, d: str) -> DataFrame:
    """Every document encoded and decoded: sizes, score, digests and the round trip."""
    from . import pieces as t
    from .common import text_key
    x = t.encode(table(spark, d, "documents"), decoded=True)
    return x.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "score", "n_chunks",
                    F.xxhash64("ids").alias("ids_hash"), F.sha2("text", 256).alias("decoded_sha256"),
                    (text_key(F.col("text")) == F.col("text_key")).alias("round_trip"))


@query
def op2_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Documents without lines that repeat an earlier line or are one word edit from one."""
    from . import line_dedup as t
    return t.dedup_lines(table(spark, d, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE["op2_line_dedup"] = r"""
WITH lines AS MATERIALIZED (
  SELECT doc_id, i - 1 AS line_no, l, list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l,
               unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
        FROM documents WHERE text IS NOT NULL)),
long AS (SELECT doc_id, line_no, w, len(w) AS n, row_number() OVER (ORDER BY doc_id, line_no) AS pos
         FROM lines WHERE len(w) >= 1),
cls AS MATERIALIZED (SELECT array_to_string(w, ' ') AS k, any_value(w) AS w, any_value(n) AS n, min(pos) AS pos
                     FROM long GROUP BY 1),
variants AS MATERIALIZED (
  SELECT k, n, pos, i, array_to_string(list_concat(w[1:i - 1], w[i + 1:]), ' ') AS v
  FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM cls WHERE n >= 2)),
near AS (
  SELECT k FROM variants JOIN (SELECT v, i, n, min(pos) AS m FROM variants GROUP BY v, i, n) USING (v, i, n) WHERE m < pos
  UNION SELECT x.k FROM variants x JOIN cls s ON x.v = s.k AND s.n >= 2 WHERE s.pos < x.pos
  UNION SELECT s.k FROM variants x JOIN cls s ON x.v = s.k AND s.n >= 2 WHERE x.pos < s.pos),
gone AS (
  SELECT doc_id, line_no FROM long JOIN cls ON array_to_string(long.w, ' ') = cls.k
  WHERE long.pos > cls.pos OR cls.k IN (SELECT k FROM near)),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.doc_id) AS n_removed,
         sha256(coalesce(string_agg(l.l, chr(10) ORDER BY l.line_no) FILTER (WHERE g.doc_id IS NULL), '')) AS kept_sha256
  FROM lines l LEFT JOIN gone g USING (doc_id, line_no) GROUP BY 1)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, kept_sha256
FROM (SELECT doc_id FROM documents) LEFT JOIN kept USING (doc_id)
"""


@query
def op4_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Documents without the 50-word runs that a document with a smaller id has."""
    from . import recompression as t
    return t.dedup_substrings(table(spark, d, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE["op4_substring_dedup"] = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
win AS MATERIALIZED (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
hit AS (SELECT doc_id, i FROM win JOIN (SELECT h, min(doc_id) AS a FROM win GROUP BY h) USING (h) WHERE a < doc_id),
gone AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 50)))) AS g FROM hit GROUP BY doc_id),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
gone_word AS (SELECT doc_id, unnest(g) AS i, true AS gone FROM gone),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(gone) AS n_removed,
         sha256(coalesce(string_agg(x, ' ' ORDER BY i) FILTER (WHERE gone IS NULL), '')) AS kept_sha256
  FROM word LEFT JOIN gone_word USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM (SELECT doc_id FROM documents) LEFT JOIN kept USING (doc_id)
"""


@query
def op10_suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Documents without the 400-byte runs that also occur anywhere else."""
    from . import suffix_family as t
    return t.dedup_bytes(table(spark, d, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_ngram_jaccard(spark: SparkSession, d: str) -> DataFrame:
    """Components of documents whose five-word shingle sets are at least 0.8 similar."""
    from . import jaccard as t
    return t.jaccard_components(table(spark, d, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op12_whitening(spark: SparkSession, d: str) -> DataFrame:
    """Every usable vector projected on the first four components, at unit variance."""
    from . import whitening as t
    vectors = t.gridded(table(spark, d, "embeddings"))
    return t.whiten(vectors, t.fit_whitening(vectors))


@query
def op11_packing(spark: SparkSession, d: str) -> DataFrame:
    """Every document's ids in sequences of at most 4,096 tokens."""
    from . import packing as t
    return t.pack(table(spark, d, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op13_spelling(spark: SparkSession, d: str) -> DataFrame:
    """Every word of the corpus with its form, its root and its number of near words."""
    from . import spelling as t
    return t.spelling_groups(table(spark, d, "documents"))
