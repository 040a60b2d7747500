"""A corpus pipeline of five operators, each stage written as Parquet and read again.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame: the documents it keeps, in the columns of ``documents``, but for the
last, which returns the encoded documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import stages
from riskframe.llm.common import table, written

STAGES = [
    ("language_id", stages.language_id),
    ("line_dedup", stages.line_dedup),
    ("ngram_jaccard", stages.ngram_jaccard),
    ("decontamination", stages.decontamination),
    ("sentencepiece", stages.sentencepiece),
]

#: The stages run Python (language scores, automaton, segmentation): SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
