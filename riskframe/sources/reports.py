"""Small result tables as single CSV files (S4) and their read-back.

Only report-sized tables (statistics, distributions, metrics) go through
here: one exchange brings a report to one task, so it is one file while what computes it
stays parallel. Tables of any size belong to ``files.write_table``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_report(df: DataFrame, path: str) -> str:
    """One CSV file (inside ``path``) with a header row, overwriting."""
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def read_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read a report back with its declared schema."""
    return spark.read.option("header", True).schema(schema).csv(path)
