"""Model persistence (S5, S6): the fitted pipeline plus a Parquet coefficient table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..operators.model import coefficient_table


def save_model(model: PipelineModel, features: Sequence[str], path: str) -> str:
    """``<path>/pipeline`` (MLlib format) and ``<path>/coefficients`` (Parquet)."""
    base = path.rstrip("/")
    model.write().overwrite().save(f"{base}/pipeline")
    coefficient_table(model, features).coalesce(1).write.mode("overwrite").parquet(
        f"{base}/coefficients")
    return base


def load_model(path: str) -> PipelineModel:
    """The fitted pipeline, for ``transform``."""
    return PipelineModel.load(f"{path.rstrip('/')}/pipeline")


def load_coefficients(spark: SparkSession, path: str) -> DataFrame:
    """The coefficient table, for explanation and ``score_batch``."""
    return spark.read.parquet(f"{path.rstrip('/')}/coefficients")
