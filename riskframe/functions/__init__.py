"""Column-expression helpers (all JVM-side, codegen friendly; no Python UDFs)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPS_RATE = 1e-9        # fixed value: added to every rate denominator
EPS_LOG = 1e-15        # fixed value: added inside both logs of the log loss


def col(c: str | Column) -> Column:
    return c if isinstance(c, Column) else F.col(f"`{c}`")


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def safe_ratio(num: Column, den: Column, eps: float = EPS_RATE) -> Column:
    """num / (den + eps), the smoothing used by every rate metric."""
    return num / (den + F.lit(eps))


def is_present(c: str, dtype: T.DataType | None = None) -> Column:
    """Not null, and not NaN for floating columns (so the filter pushes down as IsNotNull)."""
    e = col(c).isNotNull()
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        e = e & ~F.isnan(col(c))
    return e


def all_present(df, columns: Iterable[str]) -> Column:
    types = {f.name: f.dataType for f in df.schema.fields}
    cond = F.lit(True)
    for c in columns:
        cond = cond & is_present(c, types.get(c))
    return cond


BUCKETS = 1 << 28          # values of a row key's bucket


def hash_bucket(key_cols: Iterable[str | Column]) -> Column:
    """Deterministic 28-bit bucket of a row key: the first 7 hex digits of its md5.

    Independent of partitioning and of the engine (the same digits are
    reproducible in SQL), unlike a seeded random split.
    """
    key = F.concat_ws("|", *[col(c).cast("string") for c in key_cols])
    return F.conv(F.substring(F.md5(key), 1, 7), 16, 10).cast("bigint")


def quarter_index(ts: Column) -> Column:
    """year*4 + quarter - 1: consecutive quarters differ by exactly 1."""
    return (F.year(ts) * 4 + F.quarter(ts) - 1).cast("bigint")


def numeric_columns(df, exclude: Iterable[str] = (), exclude_suffix: str = "_idx") -> list[str]:
    """All numeric columns (any NumericType, bigint and decimal included)."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType)
            and f.name not in ex and not f.name.endswith(exclude_suffix)]
