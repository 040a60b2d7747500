"""Rounding contract shared by the registered queries and their SQL oracles.

Both engines round computed doubles with the same IEEE steps,
floor(x * 10^k + 0.5) / 10^k, which give identical bits for identical
inputs:

* ``sig`` / ``sql_sig`` / ``sig_py``: 12 significant digits (raw-scale values);
* ``unit`` / ``sql_unit``: 9 decimals (dimensionless O(1) values, whose
  cross-engine error is absolute, ~1e-13).

String formatting or ``round`` would not do: the JVM rounds the shortest
decimal string half-up, DuckDB the exact binary value, and the two differ for
about 1e-4 of all doubles.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIG_DIGITS = 12
UNIT_DECIMALS = 9


def _half_up(c, k):
    """floor(c * 10^k + 0.5) / 10^k with exact powers of ten (k may be negative)."""
    pos = F.floor(c * F.pow(F.lit(10.0), k) + F.lit(0.5)) / F.pow(F.lit(10.0), k)
    neg = F.floor(c / F.pow(F.lit(10.0), -k) + F.lit(0.5)) * F.pow(F.lit(10.0), -k)
    return F.when(k >= 0, pos).otherwise(neg)


def sig(c):
    """Round a double column to 12 significant digits."""
    c = c.cast("double")
    k = (F.lit(SIG_DIGITS - 1) - F.floor(F.log10(F.abs(c)))).cast("int")
    special = c.isNull() | F.isnan(c) | (c == 0) | (F.abs(c) == float("inf"))
    return F.when(special, c).otherwise(_half_up(c, k))


def unit(c, decimals: int = UNIT_DECIMALS):
    """Round a dimensionless O(1) double column to ``decimals`` places."""
    c = c.cast("double")
    return F.floor(c * F.lit(10.0 ** decimals) + F.lit(0.5)) / F.lit(10.0 ** decimals)


def rounded(df: DataFrame) -> DataFrame:
    """Round every floating column (top level) to 12 significant digits."""
    return df.select(*[
        sig(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def unit_round(df: DataFrame, cols) -> DataFrame:
    """Round the named dimensionless columns to 9 decimals."""
    return df.select(*[unit(F.col(f"`{c}`")).alias(c) if c in cols
                       else F.col(f"`{c}`") for c in df.columns])


def sql_unit(e: str) -> str:
    """SQL twin of ``unit``."""
    return f"(floor(CAST({e} AS DOUBLE) * {10.0 ** UNIT_DECIMALS!r} + 0.5) / {10.0 ** UNIT_DECIMALS!r})"


def sql_sig(e: str) -> str:
    """SQL twin of ``sig``."""
    x = f"CAST({e} AS DOUBLE)"
    k = f"CAST({SIG_DIGITS - 1} - floor(log10(abs({x}))) AS INTEGER)"
    return (f"(CASE WHEN {x} IS NULL OR isnan({x}) OR isinf({x}) OR {x} = 0 THEN {x} "
            f"WHEN {k} >= 0 THEN floor({x} * pow(10.0, {k}) + 0.5) / pow(10.0, {k}) "
            f"ELSE floor({x} / pow(10.0, -{k}) + 0.5) * pow(10.0, -{k}) END)")


def sig_py(v: float | None) -> float | None:
    """Driver-side twin of ``sig`` (same IEEE steps), for fitted statistics."""
    if v is None or v == 0 or math.isnan(v) or math.isinf(v):
        return v
    k = SIG_DIGITS - 1 - math.floor(math.log10(abs(v)))
    if k >= 0:
        return math.floor(v * 10.0 ** k + 0.5) / 10.0 ** k
    return math.floor(v / 10.0 ** -k + 0.5) * 10.0 ** -k
