"""Projection, null filtering, dedupe, name and type hygiene."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import all_present, col


def project_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Keep the wanted columns that exist, in the wanted order; skip the rest."""
    present = [c for c in wanted if c in df.columns]
    return df.select(*[col(c) for c in present])


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """P5: fail fast (before any job runs) when a required column is missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required column(s) {missing}; columns present: {df.columns}")
    return df


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop a row if any column of ``subset`` is null (or NaN for doubles).

    Written as explicit ``IS NOT NULL`` / ``NOT isnan`` predicates so the
    Parquet scan receives ``IsNotNull`` pushed filters.
    """
    subset = list(subset) if subset is not None else df.columns
    return df.where(all_present(df, subset))


def dedupe_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Exact duplicate removal. Planned as a two-phase aggregate, so hot
    duplicate groups collapse map-side before the shuffle."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def clean_data(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """P1 + P2 + P3: tolerant projection, null filter over the kept columns, dedupe."""
    projected = project_existing(df, keep)
    return dedupe_rows(drop_nulls(projected, projected.columns))


def clean_with_counts(df: DataFrame, keep: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """P1-P3 plus A1 from one aggregate: group the kept columns (map-side
    combine collapses duplicates), count rows per group.

    Returns (groups, counts): ``groups`` holds every distinct kept row with its
    multiplicity ``_n`` and a completeness flag ``_ok``; the cleaned table is
    ``groups.where("_ok").drop("_n", "_ok")`` (same rows as ``clean_data``).
    ``counts`` is one row: raw_rows, non_null_rows, clean_rows. Persist
    ``groups`` to compute both from a single pass over the source.
    """
    projected = project_existing(df, keep)
    g = projected.groupBy(*[col(c) for c in projected.columns]).agg(F.count(F.lit(1)).alias("_n"))
    g = g.withColumn("_ok", all_present(g, projected.columns))
    counts = g.agg(F.sum("_n").cast("bigint").alias("raw_rows"),
                   F.coalesce(F.sum(F.when(F.col("_ok"), F.col("_n"))), F.lit(0)).cast("bigint")
                   .alias("non_null_rows"),
                   F.count(F.when(F.col("_ok"), F.lit(1))).cast("bigint").alias("clean_rows"))
    return g, counts


def trim_names(df: DataFrame) -> DataFrame:
    """Strip outer whitespace from every column name (one projection)."""
    return df.toDF(*[c.strip() for c in df.columns])


def cast_int(df: DataFrame, c: str) -> DataFrame:
    """Integer cast that yields null for non-numeric text instead of failing under ANSI."""
    return df.withColumn(c, F.expr(f"try_cast(`{c}` as int)"))


def non_null(df: DataFrame, *columns: str) -> DataFrame:
    """P10: per-chart filter ``select(cols).dropna()``."""
    return drop_nulls(df.select(*[col(c) for c in columns]), list(columns))


def parse_timestamp(c: str, fmt: str | None = None):
    """String -> timestamp (no time zone). Bad strings become null, never an error.

    Parsed with ``try_to_timestamp`` in the session zone and cast to
    TIMESTAMP_NTZ, so the wall-clock value is independent of that zone.
    """
    args = f"`{c}`" if fmt is None else f"`{c}`, '{fmt}'"
    return F.expr(f"try_to_timestamp({args})").cast("timestamp_ntz")


def txn_clean(df: DataFrame, invoice: str, item: str, quantity: str, price: str,
              date: str, date_format: str | None = None,
              date_out: str = "invoice_ts") -> DataFrame:
    """D1 + D2: drop transactions missing any key field, with quantity <= 0 or
    price <= 0, or whose date does not parse."""
    parsed = df.withColumn(date_out, parse_timestamp(date, date_format)
                           if dict(df.dtypes)[date] == "string" else col(date).cast("timestamp_ntz"))
    keep = [invoice, item, quantity, price, date_out]
    return (parsed.where(all_present(parsed, keep)
                         & (col(quantity) > 0) & (col(price) > 0))
            .select(*[col(c) for c in [invoice, item, quantity, price, date_out]]))
