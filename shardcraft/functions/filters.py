"""Predicates (F2-F7).  All are Column expressions, so Catalyst pushes the
comparisons into the parquet scan (``PushedFilters``) and prunes columns."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def key_range(df: DataFrame, col, lo, hi) -> DataFrame:
    """inclusive ``BETWEEN lo AND hi``."""
    return df.where(_c(col).between(F.lit(lo), F.lit(hi)))


def as_of_lit(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        return F.lit(as_of).cast("timestamp_ntz")
    return F.lit(as_of).cast("date")


def date_band(df: DataFrame, col, as_of, from_days: int, to_days: int) -> DataFrame:
    """``col BETWEEN as_of - from_days AND as_of - to_days`` (inclusive)."""
    a = as_of_lit(as_of)
    return df.where(_c(col).between(F.date_sub(a, from_days), F.date_sub(a, to_days)))


def recent(df: DataFrame, col, as_of, interval: str) -> DataFrame:
    """rows with ``col >= as_of - INTERVAL <interval>``; ``interval`` like '90 days'."""
    return df.where(recent_cond(col, as_of, interval))


def recent_cond(col, as_of, interval: str) -> Column:
    return _c(col) >= as_of_lit(as_of) - F.expr(f"INTERVAL {interval}")


def like_ci(df: DataFrame, col, pattern: str) -> DataFrame:
    """case-insensitive LIKE (the reference's collation ignores case);
    ``_`` is a one-character wildcard, ``%`` any run."""
    return df.where(_c(col).ilike(pattern))


def mod_sample(df: DataFrame, col, k: int, r: int, signed: bool = True) -> DataFrame:
    """``col % k = r``.  ``signed`` keeps the SQL rule that the remainder
    has the sign of the dividend; ``signed=False`` uses the positive modulus."""
    m = (_c(col) % F.lit(k)) if signed else F.pmod(_c(col), F.lit(k))
    return df.where(m == F.lit(r))


def multi_filter(df: DataFrame, status_col, statuses, price_col, min_price,
                 date_col=None, as_of=None, interval: str | None = None) -> DataFrame:
    """IN-list AND price > x AND (optionally) a recent date."""
    cond = _c(status_col).isin(list(statuses)) & (_c(price_col) > F.lit(min_price))
    if date_col is not None:
        cond = cond & recent_cond(date_col, as_of, interval)
    return df.where(cond)
