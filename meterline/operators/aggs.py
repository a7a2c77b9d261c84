"""Keyed selections as partial + final aggregates (no window over raw rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest_first(ts_ms: str = "ts_ms", tie: str = "message_id") -> Column:
    """Order key whose maximum is the newest row; the smallest id wins a tie."""
    return F.struct(F.col(ts_ms), (-F.col(tie)).alias("neg_id"))


def oldest_first(ts_ms: str = "ts_ms", tie: str = "message_id") -> Column:
    return F.struct(F.col(ts_ms), F.col(tie))


def latest_by(df: DataFrame, keys: list[str], value: Column, order: Column, out: str = "value") -> DataFrame:
    """The ``value`` with the greatest ``order`` per key."""
    return df.groupBy(*keys).agg(F.max_by(value, order).alias(out))


def first_matching_by(
    df: DataFrame, keys: list[str], value: Column, match: Column, order: Column, out: str = "value"
) -> DataFrame:
    """The ``value`` of the first matching row per key; NULL for a key without a match."""
    return df.groupBy(*keys).agg(F.min_by(value, F.when(match, order)).alias(out))


def upsert_latest(df: DataFrame, keys: list[str], order: str | Column) -> DataFrame:
    """One row per key, the one written last: what repeated keyed writes leave behind."""
    by = F.col(order) if isinstance(order, str) else order
    rest = [c for c in df.columns if c not in keys]
    kept = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_v"))
    return kept.select(*keys, "_v.*")


def last_value(df: DataFrame, value: str, order: str) -> DataFrame:
    """The single newest value of a table."""
    return df.agg(F.max_by(value, order).alias(value))


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()
