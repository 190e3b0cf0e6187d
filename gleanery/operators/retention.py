"""Time-to-live over a table of cache entries.

Entries have ``key``, ``length``, ``ts_ms`` and ``valid``; an unreadable entry has
``valid`` false.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FRESH, EXPIRED, INVALID = "fresh", "expired", "invalid"


def _ms(as_of_ms: int | Column) -> Column:
    return as_of_ms if isinstance(as_of_ms, Column) else F.lit(as_of_ms).cast("long")


def expired(as_of_ms: int | Column, ttl_ms: int, ts: str = "ts_ms") -> Column:
    """FLT-11: strictly older than the time to live."""
    return F.coalesce(_ms(as_of_ms) - F.col(ts) > ttl_ms, F.lit(False))


def ttl_partition(entries: DataFrame, as_of_ms: int | Column, ttl_ms: int) -> DataFrame:
    """TTL-1: add ``status``."""
    return entries.withColumn(
        "status",
        F.when(~F.col("valid"), INVALID).when(expired(as_of_ms, ttl_ms), EXPIRED).otherwise(FRESH),
    )


def retained(entries: DataFrame, as_of_ms: int | Column, ttl_ms: int) -> DataFrame:
    """TTL-1: what a cleanup leaves behind."""
    return ttl_partition(entries, as_of_ms, ttl_ms).filter(F.col("status") == FRESH).drop("status")


def cleanup_totals(entries: DataFrame, as_of_ms: int | Column, ttl_ms: int) -> DataFrame:
    """TTL-1: entries and bytes a cleanup removes; unreadable entries go too."""
    gone = F.col("status") != FRESH
    return ttl_partition(entries, as_of_ms, ttl_ms).agg(
        F.count_if(gone).alias("deleted_files"),
        F.coalesce(F.sum(F.when(gone, F.col("length"))), F.lit(0)).alias("freed_space"),
    )


def clear_totals(entries: DataFrame) -> DataFrame:
    """TTL-1: entries and bytes when everything is removed."""
    return entries.agg(
        F.count(F.lit(1)).alias("deleted_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("freed_space")
    )


def cache_stats(entries: DataFrame, as_of_ms: int | Column, ttl_ms: int) -> DataFrame:
    """AGG-11: unreadable entries count as expired but not as files."""
    valid = F.col("valid")
    return ttl_partition(entries, as_of_ms, ttl_ms).agg(
        F.count_if(valid).alias("total_files"),
        F.coalesce(F.sum(F.when(valid, F.col("length"))), F.lit(0)).alias("total_size"),
        F.least(F.coalesce(F.min(F.when(valid, F.col("ts_ms"))), _ms(as_of_ms)), _ms(as_of_ms)).alias("oldest_entry"),
        F.coalesce(F.max(F.when(valid, F.col("ts_ms"))), F.lit(0).cast("long")).alias("newest_entry"),
        F.count_if(F.col("status") != FRESH).alias("expired_files"),
    )


def latest_fresh(entries: DataFrame, keys: DataFrame, as_of_ms: int | Column, ttl_ms: int) -> DataFrame:
    """TTL-2: each requested key with its fresh entry, or nulls; ``found`` says which."""
    fresh = retained(entries, as_of_ms, ttl_ms)
    newest = fresh.groupBy("key").agg(
        F.max_by(F.struct(*[c for c in fresh.columns if c != "key"]), F.struct("ts_ms", "length")).alias("e")
    )
    return keys.select("key").join(newest, "key", "left").select(
        "key", F.col("e").isNotNull().alias("found"), "e.*"
    )
