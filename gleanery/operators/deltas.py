"""Keyed tables as a base and the changes since: what a run changed, and the table that both make."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PUT, DROP = "put", "drop"


def changes(before: DataFrame, after: DataFrame, key: str = "id") -> DataFrame:
    """The rows of ``after`` that are new or differ (``op`` put) and the keys that are gone (``op`` drop, other columns null).

    Keys are unique and not null on both sides; nulls are equal to nulls.
    """
    columns = after.columns
    old = before.select(F.col(key).alias("_old_key"), F.struct(*columns).alias("_old"))
    new = after.select(F.col(key).alias("_new_key"), F.struct(*columns).alias("_new"))
    both = new.join(old, F.col("_new_key") == F.col("_old_key"), "full_outer").where(~F.col("_new").eqNullSafe(F.col("_old")))
    gone = F.col("_new_key").isNull()
    kept = [F.when(gone, F.col("_old_key")).otherwise(F.col(f"_new.{c}")).alias(c) if c == key else F.col(f"_new.{c}").alias(c) for c in columns]
    return both.select(F.when(gone, DROP).otherwise(PUT).alias("op"), *kept)


def merged(base: DataFrame, later: DataFrame, key: str = "id", number: str = "number") -> DataFrame:
    """``base`` after all changes in ``later``, of which the one with the highest ``number`` holds for each key.

    Base rows are only tested against the changed keys, so they are not sorted and not shuffled where the changes are few.
    """
    order = Window.partitionBy(key).orderBy(F.desc(number))
    last = later.withColumn("_place", F.row_number().over(order)).where("_place = 1")
    columns = base.columns
    kept = base.join(last.select(key), key, "left_anti").select(*columns)
    return kept.unionByName(last.where(F.col("op") == PUT).select(*columns))
