"""Ranking and picking that stays safe when one group holds most of the rows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

SMALL_TABLE_ROWS = 100_000


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """One row per key.  Spark keeps one row per key and map task before the
    shuffle (WindowGroupLimit), so a hot key sends a handful of rows."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def top_k_per_key(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], k: int, rank_col: str = "rank"
) -> DataFrame:
    """The first ``k`` rows per key, numbered; pruned before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the session: the checkpoint folder, or else the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (configured or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared scratch folder and read them back.

    Cuts the lineage and, unlike ``checkpoint()``, keeps column pruning for the
    readers that follow.  Everything one application writes is under one folder,
    which can go when the application has ended.
    """
    spark = df.sparkSession
    application = spark.sparkContext.applicationId
    path = f"{scratch_root(spark)}/gleanery-{application}/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame, **conditions: Column) -> tuple[DataFrame, dict[str, int]]:
    """The same, with the number of rows that meet each condition, counted as they are written and not by another scan."""
    seen = Observation()
    kept = materialize(df.observe(seen, *[F.count_if(c).alias(name) for name, c in conditions.items()]))
    counted = seen.get
    return kept, {name: counted.get(name, 0) for name in conditions}


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank_col: str = "rank", id: str = "id"
) -> DataFrame:
    """Number all rows of each key from 1, for few and possibly huge groups.

    A window would put a whole group into one task.  Here ids and keys alone are range
    partitioned over key and order and numbered where they are; the sizes of the slices in front
    are added, and the rank is joined back by ``id``, which is unique and not null.  So the
    whole rows move once, and none of them is written.  ``order`` must be total per key.
    """
    key_cols = [F.col(k) for k in keys]
    placed = materialize(
        df.repartitionByRange(*key_cols, *order)
        .sortWithinPartitions(*key_cols, *order)
        .select(F.col(id).alias("_id"), *key_cols, F.monotonically_increasing_id().alias("_slot"))
    ).withColumn("_slice", F.shiftright("_slot", 33))

    slices = placed.groupBy(*keys, "_slice").agg(
        F.count(F.lit(1)).alias("_size"), F.min("_slot").alias("_first")
    )
    ahead = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col("_slice").alias("_key_slice"),
        "_first",
        F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_ahead"),
    )
    # At most one row per slice plus one per key; shipped whole only if that is few.
    if offsets.limit(SMALL_TABLE_ROWS + 1).count() <= SMALL_TABLE_ROWS:
        offsets = F.broadcast(offsets)
    same = [placed[k].eqNullSafe(offsets[f"_key_{k}"]) for k in keys]
    ranks = placed.join(offsets, [*same, placed["_slice"] == offsets["_key_slice"]]).select(
        "_id", (F.col("_slot") - F.col("_first") + F.col("_ahead") + 1).alias("_rank")
    )
    return df.join(ranks, F.col(id) == F.col("_id")).select(*df.columns, F.col("_rank").alias(rank_col))
