"""Duplicate detection and field-wise survivorship.

In a group the rows rank by stars, highest first, then by the tie-breaker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.columns import has_text
from gleanery.functions.ranking import SMALL_TABLE_ROWS, first_per_key, materialize

REPO_REASON = "Multiple entries for repository: "
URL_REASON = "Multiple entries with same URL: "
# Rows of one group that one task joins, about.
HEAVY_GROUP = 100_000


def repo_key() -> Column:
    return F.lower("repo")


def url_key() -> Column:
    return F.lower("url")


def dedup_primary(items: DataFrame, key: Column, *, tie: str = "id") -> DataFrame:
    """WIN-5 / DUP-1 / DUP-2: the best row of each key."""
    keyed = items.withColumn("_key", key)
    return first_per_key(keyed, ["_key"], [F.desc("stars"), F.asc(tie)]).drop("_key")


def dedup_groups(items: DataFrame, key: Column, *, reason: str, tie: str = "id") -> DataFrame:
    """AGG-8: one row per key that occurs more than once."""
    rank = F.struct(-F.col("stars"), F.col(tie))
    return (
        items.groupBy(key.alias("group_key"))
        .agg(F.min_by(F.col("id"), rank).alias("primary_id"), (F.count(F.lit(1)) - 1).alias("duplicates"))
        .filter("duplicates > 0")
        .withColumn("reason", F.concat(F.lit(reason), F.col("group_key")))
    )


def dedup_members(items: DataFrame, key: Column, *, reason: str, tie: str = "id", heavy: int = HEAVY_GROUP) -> DataFrame:
    """AGG-8, long form: one row per duplicate, so no group is held as an array.

    A group of more than ``heavy`` rows is dealt to parts of about that size: its row is repeated once for each part,
    and its members go to the part that their id gives. Other groups have one part and are not repeated.
    """
    groups = dedup_groups(items, key, reason=reason, tie=tie)
    parts = F.ceil((F.col("duplicates") + 1) / heavy)
    spread = materialize(groups.select("group_key", "primary_id", "reason", parts.alias("_parts")))
    split = spread.where("_parts > 1").select(F.col("group_key").alias("_heavy"), F.col("_parts").alias("_of"))
    # At most one heavy group per ``heavy`` rows; sent whole only if they are few.
    if split.limit(SMALL_TABLE_ROWS + 1).count() <= SMALL_TABLE_ROWS:
        split = F.broadcast(split)
    members = items.select(key.alias("group_key"), F.col("id").alias("duplicate_id"))
    dealt = members.join(split, F.col("group_key") == F.col("_heavy"), "left").select(
        "group_key", "duplicate_id", F.pmod(F.xxhash64("duplicate_id"), F.coalesce("_of", F.lit(1))).alias("_part")
    )
    each = spread.select("group_key", "primary_id", "reason", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)).alias("_part"))
    return (
        dealt.join(each, ["group_key", "_part"])
        .filter(F.col("duplicate_id") != F.col("primary_id"))
        .select("group_key", "duplicate_id", "primary_id", "reason")
    )


def detect_duplicates(items: DataFrame, *, tie: str = "id") -> DataFrame:
    """DUP-1 + DUP-2: duplicates by repository, then by URL among the winners."""
    by_repo = dedup_members(items, repo_key(), reason=REPO_REASON, tie=tie)
    winners = dedup_primary(items, repo_key(), tie=tie)
    return by_repo.unionByName(dedup_members(winners, url_key(), reason=URL_REASON, tie=tie))


def group_notes(items: DataFrame, key: Column, *, tie: str = "id") -> DataFrame:
    """All notes with their group and rank, whole, one per row."""
    return items.filter(has_text("notes")).select(
        key.alias("group_key"), F.struct((-F.col("stars")).alias("s"), F.col(tie).alias("t")).alias("rank"), "notes"
    )


def merge_duplicates(items: DataFrame, key: Column, *, tie: str = "id") -> DataFrame:
    """DUP-3 / AGG-9: one merged row per key.

    Scalars are picked by ordered aggregates, which combine before the shuffle.
    Tags and topics are exploded and reduced to their distinct values first, so a
    hot key never becomes one array of rows; no join meets the rows of a key.
    All notes of a group are joined, as the merged cell asks for; ``group_notes``
    has them one per row.
    """
    columns = items.columns
    keyed = items.withColumn("_key", key).withColumn(
        "_rank", F.struct((-F.col("stars")).alias("s"), F.col(tie).alias("t"))
    )

    def first(column: str, where: Column, rank: Column) -> Column:
        return F.min_by(F.when(where, F.col(column)), F.when(where, rank))

    rank, noted = F.col("_rank"), has_text("notes")
    groups = keyed.groupBy("_key").agg(
        F.count(F.lit(1)).alias("_n"),
        F.collect_list(F.when(noted, F.struct(rank.alias("r"), F.col("notes").alias("v")))).alias("_notes"),
        F.min_by(F.struct(*columns), rank).alias("_p"),
        F.max("stars").alias("_stars"),
        F.max("pushed_at").alias("_pushed_at"),
        first("description", has_text("description"), F.struct(-F.length("description"), rank)).alias("_description"),
        F.min_by(F.struct("score", "confidence"), F.struct(-F.col("score"), rank)).alias("_scored"),
        first("license", has_text("license"), rank).alias("_license"),
    )
    full = groups.join(_merged_lists(keyed), "_key", "left")

    many = F.col("_n") > 1
    empty = F.array().cast("array<string>")
    merged = {
        "stars": F.col("_stars"),
        "pushed_at": F.col("_pushed_at"),
        "description": F.coalesce("_description", "_p.description"),
        "score": F.col("_scored.score"),
        "confidence": F.col("_scored.confidence"),
        "license": F.coalesce("_license", "_p.license"),
        "notes": F.when(many & (F.size("_notes") > 0), F.array_join(F.transform(F.array_sort("_notes"), lambda n: n["v"]), "; ")).otherwise(F.col("_p.notes")),
        "tags": F.when(many, F.coalesce("_tags", empty)).otherwise(F.col("_p.tags")),
        "topics": F.when(many, F.coalesce("_topics", empty)).otherwise(F.col("_p.topics")),
    }
    return full.select(*[(merged[c] if c in merged else F.col(f"_p.{c}")).alias(c) for c in columns])


def _merged_lists(keyed: DataFrame) -> DataFrame:
    """Per key: ordered distinct union of tags and of topics.

    The least place of a value is kept by a sorting aggregate, so a task sorts all entries that it reads before it can
    combine them. The rows are dealt out evenly first: input files are few where they compress well, whatever they hold.
    """

    def entries(name: str) -> Column:
        return F.transform(name, lambda v, i: F.struct(F.lit(name).alias("list"), i.alias("i"), v.alias("value")))

    rows = keyed.select("_key", "_rank", "tags", "topics").repartition("_key", "_rank", "tags", "topics")
    values = rows.select("_key", "_rank", F.explode(F.concat(entries("tags"), entries("topics"))).alias("e"))
    distinct = values.groupBy("_key", "e.list", "e.value").agg(F.min(F.struct("_rank", "e.i")).alias("_at"))

    def gathered(name: str) -> Column:
        found = F.collect_list(F.when(F.col("list") == name, F.struct("_at", "value")))
        return F.transform(F.array_sort(found), lambda e: e["value"]).alias(f"_{name}")

    return distinct.groupBy("_key").agg(gathered("tags"), gathered("topics"))


def clean_dataset(items: DataFrame, *, tie: str = "id") -> DataFrame:
    """DUP-4: merge by repository, then by URL on the merged rows.

    The first merge is written once, since the second reads it three times.
    """
    by_repo = materialize(merge_duplicates(items, repo_key(), tie=tie))
    return merge_duplicates(by_repo, url_key(), tie=tie)
