from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from gleanery.operators import dedup as D
from tests.conftest import by, items


def test_same_repo_twice(spark):
    base = items(spark, {"id": "o/c", "stars": 5}, {"id": "o/c-2", "repo": "O/C", "stars": 9}, {"id": "x/y"})
    groups = D.dedup_groups(base, D.repo_key(), reason=D.REPO_REASON).collect()
    assert [(g["group_key"], g["primary_id"], g["duplicates"], g["reason"]) for g in groups] == [
        ("o/c", "o/c-2", 1, "Multiple entries for repository: o/c")
    ]
    assert {r["id"] for r in D.dedup_primary(base, D.repo_key()).collect()} == {"o/c-2", "x/y"}


def test_url_pass_looks_at_the_winners_only(spark):
    base = items(
        spark,
        {"id": "a/1", "stars": 9, "url": "https://U"},
        {"id": "a/2", "repo": "a/1", "stars": 1, "url": "https://v"},
        {"id": "b/1", "stars": 3, "url": "https://u"},
        {"id": "c/1", "stars": 2, "url": "https://V"},
    )
    found = {(r["group_key"], r["duplicate_id"], r["primary_id"]) for r in D.detect_duplicates(base).collect()}
    assert found == {("a/1", "a/2", "a/1"), ("https://u", "b/1", "a/1")}


def test_survivorship(spark):
    base = items(
        spark,
        {"id": "1", "repo": "r", "stars": 50, "score": 70, "confidence": "medium", "tags": ["b", "a", "b"],
         "topics": [], "description": "short", "license": None, "notes": "first", "pushed_at": datetime(2024, 1, 1),
         "name": "Primary", "hidden": True},
        {"id": "2", "repo": "R", "stars": 40, "score": 90, "confidence": "high", "tags": ["c", "a"],
         "topics": ["t"], "description": "longest-1", "license": "", "notes": "", "pushed_at": datetime(2025, 1, 1)},
        {"id": "3", "repo": "r", "stars": 30, "score": 90, "confidence": "low", "tags": [],
         "topics": ["u", "t"], "description": "longest-2", "license": "mit", "notes": "third",
         "pushed_at": datetime(2023, 1, 1)},
        {"id": "4", "repo": "r", "stars": 20, "score": 10, "confidence": "low", "tags": ["d"], "description": None,
         "license": "gpl", "notes": "first", "pushed_at": None},
    )
    row = D.merge_duplicates(base, D.repo_key()).collect()
    assert len(row) == 1
    row = row[0]
    assert (row["id"], row["name"], row["stars"], row["hidden"]) == ("1", "Primary", 50, True)
    assert row["tags"] == ["b", "a", "c", "d"]
    assert row["topics"] == ["t", "u"]
    assert row["description"] == "longest-1"
    assert (row["score"], row["confidence"]) == (90, "high")
    assert row["license"] == "mit"
    assert row["notes"] == "first; third; first"
    assert row["pushed_at"] == datetime(2025, 1, 1)


def test_a_single_row_is_left_as_it_is(spark):
    row = D.merge_duplicates(items(spark, {"id": "1", "tags": ["a", "a"], "description": ""}), D.repo_key()).first()
    assert (row["tags"], row["description"]) == (["a", "a"], "")


def test_long_notes_stay_whole(spark):
    notes = [c * 6_000_000 for c in "abc"]
    base = items(spark, *[{"id": str(i), "repo": "r", "stars": 9 - i, "notes": n} for i, n in enumerate(notes)])
    assert D.merge_duplicates(base, D.repo_key()).first()["notes"] == "; ".join(notes)
    rows = D.group_notes(base, D.repo_key()).orderBy("rank").collect()
    assert [r["notes"] for r in rows] == notes


def test_the_rows_of_a_key_meet_no_join(spark):
    plan = D.merge_duplicates(items(spark, {"id": "1"}), D.repo_key())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1


def test_clean_dataset_is_idempotent_and_order_free(spark):
    rows = [
        {"id": f"o/{i}", "repo": f"o/{i % 7}", "url": f"https://u/{i % 5}", "stars": i % 11, "tags": [f"t{i % 3}"],
         "score": i % 50, "notes": f"n{i}" if i % 4 == 0 else None}
        for i in range(60)
    ]
    once = D.clean_dataset(items(spark, *rows))
    again = D.clean_dataset(once)
    shuffled = D.clean_dataset(items(spark, *rows[::-1]).repartition(7))
    as_set = lambda df: sorted(map(str, df.collect()))
    assert as_set(once) == as_set(again) == as_set(shuffled)


def test_one_hot_key_with_a_third_of_all_rows(spark):
    n = 30_000
    hot = (
        spark.range(n)
        .withColumn("repo", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id"))))
        .select(
            F.col("id").cast("string").alias("id"), F.lit("n").alias("name"), "repo", F.lit("u").alias("url"),
            F.lit("d").alias("description"), F.lit("Theme").alias("category"),
            F.array(F.concat(F.lit("t"), (F.col("id") % 9).cast("string"))).alias("tags"), F.col("id").alias("stars"),
            F.lit(datetime(2024, 1, 1)).alias("pushed_at"), F.lit(False).alias("archived"), F.lit(False).alias("fork"),
            F.lit("mit").alias("license"), F.array(F.lit("x")).alias("topics"), F.lit(1).alias("score"),
            F.lit("low").alias("confidence"), F.lit(None).cast("string").alias("notes"), F.lit(False).alias("hidden"),
        )
    )
    merged = D.merge_duplicates(hot, D.repo_key())
    assert merged.count() == n - n // 3 + 1
    row = merged.filter("repo = 'hot'").first()
    assert row["id"] == str(n - 3) and row["stars"] == n - 3
    assert sorted(row["tags"]) == ["t0", "t3", "t6"]
    members = D.dedup_members(hot, D.repo_key(), reason="")
    assert members.count() == n // 3 - 1
    assert by(D.dedup_groups(hot, D.repo_key(), reason=""), "group_key")["hot"]["duplicates"] == n // 3 - 1


def test_a_heavy_group_is_dealt_to_many_tasks_without_adaptive_help(spark):
    base = spark.range(30_000).select(
        F.col("id").cast("string").alias("id"), F.when(F.col("id") % 3 > 0, F.lit("Hot/Repo")).otherwise(F.concat(F.lit("own/"), F.col("id") % 4000)).alias("repo"),
        (F.col("id") % 7).alias("stars"),
    )
    plain = D.dedup_members(base, D.repo_key(), reason="r ")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = D.dedup_members(base, D.repo_key(), reason="r ", heavy=500)
        sizes = [r["count"] for r in split.where("group_key = 'hot/repo'").groupBy(F.spark_partition_id()).count().collect()]
        found = split.exceptAll(plain).count(), plain.exceptAll(split).count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == (0, 0) and sum(sizes) == 19_999 and len(sizes) >= 6 and max(sizes) < 0.4 * sum(sizes)


def test_entries_of_one_file_are_combined_by_many_tasks(spark, tmp_path):
    """All rows come in one task; the sorting aggregate over their tags and topics must not be in that task."""
    rows = spark.range(0, 20_000, 1, 1).select(
        F.concat(F.lit("r/"), F.col("id") % 5).alias("repo"), F.col("id").cast("string").alias("id"), (F.col("id") % 7).alias("stars"),
        F.array((F.col("id") % 3).cast("string")).alias("tags"), F.array(F.lit("t"), (F.col("id") % 2).cast("string")).alias("topics"),
    )
    keyed = rows.select(F.col("repo").alias("_key"), F.struct((-F.col("stars")).alias("s"), F.col("id").alias("t")).alias("_rank"), "tags", "topics")
    merged = D._merged_lists(keyed)
    found = {r["_key"]: (r["_tags"], r["_topics"]) for r in merged.collect()}
    assert len(found) == 5 and all(len(tags) == 3 and topics[0] == "t" and len(topics) == 3 for tags, topics in found.values())
    plan = merged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    lowest = [line for line in plan.splitlines() if "SortAggregate" in line or "Exchange" in line]
    assert "Exchange" in lowest[-1] and "SortAggregate" in lowest[-2]
