from __future__ import annotations

from gleanery.operators import merge as M
from tests.conftest import by, items, overrides, rules


def outcomes(spark, existing, new, patch=(), repos=(), patterns=()):
    return M.merge_outcomes(
        items(spark, *existing) if existing else items(spark, {}).limit(0),
        items(spark, *new) if new else items(spark, {}).limit(0),
        overrides(spark, *patch), rules(spark, repos, patterns),
    )


def test_all_branches(spark):
    found = by(
        outcomes(
            spark,
            existing=[
                {"id": "seen/again", "stars": 3, "score": 50},
                {"id": "old/topic", "topics": ["My-Ghost-Theme"], "score": 0},
                {"id": "TryGhost/x", "score": 0},
                {"id": "old/score", "score": 50},
                {"id": "old/weak", "score": 49, "topics": ["a", "b"]},
                {"id": "old/ruled-test", "score": 99},
                {"id": "old/hidden", "score": 80, "hidden": True},
                {"id": "seen/ignored-test", "score": 99},
                {"id": "seen/now-hidden", "score": 99},
            ],
            new=[
                {"id": "seen/again", "stars": 7, "score": 60},
                {"id": "brand/new", "stars": 1, "score": 55},
                {"id": "seen/ignored-test"},
                {"id": "seen/now-hidden"},
                {"id": "brand/hidden", "hidden": True},
            ],
            patch=[
                {"repo": "seen/now-hidden", "hidden": True},
                {"repo": "brand/new", "category": "Tool"},
                {"repo": "old/score", "name": "Renamed"},
            ],
            patterns=["-test$"],
        ),
        "repo",
    )
    assert {k: v["outcome"] for k, v in found.items()} == {
        "seen/again": "updated",
        "brand/new": "added",
        "seen/ignored-test": "ignored",
        "seen/now-hidden": "hidden",
        "brand/hidden": "hidden",
        "old/topic": "kept",
        "TryGhost/x": "kept",
        "old/score": "kept",
        "old/weak": "removed_invalid",
        "old/ruled-test": "removed_rule",
        "old/hidden": "kept",
    }
    assert found["seen/again"]["details"] == "Updated: stars 3 → 7, score 50 → 60"
    assert found["brand/new"]["details"] == "Added: Tool with 1 stars, score 55"
    assert found["old/weak"]["details"] == (
        'Existing item removed: no Ghost topic (topics: ["a","b"]) and score 49 < 50'
    )
    assert found["old/ruled-test"]["details"] == "Existing item removed: matches ignore rules"
    assert found["seen/ignored-test"]["details"] == "Repository matches ignore rules"
    assert found["seen/now-hidden"]["details"] == "Repository hidden by override rules"
    assert found["old/score"]["name"] == "Renamed" and found["old/hidden"]["hidden"]


def test_items_changes_and_stats_agree(spark):
    found = outcomes(
        spark,
        existing=[{"id": "a/a"}, {"id": "b/b", "score": 1}],
        new=[{"id": "a/a"}, {"id": "c/c"}, {"id": "d/d"}],
        repos=["d/d"],
    )
    assert {r["repo"] for r in M.merged_items(found).collect()} == {"a/a", "c/c"}
    assert M.change_stats(found).first().asDict() == {"added": 1, "updated": 1, "removed": 1, "ignored": 1}
    assert {r["type"] for r in M.change_log(found).collect()} == {"added", "updated", "removed", "ignored"}


def test_snapshot_with_itself_adds_nothing(spark):
    rows = [{"id": f"o/{i}", "score": i} for i in range(20)]
    stats = M.change_stats(outcomes(spark, rows, rows)).first()
    assert (stats["added"], stats["updated"], stats["removed"]) == (0, 20, 0)


def test_nothing_new(spark):
    found = outcomes(spark, [{"id": "o/1", "score": 60}, {"id": "o/2", "score": 10}], [])
    assert {r["repo"]: r["outcome"] for r in found.collect()} == {"o/1": "kept", "o/2": "removed_invalid"}


def test_repeated_keys_resolve_to_the_last(spark):
    new = items(spark, {"id": "o/1", "stars": 1}, {"id": "o/1", "stars": 2})
    from pyspark.sql import functions as F

    new = new.withColumn("pos", F.col("stars"))
    found = M.merge_outcomes(items(spark, {}).limit(0), new, overrides(spark), rules(spark), new_pos="pos").collect()
    assert [(r["repo"], r["stars"]) for r in found] == [("o/1", 2)]


def test_unclassified_drops_the_old_version_too(spark):
    schema = (
        "id string, name string, full_name string, html_url string, description string, stargazers_count bigint, "
        "pushed_at timestamp, archived boolean, fork boolean, license struct<key:string>, topics array<string>, "
        "owner struct<login:string>"
    )
    repos = spark.createDataFrame(
        [
            ("1", "x", "u/x", "https://x", "d", 5, None, False, False, ("MIT",), ["t"], ("u",)),
            ("2", "y", "u/y", "https://y", "d", 5, None, False, False, None, None, ("u",)),
            ("3", "z", "u/z-test", "https://z", "d", 5, None, False, False, None, [], ("u",)),
        ],
        schema,
    )
    scored = spark.createDataFrame([("u/x", 80, "high")], "full_name string, score int, confidence string")
    found = by(
        M.merge_classified(
            items(spark, {"id": "u/y", "score": 90}, {"id": "u/old", "score": 1}), repos, scored, overrides(spark),
            rules(spark, patterns=["-test$"]),
        ),
        "repo",
    )
    assert {k: v["outcome"] for k, v in found.items()} == {
        "u/x": "added", "u/y": "unclassified", "u/z-test": "ignored", "u/old": "removed_invalid",
    }
    assert (found["u/x"]["license"], found["u/x"]["tags"], found["u/x"]["category"]) == ("MIT", ["t"], "Theme")
    assert found["u/y"]["change"] is None
    assert found["u/old"]["details"] == "Existing item removed: no Ghost topic and score 1 < 50"


def test_compare_snapshots(spark):
    old = items(
        spark,
        {"id": "same", "tags": ["a", "b"], "notes": None},
        {"id": "date", "url": "https://1"},
        {"id": "null", "description": None},
        {"id": "gone"},
        {"id": "tag", "tags": ["a"]},
    )
    from datetime import datetime

    new = items(
        spark,
        {"id": "same", "tags": ["b", "a"], "notes": None},
        {"id": "date", "url": "https://2", "pushed_at": datetime(2020, 1, 1)},
        {"id": "null", "description": "x"},
        {"id": "here"},
        {"id": "tag", "tags": ["a", "a"]},
    )
    found = {r["id"]: r["status"] for r in M.compare_snapshots(old, new).collect()}
    assert found == {
        "same": "unchanged", "date": "unchanged", "null": "updated", "gone": "removed", "here": "added", "tag": "updated",
    }


def test_one_outcome_per_repository_in_any_order(spark):
    import random

    rnd = random.Random(5)
    make = lambda n, tag: [
        {"id": f"o/{i}", "score": rnd.randrange(100), "stars": i, "hidden": rnd.random() < 0.1,
         "topics": ["ghost"] if rnd.random() < 0.3 else [], "name": tag}
        for i in rnd.sample(range(80), n)
    ]
    old, new = make(50, "old"), make(50, "new")
    patch = [{"repo": f"o/{i}", "hidden": i % 2 == 0} for i in range(0, 80, 7)]

    def run(a, b, parts):
        return M.merge_outcomes(
            items(spark, *a).repartition(parts), items(spark, *b).repartition(parts), overrides(spark, *patch),
            rules(spark, ["o/3"], ["5$"]),
        )

    found = run(old, new, 3)
    again = run(old[::-1], new[::-1], 7)
    as_rows = lambda df: sorted((r["repo"], r["outcome"], str(r["details"]), r["name"]) for r in df.collect())
    assert as_rows(found) == as_rows(again)
    repos = [r["repo"] for r in found.collect()]
    assert sorted(repos) == sorted({r["id"] for r in old} | {r["id"] for r in new})
