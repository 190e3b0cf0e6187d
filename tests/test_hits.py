from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gleanery import schemas as S
from gleanery.operators import hits as H
from tests.conftest import by

COLUMNS = ["query_pos", "page", "hit_pos", *S.HIT.fieldNames()]
SCHEMA = "query_pos int, page int, hit_pos int, " + (
    "id bigint, name string, full_name string, html_url string, description string, stargazers_count bigint, "
    "pushed_at timestamp, archived boolean, fork boolean, license struct<key:string>, owner struct<login:string>"
)


def hit(query, page, pos, name, stars=5, archived=None, fork=None, license=None):
    return (
        query, page, pos, 1, name.split("/")[-1], name, f"https://h/{name}", None, stars, datetime(2024, 1, 1),
        archived, fork, license, (name.split("/")[0],),
    )


def table(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def specs(spark, *rows):
    return spark.createDataFrame([(i, f"q{i}", m, s) for i, (m, s) in enumerate(rows)], S.SEARCH_SPEC)


def reference_walk(rows, wanted, max_pages, full_page, archived_too=False):
    """The same collapse written as a plain loop over pages."""
    result, seen_all = [], set()
    for query, (max_results, min_stars) in enumerate(wanted):
        got, seen = [], set()
        for page in range(1, max_pages + 1):
            here = sorted((r for r in rows if r[0] == query and r[1] == page), key=lambda r: r[2])
            if not here:
                break
            for r in here:
                if r[5] in seen:
                    continue
                seen.add(r[5])
                if (r[10] and not archived_too) or r[8] < min_stars:
                    continue
                if len(got) < max_results:
                    got.append(r)
            if len(got) >= max_results or len(here) < full_page:
                break
        for r in got:
            if r[5] not in seen_all:
                seen_all.add(r[5])
                result.append((r[5], r[8]))
    return sorted(result)


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_collapse_equals_a_plain_walk(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for query in range(3):
        for page in range(1, 8):
            size = 6 if rnd.random() < 0.8 else 4
            if rnd.random() < 0.07:
                continue
            for pos in range(size):
                rows.append(
                    hit(query, page, pos, f"o/{rnd.randrange(25)}", rnd.randrange(10), rnd.random() < 0.2 or None)
                )
    wanted = [(4, 2), (9, 0), (100, 5)]
    found = H.collapse_hits(table(spark, *rows).repartition(5), specs(spark, *wanted), max_pages=5, full_page=6)
    got = sorted((r["full_name"], r["stargazers_count"]) for r in found.collect())
    assert got == reference_walk(rows, wanted, 5, 6)


def test_seen_comes_before_the_filters(spark):
    rows = [hit(0, 1, 0, "a/x", archived=True), hit(0, 1, 1, "a/x"), hit(0, 1, 2, "b/x", stars=1), hit(0, 1, 3, "b/x")]
    found = H.collapse_hits(table(spark, *rows), specs(spark, (10, 3)))
    assert found.count() == 0


def test_reading_stops_at_a_short_or_missing_page(spark):
    full = [hit(0, p, i, f"o/{p}-{i}") for p in (1, 3) for i in range(2)] + [hit(0, 2, 0, "o/2-0")]
    gap = [hit(1, p, i, f"g/{p}-{i}") for p in (1, 3) for i in range(2)]
    first_missing = [hit(2, 2, 0, "m/2-0")]
    pages = H.pages_read(table(spark, *full, *gap, *first_missing), max_pages=10, full_page=2).collect()
    assert sorted((r["query_pos"], r["page"]) for r in pages) == [(0, 1), (0, 2), (1, 1)]


def test_forks_and_archived(spark):
    rows = [hit(0, 1, 0, "a/1", archived=True), hit(0, 1, 1, "a/2", fork=True), hit(0, 1, 2, "a/3")]
    kept = lambda **o: {r["full_name"] for r in H.include_hits(table(spark, *rows), **o).collect()}
    assert kept() == {"a/2", "a/3"}
    assert kept(include_archived=True, include_forks=False) == {"a/1", "a/3"}


def test_normalize(spark):
    details = spark.createDataFrame([("a/1", ["t"])], S.DETAIL)
    found = by(
        H.normalize_hits(table(spark, hit(0, 1, 0, "a/1", license=("mit",)), hit(0, 1, 1, "a/2")), details), "full_name"
    )
    assert found["a/1"]["topics"] == ["t"] and found["a/1"]["license"]["key"] == "mit" and found["a/1"]["id"] == "1"
    assert found["a/2"]["topics"] == [] and found["a/2"]["license"] is None and found["a/2"]["archived"] is False


def test_one_hot_query(spark):
    n = 20_000
    hot = spark.range(n).select(
        F.lit(0).alias("query_pos"),
        (F.floor(F.col("id") / 100) + 1).cast("int").alias("page"),
        (F.col("id") % 100).cast("int").alias("hit_pos"),
        F.col("id").alias("n"),
    )
    wanted = specs(spark, (12_345, 0))
    kept = H.cap_per_query(hot, wanted, H.bounds_of(wanted), max_pages=1000)
    row = kept.agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("m")).first()
    assert (row["c"], row["m"]) == (12_345, 12_344)


def test_one_hot_page_is_pruned_before_the_shuffle(spark):
    hot = spark.range(5_000).select(
        (F.col("id") % 1).cast("int").alias("query_pos"), (F.col("id") % 1 + 1).cast("int").alias("page"), F.col("id").cast("int").alias("hit_pos"), F.col("id").alias("n")
    )
    wanted = specs(spark, (7, 0))
    kept = H.cap_per_query(hot.repartition(5), wanted, H.bounds_of(wanted))
    assert sorted(r["n"] for r in kept.collect()) == list(range(7))
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()


def test_whole_rows_are_fetched_by_position(spark):
    plan = H.collapse_hits(
        table(spark, hit(0, 1, 0, "a/1")), specs(spark, (10, 0))
    )._jdf.queryExecution().executedPlan().toString()
    top = plan[: plan.index("BroadcastExchange")]
    assert "BroadcastHashJoin" in top and "Window" not in top and "hashpartitioning" not in top


def test_hits_are_scanned_twice_and_stray_queries_left_out(spark, tmp_path):
    """Hits of a query that no list has never reach a table that is sent whole."""
    rows = [hit(q, p, k, f"a/{q}-{p}-{k}") for q in (0, 7, 8) for p in (1, 2) for k in range(3)]
    table(spark, *rows).write.parquet(str(tmp_path / "hits"))
    stored = spark.read.parquet(str(tmp_path / "hits"))
    found = H.collapse_hits(stored, specs(spark, (4, 0)), full_page=3)
    assert {r.full_name for r in found.collect()} == {"a/0-1-0", "a/0-1-1", "a/0-1-2", "a/0-2-0"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count(str(tmp_path / "hits")) == 1
    limited = H.page_limit(stored, full_page=3)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in limited


def test_repo_metadata(spark):
    contents = spark.createDataFrame(
        [
            ("a/1", "Index.hbs", "Index.hbs", "file"), ("a/1", "package.json", "package.json", "file"),
            ("a/2", "partials", "partials", "dir"), ("a/2", "partials/x.HBS", "x.HBS", "file"),
            ("a/3", "src/y.hbs", "y.hbs", "file"),
        ],
        "full_name string, path string, name string, type string",
    )
    repos = spark.createDataFrame([("a/1",), ("a/2",), ("a/3",), ("a/4",)], "full_name string")
    readmes = spark.createDataFrame([("a/1", "hello")], "full_name string, text string")
    found = by(H.repo_metadata(repos, contents, readmes), "full_name")
    flags = lambda r: (r["has_template_files"], r["has_package_json"], r["has_theme_files"])
    assert flags(found["a/1"]) == (True, True, True) and found["a/1"]["readme"] == "hello"
    assert flags(found["a/2"]) == (True, False, False)
    assert flags(found["a/3"]) == flags(found["a/4"]) == (False, False, False)


def test_categories(spark):
    schema = (
        "name string, full_name string, html_url string, description string, stargazers_count bigint, pushed_at timestamp, "
        "archived boolean, fork boolean, license struct<key:string>, topics array<string>, owner struct<login:string>, "
        "score int, confidence string"
    )

    def repo(full_name, name="x", description=None, topics=(), license=None):
        return (
            name, full_name, "u", description, 1, None, False, False, license, list(topics), (full_name.split("/")[0],),
            50, "low",
        )

    rows = [
        repo("TryGhost/Toolbox", name="Toolbox"), repo("a/1", name="My-Tool"), repo("a/2", description="A TOOL"),
        repo("a/3", topics=["tooling"]), repo("a/4", topics=["TOOL"]), repo("a/5", name="Starter"),
        repo("a/6", description="toolless starter"), repo("a/7", license=("",)),
    ]
    found = by(H.to_item_categorized(spark.createDataFrame(rows, schema), official_owner="tryghost"), "id")
    assert {k: v["category"] for k, v in found.items()} == {
        "TryGhost/Toolbox": "Official", "a/1": "Tool", "a/2": "Tool", "a/3": "Tool", "a/4": "Theme", "a/5": "Starter",
        "a/6": "Tool", "a/7": "Theme",
    }
    assert found["a/7"]["license"] is None
