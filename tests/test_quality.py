from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gleanery.functions.columns import is_json, is_url
from gleanery.operators import quality as Q
from tests.conftest import AS_OF, by, item, items, overrides, rules, stale_items


def test_three_errors(spark):
    bad = items(spark, {"id": "x", "stars": -1, "score": 150, "confidence": "invalid"})
    found = Q.consistency_errors(bad).collect()
    assert [(r["severity"], r["rule"], r["message"]) for r in found] == [
        ("error", "stars", "Item x has invalid stars count: -1"),
        ("error", "score", "Item x has invalid score: 150"),
        ("error", "confidence", "Item x has invalid confidence: invalid"),
    ]
    assert Q.consistency_errors(items(spark, {})).count() == 0


def test_every_missing_field_is_listed(spark):
    bad = items(
        spark,
        {"id": "", "repo": None, "name": " ", "url": "no url", "description": "\n", "category": None, "tags": None},
        {"id": "y", "category": "Odd"},
    )
    found = {(r["id"], r["rule"], r["severity"]) for r in Q.consistency_errors(bad).collect()}
    assert found == {
        ("", "id", "error"), ("", "repo", "error"), ("", "name", "error"), ("", "url_format", "error"),
        ("", "description", "warning"), ("", "category", "error"), ("", "tags", "error"),
        ("y", "category_value", "warning"),
    }


def test_a_row_without_id_is_shown_whole(spark):
    message = Q.consistency_errors(items(spark, {"id": None, "repo": "a/b", "stars": 7})).first()["message"]
    assert message.startswith("Item missing ID: {") and '"repo":"a/b"' in message and '"stars":7' in message


def test_stats(spark):
    table = items(spark, {"url": "https://a"}, {"url": "nope"}, {"url": ""}, {"description": None}, {"category": " "})
    assert Q.consistency_stats(table).first().asDict() == {
        "total_items": 5, "valid_urls": 3, "invalid_urls": 1, "missing_descriptions": 1, "missing_categories": 1,
    }


@pytest.mark.parametrize(
    ("change", "error"),
    [
        ({}, None),
        ({"name": ""}, "name is required and must be a string"),
        ({"tags": None, "stars": -1}, "tags must be an array"),
        ({"stars": -1, "score": 101}, "stars must be a non-negative number"),
        ({"score": 101}, "score must be a number between 0 and 100"),
        ({"fork": None}, "fork must be a boolean"),
        ({"confidence": "x", "category": "y"}, "confidence must be one of: high, medium, low"),
        ({"category": "y"}, "category must be one of: Theme, Tool, Starter, Official"),
        ({"pushed_at": None}, "pushedAt must be a valid ISO date string"),
    ],
)
def test_strict_first_error(spark, change, error):
    assert Q.validate_items(items(spark, change)).first()["error"] == error


def test_text_dates_have_to_parse(spark):
    table = items(spark, {"id": "1"}, {"id": "2"}).withColumn(
        "pushed_at", F.when(F.col("id") == "1", "2024-01-31T10:00:00.123Z").otherwise("yesterday")
    )
    found = by(Q.validate_items(table), "id")
    assert found["1"]["error"] is None and found["2"]["error"]
    good, bad = Q.split_valid(Q.validate_items(table))
    assert (good.count(), bad.count()) == (1, 1)


def test_gate_fails_the_read(spark):
    table = items(spark, {"id": "1"}, {"id": "2", "stars": -1}).withColumn("pos", F.col("id").cast("int"))
    with pytest.raises(PySparkException, match="Item 2: stars must be a non-negative number"):
        Q.require_valid(table, "pos").collect()
    assert Q.require_valid(table.filter("id = '1'"), "pos").count() == 1


def test_validate_all(spark):
    specs = spark.createDataFrame(
        [(0, "q", 1, 0), (1, "", 1, 0), (2, "q", 0, 0), (3, "q", 1, -1)],
        "query_pos int, query string, max_results int, min_stars int",
    )
    found = Q.validate_all(
        items(spark, {"id": "i", "stars": -1}), overrides(spark, {"repo": "a/b"}, {"repo": ""}),
        rules(spark, repos=[None], patterns=["ok", "("]), specs,
    )
    assert {(r["source"], r["row_key"], r["error"]) for r in found.collect()} == {
        ("items", "i", "stars must be a non-negative number"),
        ("overrides", "1", "repo is required and must be a string"),
        ("rules", "0", "repos[0] must be a string"),
        ("rules", "1", "patterns[1] must be a valid regex pattern"),
        ("sources", "1", "query is required and must be a string"),
        ("sources", "2", "maxResults must be a positive number"),
        ("sources", "3", "minStars must be a non-negative number"),
    }


def test_state(spark):
    good = {"id": "ok", "stale_detected_at": AS_OF, "months_stale": 13}
    assert Q.validate_state(stale_items(spark, good)).count() == 0
    bad = stale_items(spark, good, {"id": "", "months_stale": -1}, {"id": "n", "stars": -1, **{k: good[k] for k in ("stale_detected_at", "months_stale")}})
    messages = {r["message"] for r in Q.validate_state(bad).collect()}
    assert messages == {
        "Item missing required fields: unknown", "Item missing staleDetectedAt: ", "Item has invalid monthsStale: ",
        "Found 2 items with negative numeric values",
    }
    assert {r["message"] for r in Q.validate_state(bad.drop("months_stale", "tags")).collect()} == {
        "Missing required column: tags", "Missing required column: months_stale", "Item missing required fields: unknown",
        "Item missing staleDetectedAt: ", "Found 1 items with negative numeric values",
    }


def test_urls_are_read_as_browsers_read_them(spark):
    good = ["https://x.example/a b", "https://x.example/ä|", " https://x.example ", "http://x.example?q={1}^#a#b", "https://x.example/%zz", "mailto:a@b.example"]
    bad = ["x.example/a", "no url", "", "https://x example/a", "http//x"]
    rows = spark.createDataFrame([(u,) for u in good + bad], "url string")
    assert {r["url"] for r in rows.filter(Q.is_url("url")).collect()} == set(good)


def test_state_with_lists_as_text(spark):
    table = stale_items(spark, {"id": "x", "stale_detected_at": AS_OF, "months_stale": 13}).withColumns(
        {"tags": F.lit('["a"'), "topics": F.lit("[]")}
    )
    assert [r["message"] for r in Q.validate_state(table).collect()] == ["Invalid JSON in tags for item x"]


def test_json_has_to_be_one_whole_value(spark):
    texts = {'{"a":1}': True, "null": True, "1": True, '"x"': True, "[]": True, '{"a":1}x': False, "1,2": False,
             "": False, "1],[2": False, '1,"$end"': False, "{": False, "{} {}": False}
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", is_json("t").alias("ok")).collect()
    assert {r["t"]: r["ok"] for r in rows} == texts


def test_urls(spark):
    urls = {"https://a.b/c": True, "foo:bar": True, "a/b": False, "": False, "not a url": False}
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select("u", is_url("u").alias("ok")).collect()
    assert {r["u"]: r["ok"] for r in rows} == urls


def test_page_lint(spark):
    good = (
        "<html><head><title>Catalog - Not Updated Recently</title></head><body><h2>STALE THEMES</h2>"
        '<p>These items have not been updated in over 12 months: 3 stale items</p><a href="index.html">x</a> stale.html</body></html>'
    )
    bad = "<b>" * 12
    found = by(Q.page_lint(spark.createDataFrame([(1, good), (2, bad)], "page_id int, html string")), "page_id")
    assert found[1]["warnings"] == [] and found[1]["balanced"] and found[1]["has_title"]
    assert found[2]["warnings"] == [
        'Title with "Not Updated Recently" not found in HTML', "Warning message not found in HTML",
        "Link back to main page not found in HTML", "Category headers not found in HTML",
        "Statistics display not found in HTML", "HTML tag mismatch: 12 open tags, 0 close tags",
        "Link to stale.html not found", "Link to index.html not found",
    ]


def test_a_right_pair_of_pages_has_no_finding(spark):
    stale = (
        "<html><head><title>Catalog - Not Updated Recently</title></head><body><h2>STALE THEMES</h2>"
        '<p>These items have not been updated in over 12 months: 3 stale items</p><a href="index.html">x</a></body></html>'
    )
    rows = [(1, "stale", stale), (2, "index", '<a href="stale.html">x</a>')]
    pages = spark.createDataFrame(rows, "page_id int, role string, html string")
    assert Q.site_findings(pages).collect() == []
    bad = spark.createDataFrame([(2, "index", None)], pages.schema)
    assert {tuple(r) for r in Q.site_findings(bad).collect()} == {
        ("warning", "page", 2, "Link to stale.html not found in index.html"),
        ("error", "page", None, "Stale HTML file not found: stale.html"),
    }
    assert [r["message"] for r in Q.site_findings(pages.filter("page_id = 1")).collect()] == ["Main index file not found: index.html"]


def test_item_builder_is_valid(spark):
    assert item()["repo"] == "owner/name"
