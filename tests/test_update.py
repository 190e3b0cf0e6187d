from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gleanery.plans import update
from gleanery.plans.update import UpdateInputs
from gleanery.profiles import UPDATE_PROFILE
from tests.conftest import AS_OF


def classified(spark):
    repos = spark.createDataFrame(
        [("u/a", "a", 9), ("u/b", "b", 9), (None, "none", 9), ("u/a", "again", 9)], "full_name string, name string, stargazers_count long"
    ).withColumns({
        "description": F.lit("A ghost theme"), "topics": F.array(F.lit("ghost")), "archived": F.lit(False), "fork": F.lit(False),
        "pushed_at": F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz"),
    })
    listing = [(r, p, p, "file") for r in ("u/a", "x/other", "x/more", None) for p in ("index.hbs", "post.hbs", "package.json")]
    inputs = UpdateInputs(
        existing=None, overrides=None, rules=None, prior_stale=None,
        readmes=spark.createDataFrame([("u/a", "ghost theme"), ("x/other", "text"), (None, "t")], "full_name string, text string"),
        contents=spark.createDataFrame(listing, "full_name string, path string, name string, type string"),
        manifests=spark.createDataFrame([("u/a", '{"engines":{"ghost":"5"}}'), ("x/other", "{}"), (None, "{}")], "full_name string, json string"),
    )
    return update.classify_repos(repos, inputs, AS_OF, UPDATE_PROFILE)


def test_other_listings_are_left_out_before_they_are_grouped(spark):
    found = classified(spark)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 3
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "Aggregate" in line and "bit_or" in line)
    depth = lines[at].index("Aggregate")
    below = lines[at + 1 : next((i for i in range(at + 1, len(lines)) if len(lines[i]) - len(lines[i].lstrip(" :+-")) <= depth), len(lines))]
    assert any("LeftSemi" in line for line in below)


@pytest.mark.parametrize("small", [100_000, 0])
def test_repositories_few_or_many_get_the_same_scores(spark, monkeypatch, small):
    monkeypatch.setattr(update, "SMALL_TABLE_ROWS", small)
    rows = {r["name"]: r for r in classified(spark).collect()}
    assert set(rows) == {"a", "b", "none", "again"}
    assert rows["a"]["template_files"] == rows["again"]["template_files"] == 2 and rows["a"]["engine_version"] == "5" and rows["a"]["readme"] == "ghost theme"
    assert rows["b"]["template_files"] == rows["none"]["template_files"] == 0 and rows["none"]["readme"] is None
    assert rows["a"]["score"] > rows["b"]["score"]
