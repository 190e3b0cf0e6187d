from __future__ import annotations

from datetime import datetime

from gleanery.operators import reports as R
from tests.conftest import items, stale_items


def test_summary(spark):
    row = R.catalog_summary(
        items(
            spark, {"id": "casper", "stars": 2500}, {"id": "dawn", "stars": 1400, "category": "Official"},
            {"id": "none", "stars": 0, "category": ""}, {"id": "hidden", "stars": 9, "hidden": True},
        )
    ).first()
    assert (row["total_items"], row["total_stars"]) == (3, 3900)
    assert row["category_counts"] == {"Theme": 1, "Official": 1, "Other": 1}
    empty = R.catalog_summary(items(spark, {}).limit(0)).first()
    assert (empty["total_items"], empty["total_stars"], empty["category_counts"]) == (0, 0, {})


def test_top_and_recent(spark):
    table = items(
        spark, *[{"id": f"i{i:02d}", "stars": i // 2, "pushed_at": datetime(2026, 1, 1 + i)} for i in range(12)],
        {"id": "old", "stars": 99, "pushed_at": None}, {"id": "gone", "stars": 100, "hidden": True},
    )
    assert [r["id"] for r in R.top_by_stars(table, 3).collect()] == ["old", "i10", "i11"]
    recent = [r["id"] for r in R.recently_updated(table).collect()]
    assert recent == [f"i{i:02d}" for i in range(11, 1, -1)]


def test_equal_dates_keep_the_order_of_stars(spark):
    table = items(spark, {"id": "a", "stars": 1}, {"id": "b", "stars": 5}, {"id": "c", "stars": 3})
    assert [r["id"] for r in R.recently_updated(table).collect()] == ["b", "c", "a"]


def test_groups(spark):
    table = items(
        spark, {"id": "1", "category": "Starter"}, {"id": "2", "category": "Official", "stars": 1},
        {"id": "3", "category": "Official", "stars": 2}, {"id": "4", "category": "Plugin"}, {"id": "5", "category": None},
        {"id": "6", "hidden": True},
    )
    rows = R.category_groups(table).orderBy("category_rank", "category_name", "item_rank").collect()
    assert [(r["category_name"], r["item_rank"], r["id"]) for r in rows] == [
        ("OFFICIAL / TRYGHOST THEMES", 1, "3"), ("OFFICIAL / TRYGHOST THEMES", 2, "2"),
        ("STARTER & DEVELOPMENT THEMES", 1, "1"), ("OTHER THEMES", 1, "5"), ("PLUGIN THEMES", 1, "4"),
    ]
    ordered = R.category_order(table.filter("category is not null")).collect()
    assert [r["id"] for r in ordered] == ["3", "2", "6", "1", "4"]


def test_use_cases(spark):
    table = items(
        spark,
        {"id": "tag", "tags": ["Weekly-Newsletter"], "stars": 1},
        {"id": "name", "name": "Dawn", "stars": 3},
        {"id": "text", "description": "A NEWSLETTER. More", "stars": 2, "hidden": True},
        {"id": "exact", "tags": ["Minimal"], "stars": 9},
        {"id": "part", "tags": ["minimalist"], "stars": 9},
        {"id": "both", "tags": ["podcast", "magazine"], "description": None, "stars": 4},
        *[{"id": f"p{i}", "tags": ["portfolio"], "stars": 50 - i} for i in range(6)],
    )
    rows = R.use_case_lists(table).orderBy("label_pos", "rank").collect()
    lists: dict = {}
    for r in rows:
        lists.setdefault(r["label"], []).append(r["id"])
    assert lists == {
        "Newsletter Themes": ["name", "text", "tag"],
        "Magazine / Publication Themes": ["both"],
        "Minimalist / Clean Themes": ["exact"],
        "Portfolio / Creative Showcase": ["p0", "p1", "p2", "p3"],
        "Specialized": ["both"],
    }


def test_short_description(spark):
    long = "x" * 60
    table = items(
        spark, {"id": "1", "notes": "N", "description": "D"}, {"id": "2", "description": "One. Two"},
        {"id": "3", "description": long}, {"id": "4", "description": ""}, {"id": "5", "description": "y" * 50 + ". Z"},
    )
    got = {r["id"]: r["s"] for r in table.select("id", R.short_description().alias("s")).collect()}
    assert got == {"1": "N", "2": "One", "3": "x" * 50 + "...", "4": "Theme theme", "5": "y" * 50}


def test_rows(spark):
    table = items(spark, {"id": "1", "description": "D", "notes": "N"}, {"id": "2", "description": None, "notes": "N"},
                  {"id": "3", "description": "D"}, {"id": "4", "hidden": True})
    assert {r["id"]: r["notes"] for r in R.directory_rows(table).collect()} == {"1": "D; N", "2": "N", "3": "D"}
    stale = stale_items(
        spark,
        {"id": "1", "months_stale": 14, "pushed_at": datetime(2025, 3, 5)},
        {"id": "2", "months_stale": 20, "pushed_at": datetime(2024, 12, 31), "category": "Tool", "description": None},
    )
    got = {r["id"]: (r["section"], r["last_updated"]) for r in R.stale_rows(stale).collect()}
    assert got == {"1": ("theme", "March 5, 2025 (14 months ago)"), "2": ("tool", "December 31, 2024 (20 months ago)")}
    tool = R.report_tools(stale).collect()
    assert [(t["id"], t["description"], t["pushed_at"], t["months_stale"]) for t in tool] == [
        ("2", "", "December 31, 2024", 20)
    ]


def test_metrics(spark):
    table = items(spark, {"id": "1"}, {"id": "2"})
    rows = R.run_metrics(all=table, none=table.limit(0)).collect()
    assert {r["metric"]: r["n"] for r in rows} == {"all": 2, "none": 0}
