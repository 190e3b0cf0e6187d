from __future__ import annotations

from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleanery.functions.columns import months_stale, two_years_before
from gleanery.operators import staleness as ST
from tests.conftest import AS_OF, by, items, stale_items


def months_ago(n: int) -> datetime:
    k = AS_OF.year * 12 + AS_OF.month - 1 - n
    return datetime(k // 12, k % 12 + 1, 1)


def empty_state(spark):
    return stale_items(spark, {}).limit(0)


def test_boundary_is_strict(spark):
    base = items(spark, {"id": "12", "pushed_at": months_ago(12)}, {"id": "13", "pushed_at": months_ago(13)})
    found = by(ST.with_staleness(base, AS_OF), "id")
    assert (found["12"]["is_stale"], found["13"]["is_stale"]) == (False, True)


def test_thresholds(spark):
    ages = (3, 6, 9, 12, 15, 18, 24, 36)
    base = items(spark, *[{"id": str(a), "pushed_at": months_ago(a)} for a in ages])
    for threshold in (6, 12, 18, 24):
        found = ST.with_staleness(base, AS_OF, threshold).filter("is_stale").collect()
        assert {int(r["id"]) for r in found} == {a for a in ages if a > threshold}


def test_day_of_month_does_not_count_and_the_future_is_zero(spark):
    base = items(
        spark,
        {"id": "last-day", "pushed_at": datetime(2026, 3, 31, 23, 59)},
        {"id": "future", "pushed_at": datetime(2030, 1, 1)},
        {"id": "none", "pushed_at": None},
    )
    found = by(ST.with_staleness(base, AS_OF), "id")
    assert found["last-day"]["months_stale"] == 1
    assert found["future"]["months_stale"] == 0
    assert found["none"]["months_stale"] is None and found["none"]["is_stale"] is False


def test_two_runs(spark):
    active = [{"id": f"active/{i}", "pushed_at": months_ago(i)} for i in (1, 3, 6)]
    stale = [
        {"id": "stale/1", "pushed_at": months_ago(14)},
        {"id": "stale/2", "pushed_at": months_ago(18)},
        {"id": "stale/3", "pushed_at": months_ago(24), "category": "Tool"},
        {"id": "stale/4", "pushed_at": months_ago(30), "category": "Starter"},
    ]
    back = [{"id": "back/1", "pushed_at": months_ago(15)}, {"id": "back/2", "pushed_at": months_ago(20)}]
    first = ST.detect_staleness(items(spark, *active, *stale, *back), empty_state(spark), AS_OF)
    counts = ST.staleness_counters(first).first().asDict()
    assert counts == {
        "total_processed": 9, "active_count": 3, "newly_stale": 6, "reactivated": 0, "remaining_stale": 0,
    }
    state = ST.next_state(first)
    assert state.count() == 6

    later = datetime(2026, 4, 20)
    refreshed = [{**b, "pushed_at": months_ago(0)} for b in back]
    second = ST.detect_staleness(items(spark, *active, *stale, *refreshed), state, later)
    counts = ST.staleness_counters(second).first().asDict()
    assert counts == {
        "total_processed": 9, "active_count": 5, "newly_stale": 0, "reactivated": 2, "remaining_stale": 0,
    }
    after = ST.next_state(second)
    assert {r["stale_detected_at"] for r in after.collect()} == {AS_OF}
    row = ST.stale_statistics(after).first()
    assert (row["total_stale"], row["by_category"]) == (4, {"Theme": 2, "Tool": 1, "Starter": 1})
    assert row["average_months_stale"] == 21.5
    assert ST.overlap_check(ST.active_items(second), after).count() == 0


def test_rows_not_seen_remain_as_stored(spark):
    state = stale_items(spark, {"id": "x", "name": "Old", "stale_detected_at": datetime(2025, 1, 1), "months_stale": 13})
    row = ST.detect_staleness(items(spark, {"id": "y"}), state, AS_OF).filter("state = 'remaining'").first()
    assert (row["id"], row["name"], row["months_stale"], row["stale_detected_at"]) == (
        "x", "Old", 13, datetime(2025, 1, 1),
    )


def test_upsert_equals_next_state(spark):
    state = stale_items(
        spark,
        {"id": "keep", "months_stale": 20, "stale_detected_at": AS_OF},
        {"id": "back", "months_stale": 20, "stale_detected_at": AS_OF},
        {"id": "still", "months_stale": 20, "stale_detected_at": AS_OF},
    )
    seen = items(
        spark, {"id": "back"}, {"id": "still", "pushed_at": months_ago(30)}, {"id": "new", "pushed_at": months_ago(40)}
    )
    found = ST.detect_staleness(seen, state, AS_OF)
    upserts = found.filter(F.col("state").isin("newly_stale", "still_stale")).drop("state")
    by_upsert = ST.upsert_state(state, upserts, found.filter("state = 'reactivated'"))
    rows = lambda df: sorted((r["id"], r["months_stale"]) for r in df.collect())
    assert rows(by_upsert) == rows(ST.next_state(found)) == [("keep", 20), ("new", 40), ("still", 30)]


def test_report_statistics(spark):
    def report(total, *rows):
        table = stale_items(spark, *rows) if rows else empty_state(spark)
        return ST.stale_report_statistics(table, total).first()

    row = report(
        10, {"id": "1", "months_stale": 12}, {"id": "2", "months_stale": 18},
        {"id": "3", "months_stale": 24, "category": "Tool"},
    )
    assert (row["total_stale"], row["percentage_of_total"], row["average_months_stale"]) == (3, 30.0, 18.0)
    assert row["by_category"] == {"Theme": 2, "Tool": 1}
    assert report(0, {"id": "1", "months_stale": 1})["percentage_of_total"] == 0.0
    row = report(
        10, {"id": "1", "months_stale": 12}, {"id": "2", "months_stale": 15},
        {"id": "3", "months_stale": 99, "hidden": True},
    )
    assert (row["total_stale"], row["average_months_stale"]) == (2, 13.5)
    assert report(3, {"id": "1", "months_stale": 1})["percentage_of_total"] == 33.3
    row = report(5)
    assert (row["total_stale"], row["percentage_of_total"], row["average_months_stale"], row["by_category"]) == (
        0, 0.0, 0.0, {},
    )
    assert report(4, {"id": "1", "months_stale": 1, "category": ""})["by_category"] == {"Other": 1}


def test_statistics_rounding(spark):
    rows = [{"id": str(i), "months_stale": m} for i, m in enumerate((13, 13, 14))]
    assert ST.stale_statistics(stale_items(spark, *rows)).first()["average_months_stale"] == 13.3
    assert ST.stale_statistics(empty_state(spark)).first()["average_months_stale"] == 0.0


def test_order_and_category_filter(spark):
    table = stale_items(
        spark, {"id": "1", "stars": 1}, {"id": "2", "stars": 9}, {"id": "3", "stars": 5, "category": "Official"}
    )
    assert [r["id"] for r in ST.stale_order(table).collect()] == ["3", "2", "1"]
    assert [r["id"] for r in ST.stale_by_category(table, "Theme").collect()] == ["2", "1"]


def test_reconcile(spark):
    table = stale_items(spark, {"id": "1", "months_stale": 20}, {"id": "2", "months_stale": 30, "category": "Tool"})
    assert ST.reconcile_statistics(table, ST.stale_statistics(table)).count() == 0
    stored = spark.createDataFrame(
        [(3, 25.2, {"Theme": 1})], "total_stale bigint, average_months_stale double, by_category map<string,bigint>"
    )
    found = {(r["severity"], r["message"]) for r in ST.reconcile_statistics(table, stored).collect()}
    assert found == {
        ("error", "Statistics mismatch: totalStale=3, actual count=2"),
        ("error", "Category count mismatch for Tool: stats=undefined, actual=1"),
        ("warning", "Average months stale mismatch: stats=25.2, expected=25.0"),
    }


def test_leap_day_goes_to_march(spark):
    row = spark.range(1).select(
        two_years_before(datetime(2024, 2, 29)).alias("leap"), two_years_before(datetime(2025, 2, 28)).alias("plain")
    ).first()
    assert (row["leap"], row["plain"]) == (datetime(2022, 3, 1), datetime(2023, 2, 28))


dates = st.datetimes(min_value=datetime(2000, 1, 1), max_value=datetime(2040, 1, 1))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pushed=st.lists(dates, min_size=1, max_size=30), stored=st.sets(st.integers(0, 40), max_size=12))
def test_states_partition_the_input(spark, pushed, stored):
    seen = items(spark, *[{"id": str(i), "pushed_at": p} for i, p in enumerate(pushed)])
    state = empty_state(spark)
    if stored:
        state = stale_items(
            spark, *[{"id": str(i), "months_stale": 20, "stale_detected_at": datetime(2025, 1, 1)} for i in stored]
        )
    rows = ST.detect_staleness(seen.repartition(3), state, AS_OF).collect()
    got = {r["id"]: r["state"] for r in rows}
    assert len(rows) == len(got) == len(set(map(str, stored)) | {str(i) for i in range(len(pushed))})
    for i, p in enumerate(pushed):
        months = max(0, (AS_OF.year - p.year) * 12 + AS_OF.month - p.month)
        want = {
            (True, True): "still_stale", (True, False): "newly_stale", (False, True): "reactivated",
            (False, False): "active",
        }[(months > 12, i in stored)]
        assert got[str(i)] == want
    assert {i for i, s in got.items() if s == "remaining"} == {str(i) for i in stored if i >= len(pushed)}


def test_months_stale_matches_plain_arithmetic(spark):
    pushed = [datetime(y, m, d) for y in (2019, 2024, 2026) for m in (1, 4, 12) for d in (1, 28)]
    rows = spark.createDataFrame([(p,) for p in pushed], "p timestamp").select(
        "p", months_stale("p", AS_OF).alias("m")
    ).collect()
    for r in rows:
        assert r["m"] == max(0, (2026 - r["p"].year) * 12 + 4 - r["p"].month)
