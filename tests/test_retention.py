from __future__ import annotations

from gleanery.operators import retention as T
from tests.conftest import by

TTL, NOW = 1000, 10_000
SCHEMA = "key string, length bigint, ts_ms bigint, valid boolean"


def entries(spark):
    return spark.createDataFrame(
        [("a", 10, 9500, True), ("a", 11, 9900, True), ("b", 20, 9000, True), ("c", 30, 8999, True), ("d", 40, None, False)],
        SCHEMA,
    )


def test_partition_is_strict(spark):
    rows = T.ttl_partition(entries(spark), NOW, TTL).collect()
    assert {(r["key"], r["status"]) for r in rows} == {
        ("a", "fresh"), ("b", "fresh"), ("c", "expired"), ("d", "invalid"),
    }
    assert {r["key"] for r in T.retained(entries(spark), NOW, TTL).collect()} == {"a", "b"}


def test_totals(spark):
    assert T.cleanup_totals(entries(spark), NOW, TTL).first().asDict() == {"deleted_files": 2, "freed_space": 70}
    assert T.clear_totals(entries(spark)).first().asDict() == {"deleted_files": 5, "freed_space": 111}
    none = entries(spark).limit(0)
    assert T.cleanup_totals(none, NOW, TTL).first().asDict() == {"deleted_files": 0, "freed_space": 0}


def test_stats(spark):
    assert T.cache_stats(entries(spark), NOW, TTL).first().asDict() == {
        "total_files": 4, "total_size": 71, "oldest_entry": 8999, "newest_entry": 9900, "expired_files": 2,
    }
    assert T.cache_stats(entries(spark).limit(0), NOW, TTL).first().asDict() == {
        "total_files": 0, "total_size": 0, "oldest_entry": NOW, "newest_entry": 0, "expired_files": 0,
    }


def test_latest(spark):
    keys = spark.createDataFrame([("a",), ("c",), ("none",)], "key string")
    found = by(T.latest_fresh(entries(spark), keys, NOW, TTL), "key")
    assert {k: (r["found"], r["ts_ms"]) for k, r in found.items()} == {
        "a": (True, 9900), "c": (False, None), "none": (False, None),
    }
