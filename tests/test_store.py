"""Runs over several tables: one commit, trying again after each step, states as changes."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gleanery.operators import deltas
from gleanery.schemas import STALE_ITEM
from gleanery.sources import store as ST
from gleanery.sources.store import ConcurrentRun, Store, Table
from tests.conftest import stale_items

FIRST, SECOND, THIRD = datetime(2026, 1, 1), datetime(2026, 2, 1), datetime(2026, 3, 1)
ROWS = "id long, x string"


def numbers(spark, *rows):
    return spark.createDataFrame(list(rows), ROWS)


def both(spark, *rows):
    table = numbers(spark, *rows)
    return {"catalog": Table(table), "state": Table(table, key="id")}


def content(store, name):
    return sorted(tuple(r) for r in store.read(name, numbers(store.spark).schema).collect())


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


class Lost(RuntimeError):
    pass


@pytest.mark.parametrize("step", [0, 1, 2])
def test_a_run_that_fails_at_any_step_can_be_run_again(spark, store, monkeypatch, step):
    store.save(FIRST, both(spark, (1, "a"), (2, "b")), after=0)
    steps, write, commit = [], Store._write, Store._commit

    def failing(real):
        def run(self, *args):
            if len(steps) == step:
                raise Lost
            steps.append(1)
            return real(self, *args)

        return run

    monkeypatch.setattr(Store, "_write", failing(write))
    monkeypatch.setattr(Store, "_commit", failing(commit))
    tables = both(spark, (2, "c"), (3, "d"))
    with pytest.raises(Lost):
        store.save(SECOND, tables, after=1)
    # Readers see both tables of the run before.
    assert content(store, "catalog") == content(store, "state") == [(1, "a"), (2, "b")]
    monkeypatch.undo()
    run = store.save(SECOND, tables, after=1)
    assert (run.number, run.version) == (2, "20260201T000000")
    assert content(store, "catalog") == content(store, "state") == [(2, "c"), (3, "d")]
    assert len(store.unused()) == step
    # Once more: nothing is written, the same run comes back.
    assert store.save(SECOND, both(spark, (9, "z")), after=1) == run and content(store, "state") == [(2, "c"), (3, "d")]


def test_old_runs_stay_readable_and_other_tables_stay(spark, store):
    first = store.save(FIRST, both(spark, (1, "a")))
    second = store.save(SECOND, {"state": Table(numbers(spark, (1, "b")), key="id")}, after=1)
    schema = numbers(spark).schema
    assert [r.x for r in store.read("state", schema, first).collect()] == ["a"]
    assert second.tables["catalog"] == first.tables["catalog"] and store.numbers() == [1, 2]


def test_only_one_of_two_runs_is_committed(spark, store, monkeypatch):
    store.save(FIRST, both(spark, (1, "a")))
    store.save(SECOND, both(spark, (2, "b")), after=1)
    with pytest.raises(ConcurrentRun):
        store.save(THIRD, both(spark, (3, "c")), after=1)
    # The other one takes the number just before this one commits.
    commit, late = Store._commit, []

    def beaten(self, run):
        if not late:
            late.append(run)
            Store(spark, store.root).save(datetime(2026, 5, 1), both(spark, (5, "e")), after=2)
        return commit(self, run)

    monkeypatch.setattr(Store, "_commit", beaten)
    with pytest.raises(ConcurrentRun):
        store.save(THIRD, both(spark, (3, "c")), after=2)
    assert content(store, "catalog") == content(store, "state") == [(5, "e")]


def test_changes_are_what_differs(spark):
    before = numbers(spark, (1, "same"), (2, "old"), (3, "gone"), (4, None), (6, None))
    after = numbers(spark, (1, "same"), (2, "new"), (4, None), (5, "more"), (6, "x"))
    found = sorted(tuple(r) for r in deltas.changes(before, after).collect())
    assert found == [("drop", 3, None), ("put", 2, "new"), ("put", 5, "more"), ("put", 6, "x")]


def test_a_run_writes_in_proportion_to_its_changes(spark, store):
    rows = spark.range(20_000).select("id", F.concat(F.lit("x"), F.col("id")).alias("x"))
    store.save(FIRST, {"state": Table(rows, key="id")})
    moved = rows.where("id <> 7").withColumn("x", F.when(F.col("id") == 11, "new").otherwise(F.col("x")))
    run = store.save(SECOND, {"state": Table(moved, key="id")})
    (change,) = run.tables["state"].changes
    written = spark.read.parquet(f"{store.root}/{change}").select("op", "id", "x")
    assert sorted(tuple(r) for r in written.collect()) == [("drop", 7, None), ("put", 11, "new")]
    schema = rows.schema
    assert store.read("state", schema).exceptAll(moved).count() == 0 == moved.exceptAll(store.read("state", schema)).count()


def test_many_changes_become_a_new_base(spark, store, monkeypatch):
    monkeypatch.setattr(ST, "MOST_CHANGES", 2)
    for month in range(1, 7):
        rows = numbers(spark, (month, "own"), (0, f"month {month}"), *[(-1, "back")] * (month % 2))
        run = store.save(datetime(2026, month, 1), {"state": Table(rows, key="id")}, after=month - 1)
        assert content(store, "state") == sorted(tuple(r) for r in rows.collect())
        assert len(run.tables["state"].changes) == (month - 1) % 3


def test_an_empty_partitioned_state(spark, store):
    table = stale_items(spark, {"id": "1", "months_stale": 20}, {"id": "2", "category": "Tool"})
    for k, (when, rows) in enumerate([(FIRST, table.limit(0)), (SECOND, table), (THIRD, table.limit(0))]):
        store.save(when, {"state": Table(rows, key="id", partition_by=("category",))}, after=k)
        assert store.read("state", STALE_ITEM).count() == [0, 2, 0][k]
