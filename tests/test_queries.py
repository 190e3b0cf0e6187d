from __future__ import annotations

import os
import re

import pytest

from checks.all_queries import QUERIES, SQL
from checks.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="generated tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def check_shape(plan: str, name: str) -> None:
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CollectLimit" not in plan
    python = re.findall(r"(ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas)", plan)
    assert not python
    # Scans read the columns of the query, never a whole wide table by accident.
    for schema in re.findall(r"lineitem.parquet.*?ReadSchema: struct<([^>]*)>", plan):
        assert schema.count(":") <= 4


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql_and_a_sound_plan(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    check_shape(plan_of(df), name)
    status, _ = compare(df, con, name)
    assert status == ("ok" if name in SQL else "no SQL")


def test_order_date_filter_reaches_the_scan(spark):
    plan = plan_of(QUERIES["months_stale"](spark, FOLDER))
    assert re.search(r"PushedFilters: \[[^\]]*LessThanOrEqual\(o_orderdate", plan)


def test_entry(spark):
    import __spark_entry__ as E

    assert set(E.oracle_sql()) <= set(E.queries())
    assert E.entry(spark).count() == 1
