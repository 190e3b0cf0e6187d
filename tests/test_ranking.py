from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gleanery.functions import ranking as R


def groups(spark, n=5000):
    # Two thirds of the rows in one group, many ties, a null group.
    return spark.range(n).select(
        "id",
        F.when(F.col("id") % 3 != 0, "hot").when(F.col("id") % 2 == 0, F.lit(None)).otherwise("cold").alias("g"),
        (F.col("id") % 17).alias("v"),
    )


@pytest.mark.parametrize("small", [R.SMALL_TABLE_ROWS, 0])
def test_numbering_equals_a_window(spark, monkeypatch, small):
    monkeypatch.setattr(R, "SMALL_TABLE_ROWS", small)
    df = groups(spark).repartition(6)
    order = [F.desc("v"), F.asc("id")]
    got = {(r["id"], r["rank"]) for r in R.number_rows(df, ["g"], order).collect()}
    window = Window.partitionBy("g").orderBy(*order)
    want = {(r["id"], r["rank"]) for r in df.withColumn("rank", F.row_number().over(window)).collect()}
    assert got == want and len(got) == 5000


def test_numbering_writes_ids_only_and_splits_a_hot_group(spark, monkeypatch):
    written, keep = [], R.materialize
    monkeypatch.setattr(R, "materialize", lambda df: written.append(keep(df)) or written[-1])
    wide = groups(spark, 50_000).withColumn("text", F.repeat(F.col("id").cast("string"), 50)).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = R.number_rows(wide, ["g"], [F.desc("v"), F.asc("id")])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    (table,) = written
    assert table.columns == ["_id", "g", "_slot"] and ranked.columns == [*wide.columns, "rank"]
    hot = table.where("g = 'hot'").groupBy(F.shiftright("_slot", 33)).count().collect()
    assert len(hot) >= 4 and max(r["count"] for r in hot) < 0.5 * sum(r["count"] for r in hot)


def test_numbering_of_nothing(spark):
    assert R.number_rows(groups(spark).limit(0), ["g"], [F.asc("id")]).count() == 0


def test_first_and_top_are_pruned_before_the_shuffle(spark):
    for df in (
        R.first_per_key(groups(spark), ["g"], [F.asc("id")]),
        R.top_k_per_key(groups(spark), ["g"], [F.asc("id")], 3),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        before_shuffle = plan[plan.index("Exchange"):]
        assert "WindowGroupLimit" in before_shuffle


def test_scratch_folder_comes_from_the_session(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert before is None or R.scratch_root(spark) == before.rstrip("/")


def test_materialized_table_keeps_rows_and_prunes_columns(spark):
    table = R.materialize(groups(spark))
    assert table.count() == 5000
    plan = table.select("v")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<v:bigint>" in plan
