"""Run registered queries in Spark and in DuckDB and compare the rows.

    python -m checks.compare [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.all_queries import QUERIES, SQL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def session(cpus: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gleanery")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, bool) or value is None:
        return value
    if hasattr(value, "isoformat"):
        return str(value)
    return value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df: DataFrame, con, name: str) -> tuple[str, int]:
    """Run one query's frame and its SQL: "ok", "no SQL" or what differs."""
    got = df.collect()
    if name not in SQL:
        return "no SQL", len(got)
    cur = con.execute(SQL[name])
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"COLUMNS {sorted(df.columns)} / {sorted(names)}", len(got)
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a == b:
        return "ok", len(got)
    in_a, in_b = set(a), set(b)
    only_a = [r for r in a if r not in in_b][:3]
    only_b = [r for r in b if r not in in_a][:3]
    return f"DIFF rows {len(a)}/{len(b)} {sorted(df.columns)}\n   spark {only_a}\n   duck  {only_b}", len(got)


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con, bad = session(), duck(folder), 0
    for name in names:
        start = time.time()
        try:
            status, n = compare(QUERIES[name](spark, folder), con, name)
        except Exception as problem:  # noqa: BLE001 - report and go on
            status, n = f"ERROR {type(problem).__name__}: {str(problem)[:900]}", 0
        bad += status not in ("ok", "no SQL")
        print(f"{name:28s} {n:7d} rows {time.time() - start:6.2f}s  {status}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
