from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query
from gleanery.operators import retention as T
from gleanery.sources import sample_tables as S

TTL = S.CACHE_TTL_MS
CTE = f"""WITH e AS ({S.CACHE_SQL}), p AS (SELECT *, CASE WHEN NOT valid THEN 'invalid' WHEN now_ms - ts_ms > {TTL} THEN 'expired'
          ELSE 'fresh' END AS status FROM e)"""


def _entries(spark: SparkSession, folder: str):
    return S.cache_entries(spark, folder), S.last_event_ms(spark, folder), TTL


@query("ttl_partition", f"{CTE} SELECT event_id, status FROM p")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return T.ttl_partition(*_entries(spark, folder)).select("event_id", "status")


@query("retained", f"{CTE} SELECT event_id FROM p WHERE status = 'fresh'")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return T.retained(*_entries(spark, folder)).select("event_id")


@query(
    "cleanup_totals",
    f"""{CTE} SELECT count(*) FILTER (status <> 'fresh') AS deleted_files,
          CAST(sum(length) FILTER (status <> 'fresh') AS BIGINT) AS freed_space FROM p""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return T.cleanup_totals(*_entries(spark, folder))


@query("clear_totals", f"{CTE} SELECT count(*) AS deleted_files, CAST(sum(length) AS BIGINT) AS freed_space FROM e")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return T.clear_totals(S.cache_entries(spark, folder))


@query(
    "cache_stats",
    f"""{CTE} SELECT count(*) FILTER (valid) AS total_files, CAST(sum(length) FILTER (valid) AS BIGINT) AS total_size,
          least(min(ts_ms) FILTER (valid), any_value(now_ms)) AS oldest_entry, max(ts_ms) FILTER (valid) AS newest_entry,
          count(*) FILTER (status <> 'fresh') AS expired_files FROM p""",
)
def cache_stats(spark: SparkSession, folder: str) -> DataFrame:
    return T.cache_stats(*_entries(spark, folder))


@query(
    "latest_fresh",
    f"""{CTE} SELECT CAST(c_custkey AS VARCHAR) AS key, m.key IS NOT NULL AS found, m.ts_ms AS ts_ms
        FROM customer LEFT JOIN (SELECT key, max(ts_ms) AS ts_ms FROM p WHERE status = 'fresh' GROUP BY key) m
          ON m.key = CAST(c_custkey AS VARCHAR)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    entries, now, ttl = _entries(spark, folder)
    keys = S.table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("key"))
    return T.latest_fresh(entries, keys, now, ttl).select("key", "found", "ts_ms")
