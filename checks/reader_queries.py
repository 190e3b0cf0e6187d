"""The parsing half of the readers, fed from the generated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query
from gleanery.sources import readers as R
from gleanery.sources import sample_tables as S


@query(
    "hits_from_pages",
    """SELECT c_nationkey AS query_pos, 1 AS page, c_name AS full_name, c_acctbal AS stars,
              row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS hit_pos FROM customer""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as the hits on one page for each nation."""
    hit = F.struct("c_custkey", F.col("c_name").alias("full_name"), F.col("c_acctbal").alias("stars"))
    pages = S.table(spark, folder, "customer").groupBy(F.col("c_nationkey").alias("query_pos"))
    pages = pages.agg(F.lit(1).alias("page"), F.array_sort(F.collect_list(hit)).alias("items"))
    return R.hits_from_pages(pages).drop("c_custkey")


@query("readme_text", "SELECT CAST(doc_id AS VARCHAR) AS full_name, text FROM documents")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Every document, wrapped into base64 with a line break in it."""
    wrapped = F.base64(F.encode("text", "UTF-8"))
    wrapped = F.concat(F.substring(wrapped, 1, 10), F.lit("\n"), F.substring(wrapped, F.lit(11), F.length(wrapped)))
    readmes = S.table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("full_name"), wrapped.alias("content"))
    return R.text_from_base64(readmes)


@query(
    "listing_entries",
    """SELECT 'r/' || l_orderkey AS full_name, 'src/' || l_linenumber AS path, CAST(l_linenumber AS VARCHAR) AS name,
              CASE WHEN l_returnflag = 'A' THEN 'dir' ELSE 'file' END AS type FROM lineitem""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as the entries of one listing for each order."""
    name = F.col("l_linenumber").cast("string")
    kind = F.when(F.col("l_returnflag") == "A", "dir").otherwise("file")
    entry = F.struct(name.alias("name"), F.concat(F.lit("src/"), name).alias("path"), kind.alias("type"))
    listings = S.table(spark, folder, "lineitem").groupBy(F.concat(F.lit("r/"), "l_orderkey").alias("full_name"))
    return R.entries_from_listings(listings.agg(F.collect_list(entry).alias("entries")))


@query(
    "rule_rows",
    """SELECT row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_name) - 1 AS pos, 'exact' AS kind, c_name AS value FROM customer
       UNION ALL
       SELECT row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_name) - 1, 'pattern', '^' || c_name || '$' FROM customer""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as one rule file for each segment."""
    names = F.array_sort(F.collect_list("c_name"))
    files = S.table(spark, folder, "customer").groupBy("c_mktsegment").agg(names.alias("repos"))
    patterns = F.transform("repos", lambda n: F.concat(F.lit("^"), n, F.lit("$")))
    return R.rules_from_files(files.select("repos", patterns.alias("patterns")))


@query(
    "cache_files",
    """SELECT CAST(event_id AS VARCHAR) AS key, 23 + length(CAST(event_id AS VARCHAR)) + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS length,
              CASE WHEN event_id % 7 <> 0 THEN event_id END AS ts_ms, event_id % 7 <> 0 AS valid FROM events""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Events as cache files; one in seven ends in a byte that is not UTF-8."""
    number = F.col("event_id").cast("string")
    text = F.encode(F.concat(F.lit('{"timestamp": '), number, F.lit(', "d": 1}')), "UTF-8")
    content = F.when(F.col("event_id") % 7 == 0, F.concat(text, F.unhex(F.lit("FF")))).otherwise(text)
    files = S.table(spark, folder, "events").select(
        F.concat(F.lit("/cache/"), number, F.lit(".json")).alias("path"), F.octet_length(content).alias("length"), content.alias("content")
    )
    return R.entries_from_files(files).select("key", "length", "ts_ms", "valid")
