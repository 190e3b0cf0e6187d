from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query
from gleanery.operators import reports as R
from gleanery.profiles import UseCase
from gleanery.sources import sample_tables as S

CTE = f"WITH {S.ASOF_SQL}, items AS ({S.catalog_sql(0)}), shown AS (SELECT * FROM items WHERE NOT hidden)"
_HEADING = """CASE category WHEN 'Official' THEN 'OFFICIAL / TRYGHOST THEMES' WHEN 'Theme' THEN 'HIGHLY POPULAR COMMUNITY THEMES'
  WHEN 'Tool' THEN 'TOOLS & RESOURCES' WHEN 'Starter' THEN 'STARTER & DEVELOPMENT THEMES' ELSE upper(category) || ' THEMES' END"""
_RANK = "CASE category WHEN 'Official' THEN 1 WHEN 'Theme' THEN 2 WHEN 'Tool' THEN 3 WHEN 'Starter' THEN 4 ELSE 5 END"


def _items(spark: SparkSession, folder: str) -> DataFrame:
    now, _ = S.reference_dates(spark, folder, 0)
    return S.catalog(spark, folder, now)


@query(
    "catalog_summary",
    f"""{CTE} SELECT count(*) AS total_items, CAST(sum(stars) AS BIGINT) AS total_stars,
          (SELECT string_agg(category || '=' || n, ',' ORDER BY category) FROM (SELECT category, count(*) AS n FROM shown GROUP BY 1))
            AS category_counts FROM shown""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    counts = F.transform(F.map_entries("category_counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return R.catalog_summary(_items(spark, folder)).withColumn("category_counts", F.array_join(counts, ","))


@query("top_by_stars", f"{CTE} SELECT id, name, stars FROM shown ORDER BY stars DESC, id LIMIT 10")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return R.top_by_stars(_items(spark, folder))


@query(
    "recently_updated",
    f"""{CTE} SELECT id, name, strftime(pushed_at, '%Y-%m-%d') AS pushed_on FROM shown
        ORDER BY pushed_at DESC, stars DESC, id LIMIT 10""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = R.recently_updated(_items(spark, folder))
    return found.select("id", "name", F.date_format("pushed_at", "yyyy-MM-dd").alias("pushed_on"))


@query(
    "category_groups",
    f"""{CTE} SELECT id, category, {_RANK} AS category_rank, {_HEADING} AS category_name,
          row_number() OVER (PARTITION BY category ORDER BY stars DESC, id) AS item_rank FROM shown""",
)
def category_groups(spark: SparkSession, folder: str) -> DataFrame:
    return R.category_groups(_items(spark, folder)).select("id", "category", "category_rank", "category_name", "item_rank")


_CASES = (
    UseCase("Cars", 5, tag_parts=("auto",), description_parts=("nation_1.",)),
    UseCase("Homes", 7, tags=("building", "household"), names=("Customer#000000003",)),
    UseCase("Furniture", 4, tags=("furniture",)),
    UseCase("Nothing", 5, tags=("no such tag",)),
)


@query(
    "use_case_lists",
    f"""{CTE}, l AS (
  SELECT *, 1 AS label_pos, 'Cars' AS label, 5 AS top FROM items WHERE contains(tags[1], 'auto') OR contains(lower(description), 'nation_1.')
  UNION ALL SELECT *, 2, 'Homes', 7 FROM items WHERE tags[1] IN ('building', 'household') OR name = 'Customer#000000003'
  UNION ALL SELECT *, 3, 'Furniture', 4 FROM items WHERE tags[1] = 'furniture')
  SELECT label_pos, label, row_number() OVER (PARTITION BY label ORDER BY stars DESC, id) AS rank, id, name,
    CASE WHEN notes IS NOT NULL THEN notes WHEN description <> '' THEN split_part(description, '.', 1) ELSE category || ' theme' END
      AS description, stars FROM l QUALIFY rank <= top""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return R.use_case_lists(_items(spark, folder), _CASES)


@query(
    "short_description",
    """SELECT doc_id, CASE WHEN n_chars % 5 = 0 THEN 'Note ' || doc_id WHEN length(split_part(text, '.', 1)) > 50
             THEN substring(text, 1, 50) || '...' WHEN text <> '' THEN split_part(text, '.', 1) ELSE lang || ' theme' END AS short
       FROM documents""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    docs = S.table(spark, folder, "documents").select(
        "doc_id", F.col("text").alias("description"), F.col("lang").alias("category"),
        F.when(F.col("n_chars") % 5 == 0, F.concat(F.lit("Note "), F.col("doc_id"))).alias("notes"),
    )
    return docs.select("doc_id", R.short_description().alias("short"))


@query(
    "directory_rows",
    f"""{CTE} SELECT id, name, url, stars, category, concat_ws('; ', nullif(description, ''), nullif(notes, '')) AS notes FROM shown""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return R.category_order(R.directory_rows(_items(spark, folder)))


@query("catalog_order", f"{CTE} SELECT id, stars FROM items")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return R.catalog_order(_items(spark, folder)).select("id", "stars")


@query(
    "run_metrics",
    """SELECT 'events' AS metric, count(*) AS n FROM events UNION ALL SELECT 'customers', count(*) FROM customer
       UNION ALL SELECT 'parts', count(*) FROM part""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return R.run_metrics(
        events=S.table(spark, folder, "events"), customers=S.table(spark, folder, "customer"), parts=S.table(spark, folder, "part")
    )
