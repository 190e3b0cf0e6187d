from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query
from gleanery.operators import quality as Q
from gleanery.sources import sample_tables as S

CTE = f"""WITH items AS ({S.RAW_ITEMS_SQL}),
v AS (SELECT *, regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*:') AS url_ok FROM items)"""

_FIRST = """CASE WHEN stars < 0 THEN 'stars must be a non-negative number'
  WHEN score < 0 OR score > 100 THEN 'score must be a number between 0 and 100'
  WHEN confidence NOT IN ('high', 'medium', 'low') THEN 'confidence must be one of: high, medium, low'
  WHEN category NOT IN ('Theme', 'Tool', 'Starter', 'Official') THEN 'category must be one of: Theme, Tool, Starter, Official'
  WHEN pushed_at = 'soon' THEN 'pushedAt must be a valid ISO date string' END"""


@query("strict_first_error", f"{CTE} SELECT id, {_FIRST} AS error FROM items")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return Q.validate_items(S.raw_items(spark, folder)).select("id", "error")


@query(
    "consistency_errors",
    f"""{CTE}
  SELECT id, 'error' AS severity, 'url_format' AS rule, 'Item ' || id || ' has invalid URL: ' || url AS message FROM v WHERE NOT url_ok
  UNION ALL SELECT id, 'warning', 'description', 'Item ' || id || ' missing description' FROM v WHERE coalesce(description, '') = ''
  UNION ALL SELECT id, 'warning', 'category_value', 'Item ' || id || ' has non-standard category: ' || category FROM v
    WHERE category NOT IN ('Theme', 'Tool', 'Starter', 'Official')
  UNION ALL SELECT id, 'error', 'stars', 'Item ' || id || ' has invalid stars count: ' || stars FROM v WHERE stars < 0
  UNION ALL SELECT id, 'error', 'score', 'Item ' || id || ' has invalid score: ' || score FROM v WHERE score < 0 OR score > 100
  UNION ALL SELECT id, 'error', 'confidence', 'Item ' || id || ' has invalid confidence: ' || confidence FROM v
    WHERE confidence NOT IN ('high', 'medium', 'low')""",
)
def consistency_errors(spark: SparkSession, folder: str) -> DataFrame:
    return Q.consistency_errors(S.raw_items(spark, folder))


@query(
    "consistency_stats",
    f"""{CTE} SELECT count(*) AS total_items, count(*) FILTER (url_ok) AS valid_urls, count(*) FILTER (NOT url_ok) AS invalid_urls,
          count(*) FILTER (coalesce(description, '') = '') AS missing_descriptions, 0::BIGINT AS missing_categories FROM v""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return Q.consistency_stats(S.raw_items(spark, folder))


def _broken_inputs(spark: SparkSession, folder: str):
    overrides = S.overrides(spark, folder).withColumn(
        "repo", F.when(F.col("category").isNotNull(), F.lit("")).otherwise(F.col("repo"))
    )
    specs = S.table(spark, folder, "part").select(
        F.col("p_partkey").cast("int").alias("query_pos"),
        F.when(F.col("p_size") == 50, F.lit("")).otherwise(F.col("p_name")).alias("query"),
        (F.col("p_size") - 2).alias("max_results"),
        (F.col("p_size") - 3).alias("min_stars"),
    )
    return S.raw_items(spark, folder), overrides, S.rules(spark, folder), specs


@query(
    "validate_all",
    f"""{CTE}
  SELECT 'items' AS source, id AS row_key, {_FIRST} AS error FROM items WHERE {_FIRST} IS NOT NULL
  UNION ALL SELECT 'overrides', CAST(c_custkey AS VARCHAR), 'repo is required and must be a string' FROM customer
    WHERE c_acctbal > 8000 AND c_nationkey < 5
  UNION ALL SELECT 'rules', '1', 'patterns[1] must be a valid regex pattern'
  UNION ALL SELECT 'sources', CAST(p_partkey AS VARCHAR), CASE WHEN p_size = 50 THEN 'query is required and must be a string'
    WHEN p_size <= 2 THEN 'maxResults must be a positive number' END FROM part WHERE p_size = 50 OR p_size <= 2""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return Q.validate_all(*_broken_inputs(spark, folder))


@query(
    "validate_state",
    f"""WITH s AS ({S.DUP_ITEMS_SQL}), p AS (SELECT s.*, p_size, p_partkey FROM s JOIN part ON id = CAST(p_partkey AS VARCHAR))
  SELECT 'error' AS severity, 'tags' AS "check", 'Invalid JSON in tags for item ' || id AS message FROM p WHERE p_size = 7
  UNION ALL SELECT 'error', 'required', 'Item missing required fields: ' || id FROM p WHERE p_size = 9
  UNION ALL SELECT 'error', 'stale_detected_at', 'Item missing staleDetectedAt: ' || id FROM p WHERE p_size = 11
  UNION ALL SELECT 'error', 'months_stale', 'Item has invalid monthsStale: ' || id FROM p WHERE p_size < 5
  UNION ALL SELECT 'error', 'negative', 'Found ' || count(*) || ' items with negative numeric values' FROM p WHERE p_size < 5 HAVING count(*) > 0""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("stars")
    state = S.dup_items(spark, folder).withColumns(
        {
            "tags": F.when(size == 7, F.lit("[broken")).otherwise(F.to_json("tags")),
            "name": F.when(size == 9, F.lit("")).otherwise(F.col("name")),
            "stale_detected_at": F.when(size != 11, F.col("pushed_at")),
            "months_stale": (size - 5).cast("int"),
        }
    )
    return Q.validate_state(state)


_PATTERNS = (
    ("title", r"(?i)<title>.*the.*</title>", "Title"),
    ("article", r"(?i)<ARTICLE>", "Article"),
)


@query(
    "page_lint",
    r"""WITH t AS (SELECT page_id, html, len(regexp_extract_all(html, '<[^/][^>]*>')) AS open_tags,
             len(regexp_extract_all(html, '</[^>]*>')) AS close_tags,
             regexp_matches(html, '(?i)<title>.*the.*</title>') AS a, regexp_matches(html, '(?i)<ARTICLE>') AS b,
             contains(html, 'table') OR contains(html, 'average') AS s, contains(html, 'footer') AS l0, contains(html, '/the') AS l1 FROM pages)
        SELECT page_id, a AS has_title, b AS has_article, s AS has_statistics, open_tags, close_tags, l0 AS links_0, l1 AS links_1,
          abs(open_tags - close_tags) <= 10 AS balanced,
          concat_ws('|', CASE WHEN NOT a THEN 'Title not found in HTML' END, CASE WHEN NOT b THEN 'Article not found in HTML' END,
            CASE WHEN NOT s THEN 'Statistics display not found in HTML' END,
            CASE WHEN abs(open_tags - close_tags) > 10 THEN 'HTML tag mismatch: ' || open_tags || ' open tags, ' || close_tags || ' close tags' END,
            CASE WHEN NOT l0 THEN 'Link to footer not found' END, CASE WHEN NOT l1 THEN 'Link to /the not found' END) AS warnings FROM t""",
)
def page_lint(spark: SparkSession, folder: str) -> DataFrame:
    found = Q.page_lint(
        S.table(spark, folder, "pages").select("page_id", "html"),
        patterns=_PATTERNS, statistics_words=("table", "average"), links=("footer", "/the"),
    )
    counts = {c: F.col(c).cast("long") for c in ("open_tags", "close_tags")}
    return found.withColumns({**counts, "warnings": F.array_join("warnings", "|")}).drop("html")
