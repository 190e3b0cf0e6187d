from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query
from gleanery.operators import merge as M
from gleanery.sources import sample_tables as S

BACK = 60
TOPICS = ("building", "machin")
OWNER = "automobile"


def _snapshots(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The catalog five years back, and what is seen of it now."""
    now, before = S.reference_dates(spark, folder, BACK)
    return S.catalog(spark, folder, before), S.catalog(spark, folder, now).filter(~F.col("archived"))


def _outcomes(spark: SparkSession, folder: str) -> DataFrame:
    old, new = _snapshots(spark, folder)
    return M.merge_outcomes(
        old, new, S.overrides(spark, folder), S.rules(spark, folder), topics=TOPICS, owner=OWNER
    )


def merge_sql(old: str, new: str) -> str:
    """CTEs from ``old`` and ``new`` item queries up to ``merged``."""
    rule = S.RULE_MATCH_SQL.format(r="repo")
    return f"""
old_raw AS ({old}),
new_raw AS ({new}),
old_items AS ({S.OVERRIDDEN_SQL.format(items='SELECT * FROM old_raw')}),
new_items AS ({S.OVERRIDDEN_SQL.format(items='SELECT * FROM new_raw')}),
merged AS (
  SELECT *, {rule} IS NOT NULL AS ruled,
    CASE WHEN seen AND {rule} IS NOT NULL THEN 'ignored' WHEN seen AND hidden THEN 'hidden'
         WHEN seen AND old_stars IS NOT NULL THEN 'updated' WHEN seen THEN 'added'
         WHEN {rule} IS NOT NULL THEN 'removed_rule'
         WHEN len(list_filter(topics, lambda t: contains(lower(t), 'building') OR contains(lower(t), 'machin'))) = 0
              AND NOT starts_with(lower(repo), 'automobile/') AND score < 50 THEN 'removed_invalid'
         ELSE 'kept' END AS outcome
  FROM (
    SELECT n.*, true AS seen, o.stars AS old_stars, o.score AS old_score FROM new_items n LEFT JOIN old_items o USING (id)
    UNION ALL BY NAME
    SELECT o.*, false AS seen, NULL AS old_stars, NULL AS old_score FROM old_items o
    WHERE o.id NOT IN (SELECT id FROM new_items))),
changes AS (
  SELECT CASE WHEN outcome IN ('added', 'updated') THEN outcome WHEN outcome IN ('ignored', 'hidden') THEN 'ignored'
              ELSE 'removed' END AS type, repo,
    CASE outcome WHEN 'ignored' THEN 'Repository matches ignore rules'
      WHEN 'hidden' THEN 'Repository hidden by override rules'
      WHEN 'updated' THEN 'Updated: stars ' || old_stars || ' → ' || stars || ', score ' || old_score || ' → ' || score
      WHEN 'added' THEN 'Added: ' || category || ' with ' || stars || ' stars, score ' || score
      WHEN 'removed_rule' THEN 'Existing item removed: matches ignore rules'
      ELSE 'Existing item removed: no Ghost topic (topics: ["' || array_to_string(topics, '","') || '"]) and score '
           || score || ' < 50' END AS details
  FROM merged WHERE outcome <> 'kept')"""


CTE = f"""
WITH {S.ASOF_SQL}, {merge_sql(S.catalog_sql(BACK), f'SELECT * FROM ({S.catalog_sql(0)}) WHERE NOT archived')}
"""


@query("merge_outcomes", f"{CTE} SELECT repo, outcome FROM merged")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _outcomes(spark, folder).select("repo", "outcome")


@query(
    "merge_catalog",
    f"""{CTE} SELECT repo, name, category, stars, array_to_string(tags, ',') AS tags, score, notes, hidden,
              strftime(pushed_at, '%Y-%m-%d') AS pushed_on FROM merged WHERE outcome IN ('added', 'updated', 'kept')""",
)
def merge_catalog(spark: SparkSession, folder: str) -> DataFrame:
    return M.merged_items(_outcomes(spark, folder)).select(
        "repo", "name", "category", "stars", F.array_join("tags", ",").alias("tags"), "score", "notes", "hidden",
        F.date_format("pushed_at", "yyyy-MM-dd").alias("pushed_on"),
    )


@query("change_log", f"{CTE} SELECT * FROM changes")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return M.change_log(_outcomes(spark, folder))


@query(
    "change_stats",
    f"""{CTE} SELECT count(*) FILTER (type = 'added') AS added, count(*) FILTER (type = 'updated') AS updated,
              count(*) FILTER (type = 'removed') AS removed, count(*) FILTER (type = 'ignored') AS ignored FROM changes""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return M.change_stats(_outcomes(spark, folder))


@query(
    "valid_existing",
    f"""SELECT id, (lower(category) = 'theme' OR lower(repo) LIKE 'machinery/%' OR lower(repo) LIKE 'automobile/%'
                    OR score >= 50) AS valid FROM ({S.CUSTOMER_ITEMS_SQL})""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    items = S.customer_items(S.table(spark, folder, "customer"), S.table(spark, folder, "nation"))
    return items.select("id", M.valid_existing(topics=TOPICS, owner=OWNER).alias("valid"))


@query(
    "compare_snapshots",
    f"""WITH {S.ASOF_SQL}, o AS ({S.catalog_sql(BACK)}), n AS (SELECT * FROM ({S.catalog_sql(0)}) WHERE NOT archived)
        SELECT coalesce(n.id, o.id) AS id,
          CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed'
               WHEN o.stars <> n.stars THEN 'updated' ELSE 'unchanged' END AS status, o.stars AS old_stars, n.stars AS new_stars
        FROM o FULL OUTER JOIN n ON o.id = n.id""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = M.compare_snapshots(*_snapshots(spark, folder))
    return found.select("id", "status", F.col("old.stars").alias("old_stars"), F.col("new.stars").alias("new_stars"))


def _repos(spark: SparkSession, folder: str) -> DataFrame:
    _, new = _snapshots(spark, folder)
    return new.select(
        "id", "name", F.col("repo").alias("full_name"), F.col("url").alias("html_url"), "description",
        F.col("stars").alias("stargazers_count"), "pushed_at", "archived", "fork",
        F.struct(F.col("license").alias("key")).alias("license"), "topics",
        F.struct(F.split_part("repo", F.lit("/"), F.lit(1)).alias("login")).alias("owner"), "score", "confidence", "hidden",
    )


@query(
    "merge_classified",
    f"""WITH {S.ASOF_SQL}, {merge_sql(
        S.catalog_sql(BACK),
        f"SELECT * REPLACE ('Theme' AS category, NULL AS notes, false AS hidden) FROM ({S.catalog_sql(0)}) WHERE NOT archived")}
        SELECT repo, CASE WHEN seen AND NOT ruled AND score < 20 THEN 'unclassified' ELSE outcome END AS outcome FROM merged""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    old, _ = _snapshots(spark, folder)
    repos = _repos(spark, folder)
    classified = repos.filter("score >= 20").select("full_name", "score", "confidence")
    outcomes = M.merge_classified(
        old, repos.drop("score", "confidence", "hidden"), classified, S.overrides(spark, folder),
        S.rules(spark, folder), topics=TOPICS, owner=OWNER,
    )
    return outcomes.select("repo", "outcome")




@query(
    "to_item",
    f"""WITH {S.ASOF_SQL} SELECT id, repo, 'Theme' AS category, array_to_string(topics, ',') AS tags, nullif(license, '') AS license,
               stars, score, false AS hidden FROM ({S.catalog_sql(0)}) WHERE NOT archived""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    from gleanery.operators.hits import to_item

    return to_item(_repos(spark, folder)).select(
        "id", "repo", "category", F.array_join("tags", ",").alias("tags"), "license", "stars", "score", "hidden"
    )


@query(
    "to_item_categorized",
    """SELECT p_partkey, CASE WHEN p_brand = 'Brand#7' THEN 'Official'
              WHEN p_size > 40 OR p_size < 3 THEN 'Tool' WHEN p_type = 'LARGE' THEN 'Starter' ELSE 'Theme' END AS category
       FROM part""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    from gleanery.operators.hits import to_item_categorized

    size = F.col("p_size")
    parts = S.table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("full_name"),
        F.when(size > 40, F.lit("ToolBox")).otherwise(F.col("p_name")).alias("name"),
        F.lit("https://x.example/").alias("html_url"),
        F.when(size < 3, F.lit("A TOOL")).otherwise(F.lit(None)).alias("description"),
        F.lit(1).cast("long").alias("stargazers_count"),
        F.lit(None).cast("timestamp").alias("pushed_at"),
        F.lit(False).alias("archived"),
        F.lit(False).alias("fork"),
        F.struct(F.lit("mit").alias("key")).alias("license"),
        # "TOOL" in a topic does not count: topics are compared as written.
        F.when(F.col("p_type") == "LARGE", F.array(F.lit("my-starter")))
        .otherwise(F.array(F.lit("TOOL"))).alias("topics"),
        F.struct(F.col("p_brand").alias("login")).alias("owner"),
        F.lit(1).alias("score"),
        F.lit("low").alias("confidence"),
    )
    found = to_item_categorized(parts, official_owner="brand#7")
    return found.select(F.col("id").cast("long").alias("p_partkey"), "category")
