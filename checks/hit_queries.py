from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query
from gleanery.operators import hits as H
from gleanery.sources import sample_tables as S

PAGES = 100_000

CTE = f"""
WITH hits AS ({S.HITS_SQL}),
seen AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY query_pos, full_name ORDER BY page, hit_pos) = 1),
wanted AS (SELECT * FROM seen WHERE k >= 5 AND stars >= 5),
capped AS (SELECT * FROM wanted
           QUALIFY row_number() OVER (PARTITION BY query_pos ORDER BY page, hit_pos) <= 60 + 10 * query_pos),
first_seen AS (SELECT * FROM capped
               QUALIFY row_number() OVER (PARTITION BY full_name ORDER BY query_pos, page, hit_pos) = 1)
"""


@query("first_seen_within_query", f"{CTE} SELECT query_pos, full_name, hit_pos FROM seen")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return H.first_seen_within_query(S.hits(spark, folder)).select("query_pos", "full_name", "hit_pos")


@query("include_hits", f"{CTE} SELECT query_pos, hit_pos FROM hits WHERE k >= 5 AND k <= 95")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return H.include_hits(S.hits(spark, folder), include_forks=False).select("query_pos", "hit_pos")


@query("min_stars", f"{CTE} SELECT query_pos, hit_pos, stars FROM hits WHERE stars >= 5")
def _(spark: SparkSession, folder: str) -> DataFrame:
    specs = S.search_specs(spark, folder)
    found = H.min_stars(S.hits(spark, folder), specs, H.bounds_of(specs))
    return found.select("query_pos", "hit_pos", F.col("stargazers_count").alias("stars"))


@query(
    "page_limit",
    f"""{CTE}, sizes AS (SELECT query_pos, page, count(*) AS n FROM hits GROUP BY ALL),
        bound AS (SELECT min(n) AS least FROM sizes WHERE page = 1),
        short AS (SELECT query_pos, min(page) AS last FROM sizes, bound WHERE n < least GROUP BY 1)
        SELECT h.query_pos, h.page, h.hit_pos FROM hits h LEFT JOIN short s USING (query_pos)
        WHERE s.last IS NULL OR h.page <= s.last""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = S.hits(spark, folder)
    # A page counts as full from the size of the smallest first page on.
    least = H.page_sizes(found.filter("page = 1")).agg(F.min("page_size")).first()[0]
    read = H.page_limit(found, max_pages=PAGES, full_page=least)
    return read.select("query_pos", "page", "hit_pos")


@query(
    "cap_per_query",
    f"""{CTE} SELECT query_pos, hit_pos FROM hits
        QUALIFY row_number() OVER (PARTITION BY query_pos ORDER BY page, hit_pos) <= 60 + 10 * query_pos""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    specs = S.search_specs(spark, folder)
    capped = H.cap_per_query(S.hits(spark, folder), specs, H.bounds_of(specs), max_pages=PAGES)
    return capped.select("query_pos", "hit_pos")


@query(
    "first_seen_across_queries",
    f"""{CTE} SELECT full_name, query_pos, hit_pos FROM hits
        QUALIFY row_number() OVER (PARTITION BY full_name ORDER BY query_pos, page, hit_pos) = 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return H.first_seen_across_queries(S.hits(spark, folder)).select("full_name", "query_pos", "hit_pos")


@query(
    "normalize_hits",
    f"""{CTE} SELECT CAST(user_id AS VARCHAR) AS id, full_name, stars AS stargazers_count, k < 5 AS archived,
          k > 95 AS fork, event_type AS license_key, coalesce(lower(c_mktsegment), '') AS topics, hit_pos
        FROM hits LEFT JOIN customer ON c_custkey = user_id""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    # The hit position rides along in the URL column, which the operator keeps.
    found = S.hits(spark, folder).withColumn("html_url", F.col("hit_pos").cast("string"))
    repos = H.normalize_hits(found, S.details(spark, folder))
    return repos.select(
        "id", "full_name", "stargazers_count", "archived", "fork", F.col("license.key").alias("license_key"),
        F.array_join("topics", ",").alias("topics"), F.col("html_url").cast("long").alias("hit_pos"),
    )


@query(
    "collapse_hits",
    f"""{CTE} SELECT full_name, stars AS stargazers_count, 'Seen in ' || event_type AS description,
          k > 95 AS fork, coalesce(lower(c_mktsegment), '') AS topics
        FROM first_seen LEFT JOIN customer ON c_custkey = user_id""",
)
def collapse_hits(spark: SparkSession, folder: str) -> DataFrame:
    repos = H.collapse_hits(
        S.hits(spark, folder), S.search_specs(spark, folder), S.details(spark, folder), max_pages=PAGES, full_page=1
    )
    return repos.select(
        "full_name", "stargazers_count", "description", "fork", F.array_join("topics", ",").alias("topics")
    )


@query(
    "repo_metadata",
    f"""WITH f AS ({S.LISTING_SQL})
        SELECT full_name,
          any_value(md5(text)) AS readme_md5,
          bool_or((l = 1) OR (l = 6 AND f = 'N') OR (l = 7 AND f = 'A'))
            OR (bool_or(l = 2 AND f = 'N') AND bool_or(l = 5 AND f = 'A')) AS has_template_files,
          bool_or(l = 3 AND f = 'A') AS has_package_json, bool_or(l = 1) AS has_theme_files
        FROM f LEFT JOIN documents ON full_name = 'r/' || doc_id GROUP BY full_name""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    contents = S.listing(spark, folder)
    repos = S.table(spark, folder, "lineitem").select(
        F.concat(F.lit("r/"), F.col("l_orderkey")).alias("full_name")
    ).distinct()
    readmes = S.table(spark, folder, "documents").select(
        F.concat(F.lit("r/"), F.col("doc_id")).alias("full_name"), "text"
    )
    found = H.repo_metadata(repos, contents, readmes)
    return found.select(
        "full_name", F.md5("readme").alias("readme_md5"), "has_template_files", "has_package_json", "has_theme_files"
    )
