from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query
from gleanery.operators import webtables as W
from gleanery.plans.migration import migrate_pages
from gleanery.sources import sample_tables as S

AS_OF = datetime(2024, 1, 1)

CTE = f"""
WITH rows AS ({S.WEB_ROWS_SQL}),
filled AS (SELECT *, coalesce(last_value(CASE WHEN inner_row = 1 THEN NULL WHEN inner_row = 2 THEN 'Starter' WHEN size % 8 = 0 THEN 'Official' WHEN size % 4 = 0 THEN 'Tool' END IGNORE NULLS)
             OVER (PARTITION BY page_id ORDER BY row_pos ROWS UNBOUNDED PRECEDING), 'Other') AS category FROM rows),
data AS (SELECT *, contains(target, 't') AS ok, 'nav' || target AS repo,
           CASE WHEN size > 6 THEN 'A responsive magazine theme,' ELSE 'Plain' END AS description,
           CASE WHEN size > 6 THEN 'A responsive magazine theme, well kept'
                ELSE 'Plain' END AS notes FROM filled WHERE size % 4 <> 0 AND inner_row = 0)
"""


@query("page_links", f"SELECT page_id, link_pos AS row_pos, target AS url FROM ({S.LINKS_SQL})")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return W.page_links(S.table(spark, folder, "pages"))


@query("table_rows", f"{CTE} SELECT page_id, row_pos, CASE WHEN inner_row = 1 THEN 0 WHEN size % 4 = 0 OR inner_row = 2 THEN 1 WHEN nested THEN 5 ELSE 3 END AS cells FROM rows")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return W.table_rows(S.table_pages(spark, folder)).select("page_id", "row_pos", F.size("cells").alias("cells"))


@query("fill_category_down", f"{CTE} SELECT page_id, row_pos, category FROM filled")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return W.fill_category_down(W.page_rows(S.table_pages(spark, folder))).select("page_id", "row_pos", "category")


@query(
    "web_items",
    f"""{CTE} SELECT repo, 'Entry ' || size AS name, 'https://github.com/' || repo AS url, category, stars, description, notes,
          'ghost-theme' || CASE WHEN category = 'Official' THEN ',official' ELSE '' END
            || CASE WHEN size > 6 THEN ',responsive,magazine' ELSE '' END AS tags,
          CASE WHEN stars > 1000 THEN 'high' WHEN stars > 100 THEN 'medium' ELSE 'low' END AS confidence,
          50 + CASE WHEN stars > 2000 THEN 30 WHEN stars > 1000 THEN 25 WHEN stars > 500 THEN 20 WHEN stars > 100 THEN 15
                    WHEN stars > 50 THEN 10 WHEN stars > 10 THEN 5 ELSE 0 END
             + CASE category WHEN 'Official' THEN 15 WHEN 'Tool' THEN 10 ELSE 0 END
             + CASE WHEN length(description) > 20 THEN 5 ELSE 0 END AS score
        FROM data WHERE ok""",
)
def web_items(spark: SparkSession, folder: str) -> DataFrame:
    return migrate_pages(S.table_pages(spark, folder), AS_OF).items.select(
        "repo", "name", "url", "category", "stars", "description", "notes", F.array_join("tags", ",").alias("tags"),
        "confidence", "score",
    )


@query(
    "web_warnings",
    f"""{CTE} SELECT page_id, row_pos, 'Invalid GitHub URL: https://x.example' || target AS message FROM data WHERE NOT ok""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return migrate_pages(S.table_pages(spark, folder), AS_OF).warnings


@query("migration_category_counts", f"{CTE} SELECT category, count(*) AS items FROM data WHERE ok GROUP BY category")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return migrate_pages(S.table_pages(spark, folder), AS_OF).category_counts
