from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query
from gleanery.operators import dedup as D
from gleanery.sources import sample_tables as S

CTE = f"WITH items AS ({S.DUP_ITEMS_SQL})"


@query(
    "dedup_primary",
    f"""{CTE} SELECT id, repo, stars FROM items
        QUALIFY row_number() OVER (PARTITION BY lower(repo) ORDER BY stars DESC, id) = 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return D.dedup_primary(S.dup_items(spark, folder), D.repo_key()).select("id", "repo", "stars")


@query(
    "dedup_groups",
    f"""{CTE} SELECT lower(url) AS group_key, (array_agg(id ORDER BY stars DESC, id))[1] AS primary_id,
          count(*) - 1 AS duplicates, 'Multiple entries with same URL: ' || lower(url) AS reason
        FROM items GROUP BY lower(url) HAVING count(*) > 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return D.dedup_groups(S.dup_items(spark, folder), D.url_key(), reason=D.URL_REASON)


@query(
    "detect_duplicates",
    f"""{CTE}, r AS (SELECT *, first_value(id) OVER (PARTITION BY lower(repo) ORDER BY stars DESC, id) AS p FROM items),
        w AS (SELECT *, first_value(id) OVER (PARTITION BY lower(url) ORDER BY stars DESC, id) AS q FROM r WHERE id = p)
        SELECT lower(repo) AS group_key, id AS duplicate_id, p AS primary_id,
               'Multiple entries for repository: ' || lower(repo) AS reason FROM r WHERE id <> p
        UNION ALL
        SELECT lower(url), id, q, 'Multiple entries with same URL: ' || lower(url) FROM w WHERE id <> q""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return D.detect_duplicates(S.dup_items(spark, folder))


@query(
    "duplicate_notes",
    f"""{CTE} SELECT lower(repo) AS group_key, -stars AS s, id AS t, notes FROM items WHERE notes <> ''""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return D.group_notes(S.dup_items(spark, folder), D.repo_key()).select("group_key", "rank.s", "rank.t", "notes")


def merged_sql(source: str, key: str, name: str) -> str:
    """CTEs ``<name>_...`` and ``<name>``: the field-wise merge of ``source`` by ``key``."""

    def union_of(column: str) -> str:
        return f"""{name}_{column} AS (
  SELECT k, list(v ORDER BY s, t, i) AS v FROM (
    SELECT k, v, s, t, i FROM (
      SELECT k, unnest({column}) AS v, unnest(range(len({column}))) AS i, -stars AS s, id AS t FROM {name}_keyed)
    QUALIFY row_number() OVER (PARTITION BY k, v ORDER BY s, t, i) = 1) GROUP BY k)"""

    return f"""
{name}_keyed AS (SELECT *, {key} AS k FROM {source}),
{union_of('tags')},
{union_of('topics')},
{name}_groups AS (
  SELECT k, count(*) AS n, max(stars) AS stars, max(pushed_at) AS pushed_at,
         (array_agg({name}_keyed ORDER BY stars DESC, id))[1] AS p,
         (array_agg(description ORDER BY length(description) DESC, stars DESC, id) FILTER (description <> ''))[1] AS d,
         max(score) AS score, (array_agg(confidence ORDER BY score DESC, stars DESC, id))[1] AS confidence,
         (array_agg(license ORDER BY stars DESC, id) FILTER (license <> ''))[1] AS l,
         string_agg(notes, '; ' ORDER BY stars DESC, id) FILTER (notes <> '') AS notes
  FROM {name}_keyed GROUP BY k),
{name} AS (
  SELECT g.p.id AS id, g.p.name AS name, g.p.repo AS repo, g.p.url AS url, coalesce(d, g.p.description) AS description,
         g.p.category AS category, CASE WHEN n > 1 THEN a.v ELSE g.p.tags END AS tags, g.stars AS stars,
         g.pushed_at AS pushed_at, g.p.fork AS fork, coalesce(l, g.p.license) AS license,
         CASE WHEN n > 1 THEN b.v ELSE g.p.topics END AS topics, g.score AS score, g.confidence AS confidence,
         coalesce(g.notes, g.p.notes) AS notes
  FROM {name}_groups g JOIN {name}_tags a USING (k) JOIN {name}_topics b USING (k))"""


_SHOWN = """id, name, repo, url, description, array_to_string(tags, '|') AS tags, stars,
  strftime(pushed_at, '%Y-%m-%d') AS pushed_on, license, array_to_string(topics, '|') AS topics, score, confidence, notes"""


def _shown(items: DataFrame) -> DataFrame:
    return items.select(
        "id", "name", "repo", "url", "description", F.array_join("tags", "|").alias("tags"), "stars",
        F.date_format("pushed_at", "yyyy-MM-dd").alias("pushed_on"), "license",
        F.array_join("topics", "|").alias("topics"), "score", "confidence", "notes",
    )


@query("merge_duplicates", f"{CTE}, {merged_sql('items', 'lower(repo)', 'm')} SELECT {_SHOWN} FROM m")
def merge_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(D.merge_duplicates(S.dup_items(spark, folder), D.repo_key()))


@query(
    "clean_dataset",
    f"""{CTE}, {merged_sql('items', "lower(url)", 'm')}, {merged_sql('m', 'lower(repo)', 'c')} SELECT {_SHOWN} FROM c""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    # Many URLs and few names: swapped, so that both passes have groups to merge.
    swapped = S.dup_items(spark, folder)
    swapped = swapped.withColumns({"repo": F.col("url"), "url": F.col("repo")})
    cleaned = D.clean_dataset(swapped)
    return _shown(cleaned.withColumns({"repo": F.col("url"), "url": F.col("repo")}))


@query(
    "dedup_documents",
    """SELECT CAST(p AS BIGINT) AS doc_id, count(*) - 1 AS copies FROM
       (SELECT first_value(doc_id) OVER (PARTITION BY lower(text) ORDER BY n_chars DESC, doc_id) AS p FROM documents)
       GROUP BY p HAVING count(*) > 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Exact copies of whole texts; a digest stands in for the text in the shuffle."""
    docs = S.table(spark, folder, "documents").select(
        F.sha2(F.lower("text"), 256).alias("digest"), F.col("doc_id").alias("id"), F.col("n_chars").alias("stars")
    )
    groups = D.dedup_groups(docs, F.col("digest"), reason="Same text: ")
    return groups.select(F.col("primary_id").alias("doc_id"), F.col("duplicates").alias("copies"))
