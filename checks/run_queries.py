"""The full update run over the generated tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import hit_queries as HQ
from checks import score_queries as SQ
from checks.registry import query
from gleanery.plans.update import UpdateInputs, UpdateResult, update_run
from gleanery.profiles import ScoringProfile, Thresholds, Weights
from gleanery.sources import sample_tables as S

TOPICS = ("machin", "build")
THEME = ("ing", "the", "license")
PENALTY = ("copy", "test")
PROFILE = ScoringProfile(
    weights=Weights(topics=0.4, readme=0.3, structure=0.2, penalties=0.1),
    thresholds=Thresholds(high=80, medium=60),
    domain_keywords=TOPICS,
    theme_keywords=THEME,
    penalty_keywords=PENALTY,
    min_score=40,
)


def _user(key: str | Column) -> Column:
    return F.concat(F.lit("u/user-"), (F.col(key) if isinstance(key, str) else key).cast("string"))


def _run(spark: SparkSession, folder: str) -> UpdateResult:
    orders_end, _ = S.reference_dates(spark, folder, 0)
    as_of = S.table(spark, folder, "events").agg(F.max("ts")).first()[0]
    number = F.regexp_extract("name", r"(\d+)$", 1).cast("long")
    existing = S.catalog(spark, folder, orders_end).withColumns({"id": _user(number), "repo": _user(number)})
    rich = S.table(spark, folder, "customer").filter("c_acctbal > 9000")
    overrides = rich.select(
        F.lit(1).alias("pos"), _user("c_custkey").alias("repo"), F.lit(None).cast("string").alias("name"),
        F.lit("Tool").alias("category"), F.lit(None).cast("array<string>").alias("tags_add"),
        F.lit(None).cast("array<string>").alias("tags_remove"), F.lit(None).cast("string").alias("notes"),
        F.when(F.col("c_acctbal") > 9800, F.lit(True)).alias("hidden"),
    )
    prior = existing.filter("archived").withColumns(
        {"stale_detected_at": F.lit(orders_end).cast("timestamp_ntz"), "months_stale": F.lit(13)}
    )
    docs = S.table(spark, folder, "documents").select(_user("doc_id").alias("full_name"), "text")
    listing = S.listing(spark, folder).withColumn(
        "full_name", F.concat(F.lit("u/user-"), F.split_part("full_name", F.lit("/"), F.lit(2)))
    )
    manifests = S.manifests(spark, folder).withColumn("full_name", _user(F.split_part("full_name", F.lit("/"), F.lit(2))))
    inputs = UpdateInputs(
        existing=existing,
        overrides=overrides,
        rules=spark.createDataFrame([(0, "pattern", "7$")], "pos int, kind string, value string"),
        prior_stale=prior,
        hits=S.hits(spark, folder),
        specs=S.search_specs(spark, folder),
        details=S.details(spark, folder),
        readmes=docs,
        contents=listing,
        manifests=manifests,
    )
    return update_run(
        inputs, as_of, profile=PROFILE, topics=TOPICS, owner="u2", max_pages=HQ.PAGES, full_page=1
    )


CTE = f"""{HQ.CTE.replace('WITH', 'WITH ' + S.ASOF_SQL + ',', 1)},
{SQ.LISTED.replace('WITH', '', 1)},
st AS (SELECT CAST(substring(full_name, 3) AS BIGINT) AS user_id, greatest(0, least(100,
    ne * 25 + CASE WHEN template_files - ne > 0 THEN least((template_files - ne) * 5, 20) ELSE 0 END + nd * 10
    + CASE WHEN has_package_json THEN 15 ELSE 0 END + least(css_files * 3, 15) + least(js_files * 2, 10)
    + CASE WHEN image_files > 0 THEN 5 ELSE 0 END + least(partial_files * 3, 15) + CASE WHEN has_config THEN 10 ELSE 0 END
    + {SQ.MANIFEST_POINTS} - (CASE WHEN template_files = 0 THEN 30 ELSE 0 END + ns * 10 + CASE WHEN ha THEN 0 ELSE 5 END
       + CASE WHEN hp THEN 0 ELSE 5 END + CASE WHEN css_files = 0 THEN 15 ELSE 0 END))) AS s FROM y LEFT JOIN ({SQ.manifest_sql(TOPICS)}) m USING (full_name)),
crawled AS (SELECT f.*, lower(c_mktsegment) AS topic, lower(text) AS t, coalesce(st.s, 0) AS s
            FROM first_seen f LEFT JOIN customer ON c_custkey = f.user_id LEFT JOIN documents d ON d.doc_id = f.user_id
            LEFT JOIN st ON st.user_id = f.user_id),
topical AS (SELECT *,
    least(100, 60 + least(CASE WHEN {SQ.has_any('topic', THEME)} THEN 15 ELSE 0 END, 40)
      + CASE WHEN {SQ.has_any('topic', THEME)} THEN 10 ELSE 0 END) AS tp,
    CASE WHEN coalesce(t, '') = '' THEN 0 ELSE least(100, CASE WHEN {SQ.has_any('t', TOPICS)} THEN 50 ELSE 0 END
      + least({SQ.how_many('t', THEME)} * 8, 30) + CASE WHEN {SQ.has_any('t', ('install', 'setup', 'download'))} THEN 15 ELSE 0 END
      + CASE WHEN {SQ.has_any('t', ('demo', 'preview', 'live'))} THEN 10 ELSE 0 END
      + CASE WHEN {SQ.has_any('t', ('![', '<img'))} THEN 5 ELSE 0 END) END AS rd,
    CASE WHEN stars < 3 THEN 20 WHEN stars < 10 THEN 10 ELSE 0 END + CASE WHEN k > 95 THEN 15 ELSE 0 END + 5
      + CASE WHEN t IS NULL THEN 0 ELSE {SQ.how_many('t', PENALTY)} * 6
        + CASE WHEN {SQ.has_any('t', ('work in progress', 'wip'))} THEN 15 ELSE 0 END
        + CASE WHEN {SQ.has_any('t', ('not maintained', 'deprecated'))} THEN 25 ELSE 0 END
        + CASE WHEN {SQ.has_any('t', ('personal project', 'learning'))} THEN 10 ELSE 0 END END AS pn
  FROM crawled WHERE {SQ.has_any('topic', TOPICS)}),
scored AS (SELECT *, CAST(greatest(0, least(100, floor(tp::DOUBLE * 0.4::DOUBLE + rd::DOUBLE * 0.3::DOUBLE
     + s::DOUBLE * 0.2::DOUBLE - pn::DOUBLE * 0.1::DOUBLE + 0.5::DOUBLE))) AS INTEGER) AS score FROM topical),
new AS (SELECT 'u/user-' || user_id AS repo, user_id AS c, stars, score, 'Theme' AS category, false AS hidden, ts AS pushed_at
        FROM scored WHERE score >= 40),
old AS (SELECT 'u/user-' || c_custkey AS repo, c_custkey AS c, stars, score, category, hidden, pushed_at, archived, topics
        FROM ({S.catalog_sql(0)})),
merged AS (SELECT coalesce(n.repo, o.repo) AS repo, n.repo IS NOT NULL AS seen, o.repo IS NOT NULL AS known, o.archived AS was,
    CASE WHEN n.repo IS NOT NULL THEN n.stars ELSE o.stars END AS stars, CASE WHEN n.repo IS NOT NULL THEN n.score ELSE o.score END AS score,
    CASE WHEN n.repo IS NOT NULL THEN n.pushed_at ELSE o.pushed_at END AS pushed_at,
    CASE WHEN r.c_acctbal > 9000 THEN 'Tool' WHEN n.repo IS NOT NULL THEN n.category ELSE o.category END AS category,
    CASE WHEN r.c_acctbal > 9800 THEN true WHEN n.repo IS NOT NULL THEN n.hidden ELSE o.hidden END AS hidden,
    o.topics AS old_topics
  FROM new n FULL OUTER JOIN old o ON n.repo = o.repo LEFT JOIN customer r ON r.c_custkey = coalesce(n.c, o.c)),
outcome AS (SELECT *, CASE WHEN seen AND repo LIKE '%7' THEN 'ignored' WHEN seen AND hidden THEN 'ignored' WHEN seen AND known THEN 'updated'
    WHEN seen THEN 'added' WHEN repo LIKE '%7' THEN 'removed'
    WHEN NOT (contains(old_topics[1], 'machin') OR contains(old_topics[1], 'build')) AND score < 50 THEN 'removed' ELSE 'kept' END AS o
  FROM merged),
final AS (SELECT *, date_diff('month', pushed_at, (SELECT max(ts) FROM events)) AS months FROM outcome WHERE o IN ('added', 'updated', 'kept')),
prior AS (SELECT repo, hidden FROM old WHERE archived),
detected AS (
  SELECT f.repo, f.stars, f.score, f.category, CASE WHEN months > 12 AND p.repo IS NOT NULL THEN 'still_stale' WHEN months > 12 THEN 'newly_stale'
         WHEN p.repo IS NOT NULL THEN 'reactivated' ELSE 'active' END AS state FROM final f LEFT JOIN prior p USING (repo)
  UNION ALL
  SELECT repo, stars, score, category, 'remaining' FROM old WHERE archived AND repo NOT IN (SELECT repo FROM final))
"""


@query("update_run", f"{CTE} SELECT repo, stars, score, category, state FROM detected")
def update_states(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder).detected.select("repo", "stars", "score", "category", "state")


@query(
    "update_changes",
    f"{CTE} SELECT o AS type, count(*) AS changes FROM outcome WHERE o <> 'kept' GROUP BY o",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    changes = _run(spark, folder).changes
    return changes.groupBy("type").agg(F.count(F.lit(1)).alias("changes"))


@query(
    "update_metrics",
    f"""{CTE} SELECT 'crawled' AS metric, count(*) AS n FROM crawled
        UNION ALL SELECT 'filtered_no_topic', (SELECT count(*) FROM crawled) - (SELECT count(*) FROM topical)
        UNION ALL SELECT 'filtered_low_score', count(*) FROM scored WHERE score < 40
        UNION ALL SELECT 'classified', count(*) FROM new
        UNION ALL SELECT 'merged', count(*) FROM final
        UNION ALL SELECT 'rendered', count(*) FROM detected d JOIN final f USING (repo)
          WHERE d.state IN ('active', 'reactivated') AND NOT f.hidden
        UNION ALL SELECT 'errors', 0""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder).metrics
