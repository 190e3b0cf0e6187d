from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query
from gleanery.operators import deltas, reports, staleness
from gleanery.plans.stale_validation import stale_validation
from gleanery.plans.update import stale_page
from gleanery.sources import sample_tables as S

THRESHOLD = 12
BACK = 6


def _now_and_before(spark: SparkSession, folder: str):
    now, before = S.reference_dates(spark, folder, BACK)
    incoming = S.catalog(spark, folder, now).filter(~F.col("archived"))
    prior = staleness.with_staleness(S.catalog(spark, folder, before), before, THRESHOLD).filter("is_stale")
    return now, incoming, prior.withColumn("stale_detected_at", F.lit(before).cast("timestamp_ntz")).drop("is_stale")


def _detected(spark: SparkSession, folder: str) -> DataFrame:
    now, incoming, prior = _now_and_before(spark, folder)
    return staleness.detect_staleness(incoming, prior, now, THRESHOLD)


def _stale(spark: SparkSession, folder: str) -> DataFrame:
    return staleness.next_state(_detected(spark, folder))


CTE = f"""
WITH {S.ASOF_SQL},
now_items AS (SELECT i.*, date_diff('month', pushed_at, a) AS months FROM ({S.catalog_sql(0)}) i, dates),
old_items AS (SELECT i.*, date_diff('month', pushed_at, a - INTERVAL {BACK} MONTH) AS months,
                     a - INTERVAL {BACK} MONTH AS detected FROM ({S.catalog_sql(BACK)}) i, dates),
incoming AS (SELECT * FROM now_items WHERE NOT archived),
prior AS (SELECT * FROM old_items WHERE months > {THRESHOLD}),
detected AS (
  SELECT coalesce(i.id, p.id) AS id, coalesce(i.name, p.name) AS name, coalesce(i.url, p.url) AS url,
         coalesce(i.category, p.category) AS category, coalesce(i.stars, p.stars) AS stars,
         coalesce(i.hidden, p.hidden) AS hidden, coalesce(i.pushed_at, p.pushed_at) AS pushed_at,
         CASE WHEN i.id IS NULL THEN p.description ELSE i.description END AS description,
         CASE WHEN i.id IS NULL THEN p.notes ELSE i.notes END AS notes,
         CASE WHEN i.id IS NULL THEN 'remaining' WHEN i.months > {THRESHOLD} AND p.id IS NOT NULL THEN 'still_stale'
              WHEN i.months > {THRESHOLD} THEN 'newly_stale' WHEN p.id IS NOT NULL THEN 'reactivated'
              ELSE 'active' END AS state,
         CASE WHEN i.id IS NULL OR (i.months > {THRESHOLD} AND p.id IS NOT NULL) THEN p.detected
              WHEN i.months > {THRESHOLD} THEN (SELECT a FROM dates) END AS detected_at,
         CASE WHEN i.id IS NULL THEN p.months WHEN i.months > {THRESHOLD} THEN i.months END AS months_stale
  FROM incoming i FULL OUTER JOIN prior p ON i.id = p.id),
stale AS (SELECT * FROM detected WHERE state IN ('newly_stale', 'still_stale', 'remaining'))
"""


@query("months_stale", f"{CTE} SELECT id, CAST(greatest(0, months) AS INTEGER) AS months_stale FROM now_items")
def _(spark: SparkSession, folder: str) -> DataFrame:
    now, _ = S.reference_dates(spark, folder, BACK)
    return staleness.with_staleness(S.catalog(spark, folder, now), now).select("id", "months_stale")


@query("stale_flags", f"{CTE} SELECT id, months > {THRESHOLD} AS is_stale FROM now_items")
def _(spark: SparkSession, folder: str) -> DataFrame:
    now, _ = S.reference_dates(spark, folder, BACK)
    return staleness.with_staleness(S.catalog(spark, folder, now), now, THRESHOLD).select("id", "is_stale")


@query(
    "staleness_states",
    f"""{CTE} SELECT id, state, strftime(detected_at, '%Y-%m-%d') AS detected_on,
                     CAST(months_stale AS INTEGER) AS months_stale FROM detected""",
)
def staleness_states(spark: SparkSession, folder: str) -> DataFrame:
    return _detected(spark, folder).select(
        "id", "state", F.date_format("stale_detected_at", "yyyy-MM-dd").alias("detected_on"), "months_stale"
    )


@query(
    "staleness_counters",
    f"""{CTE} SELECT count(*) FILTER (state <> 'remaining') AS total_processed,
                     count(*) FILTER (state IN ('active', 'reactivated')) AS active_count,
                     count(*) FILTER (state = 'newly_stale') AS newly_stale,
                     count(*) FILTER (state = 'reactivated') AS reactivated,
                     count(*) FILTER (state = 'remaining') AS remaining_stale FROM detected""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return staleness.staleness_counters(_detected(spark, folder))


@query("active_items", f"{CTE} SELECT id, stars FROM detected WHERE state IN ('active', 'reactivated')")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return staleness.active_items(_detected(spark, folder)).select("id", "stars")


STATE_SQL = f"""{CTE} SELECT id, stars, CAST(months_stale AS INTEGER) AS months_stale,
                             strftime(detected_at, '%Y-%m-%d') AS detected_on FROM stale"""


def _state_columns(state: DataFrame) -> DataFrame:
    return state.select(
        "id", "stars", "months_stale", F.date_format("stale_detected_at", "yyyy-MM-dd").alias("detected_on")
    )


@query("next_state", STATE_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _state_columns(_stale(spark, folder))


@query(
    "stale_page",
    f"""{CTE} SELECT 'state' AS part, id, stars FROM stale UNION ALL
        SELECT 'active', id, stars FROM detected WHERE state IN ('active', 'reactivated') UNION ALL
        SELECT 'directory', id, stars FROM stale WHERE NOT hidden UNION ALL
        SELECT 'summary', 'total', count(*) FROM stale""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The tables that the stale page job writes, one below the other."""
    now, incoming, prior = _now_and_before(spark, folder)
    page = stale_page(incoming, prior, now, THRESHOLD)
    parts = [(n, getattr(page, n).select("id", "stars")) for n in ("state", "active", "directory")]
    parts.append(("summary", page.summary.select(F.lit("total").alias("id"), F.col("total").alias("stars"))))
    frames = [f.select(F.lit(n).alias("part"), "id", "stars") for n, f in parts]
    return reduce(DataFrame.union, frames)


@query("state_upsert", STATE_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    now, incoming, prior = _now_and_before(spark, folder)
    detected = staleness.detect_staleness(incoming, prior, now, THRESHOLD)
    upserts = detected.filter(F.col("state").isin("newly_stale", "still_stale")).drop("state")
    back = detected.filter(F.col("state") == "reactivated")
    return _state_columns(staleness.upsert_state(prior, upserts, back))


@query(
    "state_changes",
    f"""{CTE} SELECT CASE WHEN state = 'reactivated' THEN 'drop' ELSE 'put' END AS op, id, CASE WHEN state <> 'reactivated' THEN stars END AS stars
        FROM detected WHERE state IN ('newly_stale', 'still_stale', 'reactivated')""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """What a run writes of the state: months have passed, so all rows seen again differ; the others are not written."""
    _, _, prior = _now_and_before(spark, folder)
    return deltas.changes(prior, _stale(spark, folder)).select("op", "id", "stars")


@query("merged_state", STATE_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The state before, read with the changes of the run."""
    _, _, prior = _now_and_before(spark, folder)
    return _state_columns(deltas.merged(prior, deltas.changes(prior, _stale(spark, folder)).withColumn("number", F.lit(1))))


_CATEGORIES_SQL = """(SELECT string_agg(category || '=' || n, ',' ORDER BY category) FROM
   (SELECT category, count(*) AS n FROM {t} GROUP BY category)) AS by_category"""


def _map_text(column: str) -> F.Column:
    return F.array_join(
        F.transform(F.map_entries(column), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ","
    ).alias(column)


@query(
    "stale_statistics",
    f"""{CTE} SELECT count(*) AS total_stale, floor(avg(months_stale) * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE
        AS average_months_stale, {_CATEGORIES_SQL.format(t='stale')} FROM stale""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = staleness.stale_statistics(_stale(spark, folder))
    return found.select("total_stale", "average_months_stale", _map_text("by_category"))


@query(
    "stale_report_statistics",
    f"""{CTE}, shown AS (SELECT * FROM stale WHERE NOT hidden)
        SELECT count(*) AS total_stale,
               floor(count(*)::DOUBLE / (SELECT count(*) FROM detected)::DOUBLE * 100.0::DOUBLE * 10.0::DOUBLE + 0.5::DOUBLE)
                 / 10.0::DOUBLE AS percentage_of_total,
               floor(sum(months_stale)::DOUBLE / count(*)::DOUBLE * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE
                 AS average_months_stale, {_CATEGORIES_SQL.format(t='shown')} FROM shown""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    detected = _detected(spark, folder)
    whole = staleness.staleness_totals(detected).scalar()
    found = staleness.stale_report_statistics(staleness.next_state(detected), whole)
    return found.select("total_stale", "percentage_of_total", "average_months_stale", _map_text("by_category"))


@query(
    "stale_summary",
    f"""{CTE} SELECT (SELECT count(*) FROM stale) AS total,
               count(*) FILTER (state = 'newly_stale') AS newly_stale,
               count(*) FILTER (state = 'reactivated') AS reactivated,
               floor((SELECT count(*) FROM stale WHERE NOT hidden)::DOUBLE / count(*)::DOUBLE * 100.0::DOUBLE
                 * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE AS percentage,
               floor((SELECT sum(months_stale)::DOUBLE / count(*)::DOUBLE FROM stale WHERE NOT hidden)
                 * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE AS average_months_stale FROM detected""",
)
def stale_summary(spark: SparkSession, folder: str) -> DataFrame:
    return staleness.stale_summary(_detected(spark, folder))


@query("stale_by_category", f"{CTE} SELECT id, category, stars FROM stale WHERE category = 'Theme'")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return staleness.stale_by_category(_stale(spark, folder), "Theme").select("id", "category", "stars")


@query(
    "overlap_check",
    f"""{CTE} SELECT id, 'Item ' || id || ' is in both active and stale lists' AS message FROM detected
        WHERE state IN ('active', 'reactivated') AND id IN (SELECT id FROM prior)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    now, incoming, prior = _now_and_before(spark, folder)
    active = staleness.active_items(staleness.detect_staleness(incoming, prior, now, THRESHOLD))
    return staleness.overlap_check(active, prior)


_RECONCILED_SQL = """
SELECT 'error' AS severity, 'total' AS "check",
       'Statistics mismatch: totalStale=' || o.n || ', actual count=' || s.n AS message
FROM (SELECT count(*) AS n FROM prior) o, (SELECT count(*) AS n FROM stale) s WHERE o.n <> s.n
UNION ALL
SELECT 'error', 'category', 'Category count mismatch for ' || s.category || ': stats='
       || coalesce(CAST(o.n AS VARCHAR), 'undefined') || ', actual=' || s.n
FROM (SELECT category, count(*) AS n FROM stale GROUP BY 1) s
LEFT JOIN (SELECT category, count(*) AS n FROM prior GROUP BY 1) o USING (category)
WHERE o.n IS DISTINCT FROM s.n
UNION ALL
SELECT 'warning', 'average', 'Average months stale mismatch: stats=' || o.m || ', expected=' || s.m
FROM (SELECT floor(avg(months) * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE AS m FROM prior) o,
     (SELECT floor(avg(months_stale) * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE AS m FROM stale) s
WHERE abs(o.m - s.m) > 0.1"""


@query("reconcile_statistics", f"{CTE} {_RECONCILED_SQL}")
def _(spark: SparkSession, folder: str) -> DataFrame:
    now, incoming, prior = _now_and_before(spark, folder)
    stale = staleness.next_state(staleness.detect_staleness(incoming, prior, now, THRESHOLD))
    return staleness.reconcile_statistics(stale, staleness.stale_statistics(prior))


_PAGE_WARNINGS = r"""list_filter(CASE WHEN page_id % 2 = 1
  THEN [CASE WHEN NOT contains(html, 'stale.html') THEN 'Link to stale.html not found in index.html' END]
  ELSE [CASE WHEN NOT regexp_matches(html, '(?i)<title>.*Not Updated Recently.*</title>') THEN 'Title with "Not Updated Recently" not found in HTML' END,
        CASE WHEN NOT regexp_matches(html, '(?i)These items have not been updated') THEN 'Warning message not found in HTML' END,
        CASE WHEN NOT regexp_matches(html, '(?i)href="index\.html"') THEN 'Link back to main page not found in HTML' END,
        CASE WHEN NOT regexp_matches(html, '(?i)<h2>.*THEMES.*</h2>') THEN 'Category headers not found in HTML' END,
        CASE WHEN NOT (contains(html, 'stale items') OR contains(html, 'average')) THEN 'Statistics display not found in HTML' END,
        CASE WHEN abs(o - c) > 10 THEN 'HTML tag mismatch: ' || o || ' open tags, ' || c || ' close tags' END,
        CASE WHEN NOT contains(html, 'index.html') THEN 'Link to index.html not found in stale.html' END] END, lambda x: x IS NOT NULL)"""


@query(
    "stale_validation",
    f"""{CTE} {_RECONCILED_SQL}
        UNION ALL SELECT 'warning', 'overlap', 'Item ' || id || ' is in both active and stale lists'
        FROM incoming WHERE id IN (SELECT id FROM stale)
        UNION ALL SELECT 'warning', 'page', unnest({_PAGE_WARNINGS}) FROM (SELECT *,
          len(regexp_extract_all(html, '<[^/][^>]*>')) AS o, len(regexp_extract_all(html, '</[^>]*>')) AS c FROM pages)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Pages with an even number stand for stale pages, the others for index pages."""
    now, incoming, prior = _now_and_before(spark, folder)
    stale = staleness.next_state(staleness.detect_staleness(incoming, prior, now, THRESHOLD))
    role = F.when(F.col("page_id") % 2 == 0, "stale").otherwise("index")
    pages = S.table(spark, folder, "pages").select("page_id", "html", role.alias("role"))
    return stale_validation(incoming, stale, staleness.stale_statistics(prior), pages)


@query(
    "stale_rows",
    f"""{CTE} SELECT id, CASE WHEN category = 'Tool' THEN 'tool' ELSE 'theme' END AS section, name, url, stars, category,
          strftime(pushed_at, '%B %-d, %Y') || ' (' || months_stale || ' months ago)' AS last_updated,
          concat_ws('; ', nullif(description, ''), nullif(notes, '')) AS notes
        FROM stale WHERE NOT hidden""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return reports.stale_rows(_stale(spark, folder))


@query(
    "report_tools",
    f"""{CTE} SELECT id, name, url, coalesce(description, '') AS description,
          strftime(pushed_at, '%B %-d, %Y') AS pushed_at, CAST(months_stale AS INTEGER) AS months_stale
        FROM stale WHERE NOT hidden AND category = 'Tool'""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return reports.report_tools(_stale(spark, folder))
