"""The full update run and the stale-page run as job graphs."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions.columns import has_any_topic
from gleanery.functions.ranking import SMALL_TABLE_ROWS, materialize, materialize_counted
from gleanery.operators import dedup, hits, merge, quality, reports, scoring, staleness, structure
from gleanery.profiles import (
    DOMAIN_TOPICS,
    OFFICIAL_OWNER,
    STALE_THRESHOLD_MONTHS,
    UPDATE_PROFILE,
    ScoringProfile,
)
from gleanery.schemas import ITEM, STALE_ITEM
from gleanery.sources import writers
from gleanery.sources.store import Run, Store, Table


@dataclass
class UpdateInputs:
    """Tables the run reads.  ``hits`` may be None: then nothing is discovered."""

    existing: DataFrame
    overrides: DataFrame
    rules: DataFrame
    prior_stale: DataFrame
    hits: DataFrame | None = None
    specs: DataFrame | None = None
    details: DataFrame | None = None
    readmes: DataFrame | None = None
    contents: DataFrame | None = None
    manifests: DataFrame | None = None


@dataclass
class UpdateResult:
    items: DataFrame
    detected: DataFrame
    changes: DataFrame
    change_stats: DataFrame
    stale_state: DataFrame
    stale_summary: DataFrame
    findings: DataFrame
    metrics: DataFrame
    counted: dict[str, int]
    prior_stale: DataFrame
    reports: dict[str, DataFrame] = field(default_factory=dict)


def topic_gate(repos: DataFrame, topics: tuple[str, ...] = DOMAIN_TOPICS) -> DataFrame:
    """FLT-1, before the expensive joins."""
    return repos.filter(has_any_topic("topics", topics))


def classify_repos(
    repos: DataFrame, inputs: UpdateInputs, as_of: datetime, profile: ScoringProfile
) -> DataFrame:
    """JN-10 + CLS-*: attach README, listing and manifest, then score.

    ``repos`` is read more than once.  Listings and manifests are those of all repositories there are: where few are
    to be scored, the names of these are sent whole and the other rows go before they are grouped and parsed.
    """
    wanted = repos.select("full_name").distinct()
    few = wanted.limit(SMALL_TABLE_ROWS + 1).count() <= SMALL_TABLE_ROWS

    def of_repos(rows: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(wanted), "full_name", "left_semi") if few else rows

    if inputs.readmes is None:
        read = repos.withColumn("readme", F.lit(None).cast("string"))
    else:
        texts = of_repos(inputs.readmes.select("full_name", F.col("text").alias("readme")))
        read = repos.join(texts, "full_name", "left")
    if inputs.contents is None:
        features = structure.structure_features(_no_contents(repos.sparkSession))
    else:
        features = structure.structure_features(of_repos(inputs.contents))
    manifests = None
    if inputs.manifests is not None:
        manifests = structure.manifest_features(of_repos(inputs.manifests), domain_keywords=profile.domain_keywords)
    return scoring.classify(structure.with_structure(read, features, manifests), as_of, profile)


def _no_contents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "full_name string, path string, name string, type string")


def update_run(
    inputs: UpdateInputs,
    as_of: datetime,
    *,
    profile: ScoringProfile = UPDATE_PROFILE,
    topics: tuple[str, ...] = DOMAIN_TOPICS,
    owner: str = OFFICIAL_OWNER,
    threshold: int = STALE_THRESHOLD_MONTHS,
    max_pages: int = hits.MAX_PAGES,
    full_page: int = hits.PAGE_SIZE,
) -> UpdateResult:
    """PIP-1.  Tables several outputs read are written once to the scratch folder."""
    counted = {}
    if inputs.hits is None:
        new = inputs.existing.limit(0)
    else:
        crawled, seen = materialize_counted(
            hits.collapse_hits(
                inputs.hits, inputs.specs, inputs.details, max_pages=max_pages, full_page=full_page
            ),
            crawled=F.lit(True),
            filtered_no_topic=~has_any_topic("topics", topics),
        )
        topical = topic_gate(crawled, topics)
        good = F.coalesce(F.col("score") >= profile.min_score, F.lit(False))
        scored, kept = materialize_counted(
            hits.to_item_categorized(classify_repos(topical, inputs, as_of, profile), official_owner=owner),
            filtered_low_score=F.col("score") < profile.min_score,
            classified=good,
        )
        new = materialize(dedup.clean_dataset(scoring.score_gate(scored, profile.min_score)))
        counted = seen | kept

    outcomes, merged = materialize_counted(
        merge.merge_outcomes(
            inputs.existing, new, inputs.overrides, inputs.rules, topics=topics, owner=owner,
            domain_label=profile.domain_label,
        ),
        merged=F.col("outcome").isin(*merge.KEPT_OUTCOMES),
    )
    detected, rendered = materialize_counted(
        staleness.detect_staleness(merge.merged_items(outcomes), inputs.prior_stale, as_of, threshold),
        rendered=F.col("state").isin(staleness.ACTIVE, staleness.REACTIVATED) & reports.is_visible(),
    )
    items, state = staleness.active_items(detected), staleness.next_state(detected)

    findings, errors = materialize_counted(quality.consistency_errors(new), errors=F.col("severity") == "error")
    counted |= merged | rendered | errors
    return UpdateResult(
        items=items,
        detected=detected,
        changes=merge.change_log(outcomes),
        change_stats=merge.change_stats(outcomes),
        stale_state=state,
        stale_summary=staleness.stale_summary(detected),
        findings=findings,
        metrics=reports.metric_rows(inputs.existing.sparkSession, counted),
        counted=counted,
        prior_stale=inputs.prior_stale,
        reports={
            "directory": reports.category_order(reports.directory_rows(items)),
            "use_cases": reports.use_case_lists(items),
            "top": reports.top_by_stars(items),
            "recent": reports.recently_updated(items),
            "stale_directory": reports.category_order(reports.stale_rows(state)),
        },
    )


def _run_tables(items: DataFrame, state: DataFrame, prior: DataFrame, report_tables: dict[str, DataFrame]) -> dict[str, Table]:
    """What a run leaves: the catalog, the state as its changes, the state before the run, and the reports."""
    tables = {
        "catalog": Table(reports.catalog_order(items)),
        "state": Table(writers.spread_by_category(state), key="id", partition_by=("category",)),
        "backup": Table(prior),
    }
    return tables | {f"reports/{name}": Table(rows) for name, rows in report_tables.items()}


def save_update(result: UpdateResult, store: Store, as_of: datetime, *, after: int | None = None) -> Run:
    """The sinks of the run, committed as one; leave this call out for a dry run.

    ``after`` is the number of the run whose state and catalog were read.
    """
    tables = _run_tables(result.items, result.stale_state, result.prior_stale, result.reports)
    return store.save(as_of, tables, after=after, metrics=result.counted)


class StalePage(NamedTuple):
    """What the stale page job makes of a catalog and a stale state."""

    state: DataFrame
    active: DataFrame
    directory: DataFrame
    summary: DataFrame


def stale_page(items: DataFrame, prior: DataFrame, as_of: datetime, threshold: int = staleness.STALE_THRESHOLD_MONTHS) -> StalePage:
    """E2 without its sinks: detect, move stale items to the state, keep the rest, and report."""
    detected = staleness.detect_staleness(items, prior, as_of, threshold)
    state = staleness.next_state(detected)
    directory = reports.category_order(reports.stale_rows(state))
    return StalePage(state, staleness.active_items(detected), directory, staleness.stale_summary(detected))


def stale_page_run(store: Store, as_of: datetime) -> DataFrame:
    """E2: take the stored catalog, move stale items to the state, keep the rest.

    Returns the one-row summary.  Catalog and state are read as one run left them, also after this one is committed.
    """
    run = store.last()
    items, prior = store.read("catalog", ITEM, run), store.read("state", STALE_ITEM, run)
    page = stale_page(items, prior, as_of)
    store.save(as_of, _run_tables(page.active, page.state, prior, {"stale_directory": page.directory}), after=run.number if run else 0)
    return page.summary
