"""Search hits: paging, first-seen collapse, per-query caps, normalisation."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.columns import has_text
from gleanery.functions.ranking import SMALL_TABLE_ROWS, first_per_key, materialize, top_k_per_key

MAX_PAGES = 10
PAGE_SIZE = 100


class Bounds(NamedTuple):
    """Sizes read from the query list, a small configuration table."""

    queries: int
    max_results: int


def bounds_of(specs: DataFrame) -> Bounds:
    row = specs.agg(F.count(F.lit(1)), F.coalesce(F.max("max_results"), F.lit(0))).first()
    return Bounds(*row)


def _sent_whole(table: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint only where ``rows``, an upper bound, is small."""
    return F.broadcast(table) if rows <= SMALL_TABLE_ROWS else table


def page_sizes(hits: DataFrame) -> DataFrame:
    return hits.groupBy("query_pos", "page").agg(F.count(F.lit(1)).alias("page_size"))


def pages_read(hits: DataFrame, *, max_pages: int = MAX_PAGES, full_page: int = PAGE_SIZE) -> DataFrame:
    """WIN-4: the pages a reader would have fetched.

    Reading stops at ``max_pages``, at a missing page and after a page with
    fewer than ``full_page`` hits.
    """
    before = Window.partitionBy("query_pos").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    return (
        page_sizes(hits.filter(F.col("page") <= max_pages))
        .withColumn("_smallest", F.min("page_size").over(before))
        .withColumn("_pages", F.count("page").over(before))
        .filter(
            (F.col("_pages") == F.col("page") - 1)
            & (F.coalesce(F.col("_smallest"), F.lit(full_page)) >= full_page)
        )
        .drop("_smallest", "_pages")
    )


def page_limit(
    hits: DataFrame, bounds: Bounds | None = None, *, max_pages: int = MAX_PAGES, full_page: int = PAGE_SIZE
) -> DataFrame:
    """Keep the hits of the pages read.

    ``bounds`` limits the size of the page table; it may be given only where all hits are of listed queries.
    """
    pages = pages_read(hits, max_pages=max_pages, full_page=full_page).drop("page_size")
    if bounds:
        pages = _sent_whole(pages, bounds.queries * max_pages)
    return hits.join(pages, ["query_pos", "page"], "left_semi")


def first_seen_within_query(hits: DataFrame) -> DataFrame:
    """WIN-1: the first hit of each repository in each query, before any filter."""
    return first_per_key(hits, ["query_pos", "full_name"], [F.col("page"), F.col("hit_pos")])


def include_hits(hits: DataFrame, *, include_archived: bool = False, include_forks: bool = True) -> DataFrame:
    """FLT-2."""
    if not include_archived:
        hits = hits.filter(~F.coalesce("archived", F.lit(False)))
    if not include_forks:
        hits = hits.filter(~F.coalesce("fork", F.lit(False)))
    return hits


def min_stars(hits: DataFrame, specs: DataFrame, bounds: Bounds) -> DataFrame:
    """FLT-3: at least the stars the query asks for."""
    wanted = _sent_whole(specs.select("query_pos", "min_stars"), bounds.queries)
    return (
        hits.join(wanted, "query_pos")
        .filter(F.col("stargazers_count") >= F.col("min_stars"))
        .drop("min_stars")
    )


def cap_per_query(hits: DataFrame, specs: DataFrame, bounds: Bounds, *, max_pages: int = MAX_PAGES) -> DataFrame:
    """WIN-2: the first ``max_results`` hits of each query.

    A query may hold a third of all hits, so its rows are never ranked in one
    task: page totals give the number of hits ahead of each page, and only the
    rows inside one page are ranked.  No page gives more rows than the largest
    cap, and that many are left of it before the shuffle.
    """
    ahead = Window.partitionBy("query_pos").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    pages = (
        page_sizes(hits)
        .withColumn("_ahead", F.coalesce(F.sum("page_size").over(ahead), F.lit(0)))
        .join(_sent_whole(specs.select("query_pos", "max_results"), bounds.queries), "query_pos")
        .filter(F.col("_ahead") < F.col("max_results"))
        .drop("page_size")
    )
    found = hits.join(_sent_whole(pages, bounds.queries * max_pages), ["query_pos", "page"])
    return (
        top_k_per_key(found, ["query_pos", "page"], [F.col("hit_pos")], bounds.max_results, "_in_page")
        .filter(F.col("_ahead") + F.col("_in_page") <= F.col("max_results"))
        .drop("_in_page", "_ahead", "max_results")
    )


def first_seen_across_queries(hits: DataFrame) -> DataFrame:
    """WIN-3 / SET-1: each repository once, from the earliest query."""
    return first_per_key(
        hits, ["full_name"], [F.col("query_pos"), F.col("page"), F.col("hit_pos")]
    )


def normalize_hits(hits: DataFrame, details: DataFrame | None = None) -> DataFrame:
    """JN-1 + PRJ-1: raw hits to repository rows, topics from the details."""
    if details is None:
        found = hits.withColumn("topics", F.lit(None).cast("array<string>"))
    else:
        found = hits.join(details.select("full_name", "topics"), "full_name", "left")
    return found.select(
        F.col("id").cast("string").alias("id"),
        "name",
        "full_name",
        "html_url",
        "description",
        "stargazers_count",
        "pushed_at",
        F.coalesce("archived", F.lit(False)).alias("archived"),
        F.coalesce("fork", F.lit(False)).alias("fork"),
        F.when(F.col("license").isNotNull(), F.struct(F.col("license.key").alias("key"))).alias("license"),
        F.coalesce("topics", F.array().cast("array<string>")).alias("topics"),
        F.struct(F.col("owner.login").alias("login")).alias("owner"),
    )


def collapse_hits(
    hits: DataFrame,
    specs: DataFrame,
    details: DataFrame | None = None,
    *,
    max_pages: int = MAX_PAGES,
    full_page: int = PAGE_SIZE,
    include_archived: bool = False,
    include_forks: bool = True,
) -> DataFrame:
    """CRL-1: paging, first seen per query, filters, cap, first seen overall.

    A few narrow columns of the hits of listed queries are written once to the scratch folder; paging, first seen and
    cap work on them.  What they leave is at most the sum of all caps, so the whole rows are fetched by
    position in a second scan and are never shuffled.  (query_pos, page, hit_pos) identifies a hit.
    """
    bounds = bounds_of(specs)
    position = ["query_pos", "page", "hit_pos"]
    listed = _sent_whole(specs.select("query_pos"), bounds.queries)
    seen = hits.filter(F.col("page") <= max_pages).join(listed, "query_pos", "left_semi")
    seen = materialize(seen.select(*position, "full_name", "stargazers_count", "archived", "fork"))
    seen = page_limit(seen, bounds, max_pages=max_pages, full_page=full_page)
    seen = first_seen_within_query(seen)
    seen = include_hits(seen, include_archived=include_archived, include_forks=include_forks)
    seen = min_stars(seen, specs, bounds)
    seen = cap_per_query(seen, specs, bounds, max_pages=max_pages)
    picked = first_seen_across_queries(seen).select(*position)
    found = hits.join(_sent_whole(picked, bounds.queries * bounds.max_results), position, "left_semi")
    return normalize_hits(found, details)


def repo_metadata(repos: DataFrame, contents: DataFrame, readmes: DataFrame) -> DataFrame:
    """CRL-2: README text and template-file flags per repository."""
    name, root = F.lower("name"), ~F.contains(F.col("path"), F.lit("/"))
    partials = F.col("path").rlike(r"^partials/[^/]+$")
    flags = contents.groupBy("full_name").agg(
        F.bool_or(root & name.endswith(".hbs")).alias("_root_hbs"),
        F.bool_or(root & (name == "partials")).alias("_partials"),
        F.bool_or(partials & name.endswith(".hbs")).alias("_partial_hbs"),
        F.bool_or(root & (name == "package.json")).alias("has_package_json"),
        F.bool_or(root & name.isin("index.hbs", "post.hbs", "default.hbs")).alias("has_theme_files"),
    )
    no = F.lit(False)
    return (
        repos.select("full_name")
        .join(readmes.select("full_name", F.col("text").alias("readme")), "full_name", "left")
        .join(flags, "full_name", "left")
        .select(
            "full_name",
            "readme",
            F.coalesce(F.col("_root_hbs") | (F.col("_partials") & F.col("_partial_hbs")), no).alias("has_template_files"),
            F.coalesce("has_package_json", no).alias("has_package_json"),
            F.coalesce("has_theme_files", no).alias("has_theme_files"),
        )
    )


def to_item(repos: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """PRJ-2: repository with score and confidence to catalog item, as "Theme".

    ``keep`` names further columns to carry along."""
    return _as_item(repos, F.lit("Theme"), keep)


def to_item_categorized(repos: DataFrame, *, official_owner: str) -> DataFrame:
    """PRJ-3: like ``to_item`` with the category read from owner, name,
    description and topics.  Topics are compared as written."""

    def hints_at(word: str):
        return (
            F.contains(F.lower("name"), F.lit(word))
            | F.coalesce(F.contains(F.lower("description"), F.lit(word)), F.lit(False))
            | F.coalesce(F.exists("topics", lambda t: F.contains(t, F.lit(word))), F.lit(False))
        )

    category = (
        F.when(F.lower("owner.login") == official_owner, F.lit("Official"))
        .when(hints_at("tool"), F.lit("Tool"))
        .when(hints_at("starter"), F.lit("Starter"))
        .otherwise(F.lit("Theme"))
    )
    return _as_item(repos, category)


def _as_item(repos: DataFrame, category: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    topics = F.coalesce("topics", F.array().cast("array<string>"))
    return repos.select(
        F.col("full_name").alias("id"),
        "name",
        F.col("full_name").alias("repo"),
        F.col("html_url").alias("url"),
        "description",
        category.alias("category"),
        topics.alias("tags"),
        F.col("stargazers_count").alias("stars"),
        "pushed_at",
        "archived",
        "fork",
        F.when(has_text("license.key"), F.col("license.key")).alias("license"),
        topics.alias("topics"),
        F.col("score").cast("int").alias("score"),
        "confidence",
        F.lit(None).cast("string").alias("notes"),
        F.lit(False).alias("hidden"),
        *keep,
    )
