"""Ranked report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions.columns import has_text, long_date, text_or
from gleanery.functions.ranking import number_rows, top_k_per_key
from gleanery.profiles import CATEGORY_HEADINGS, USE_CASES, UseCase

OTHER = "Other"


def is_visible() -> Column:
    return ~F.coalesce("hidden", F.lit(False))


def visible(items: DataFrame) -> DataFrame:
    """FLT-7."""
    return items.filter(is_visible())


# ---- order -----------------------------------------------------------------
def catalog_order(items: DataFrame) -> DataFrame:
    """SRT-1."""
    return items.orderBy(F.desc("stars"), F.asc("repo"))


def category_rank(category: str | Column = "category") -> Column:
    """Position in the report; categories without a heading come after the rest."""
    c = F.col(category) if isinstance(category, str) else category
    rank = F
    for i, (name, _) in enumerate(CATEGORY_HEADINGS, start=1):
        rank = rank.when(c == name, F.lit(i))
    return rank.otherwise(F.lit(len(CATEGORY_HEADINGS) + 1))


def category_heading(category: str | Column = "category") -> Column:
    c = F.col(category) if isinstance(category, str) else category
    heading = F
    for name, text in CATEGORY_HEADINGS:
        heading = heading.when(c == name, F.lit(text))
    return heading.otherwise(F.concat(F.upper(c), F.lit(" THEMES")))


def category_order(items: DataFrame, *, others_first: bool = False) -> DataFrame:
    """SRT-4.  Categories without a heading come last, or first where asked for."""
    rank = category_rank()
    if others_first:
        rank = rank % (len(CATEGORY_HEADINGS) + 1)
    return items.orderBy(rank, F.asc("category"), F.desc("stars"), F.asc("id"))


# ---- summary ---------------------------------------------------------------
def catalog_summary(items: DataFrame) -> DataFrame:
    """AGG-3: one row with totals and counts per category of the visible items."""
    per_category = (
        visible(items)
        .groupBy(text_or("category", OTHER).alias("category"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("stars").alias("s"))
    )
    return per_category.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_items"),
        F.coalesce(F.sum("s"), F.lit(0)).alias("total_stars"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "n")))).alias("category_counts"),
    )


def top_by_stars(items: DataFrame, k: int = 10) -> DataFrame:
    """SRT-2."""
    return visible(items).orderBy(F.desc("stars"), F.asc("id")).limit(k).select("id", "name", "stars")


def recently_updated(items: DataFrame, k: int = 10) -> DataFrame:
    """SRT-3."""
    return (
        visible(items)
        .filter(F.col("pushed_at").isNotNull())
        .orderBy(F.desc("pushed_at"), F.desc("stars"), F.asc("id"))
        .limit(k)
        .select("id", "name", "pushed_at")
    )


# ---- groups ----------------------------------------------------------------
def category_groups(items: DataFrame) -> DataFrame:
    """RPT-1 / WIN-7: visible items with heading, category rank and rank in it.

    There are only a few categories, so the numbering is the one that splits a
    group over tasks.
    """
    shown = visible(items).withColumn("category", text_or("category", OTHER))
    shown = shown.withColumn("category_rank", category_rank()).withColumn("category_name", category_heading())
    return number_rows(
        shown, ["category_rank", "category_name"], [F.desc("stars"), F.asc("id")], "item_rank"
    )


def _belongs(case: UseCase) -> Column:
    parts = []
    if case.tag_parts:
        parts.append(
            F.exists("tags", lambda t: _any([F.contains(F.lower(t), F.lit(p)) for p in case.tag_parts]))
        )
    if case.tags:
        parts.append(F.exists("tags", lambda t: F.lower(t).isin(*case.tags)))
    for p in case.description_parts:
        parts.append(F.contains(F.lower("description"), F.lit(p)))
    if case.names:
        parts.append(F.col("name").isin(*case.names))
    return _any([F.coalesce(p, F.lit(False)) for p in parts])


def _any(parts: list[Column]) -> Column:
    found = parts[0]
    for p in parts[1:]:
        found = found | p
    return found


def short_description() -> Column:
    """RPT-3."""
    sentence = F.split_part("description", F.lit("."), F.lit(1))
    short = F.when(F.length(sentence) > 50, F.concat(F.substring("description", 1, 50), F.lit("..."))).otherwise(sentence)
    return (
        F.when(has_text("notes"), F.col("notes"))
        .when(has_text("description"), short)
        .otherwise(F.concat("category", F.lit(" theme")))
    )


def use_case_lists(items: DataFrame, cases: tuple[UseCase, ...] = USE_CASES) -> DataFrame:
    """RPT-2 / WIN-6: the top items of each labelled list, hidden ones too.

    An item may be in several lists.  Lists that stay empty have no rows.
    """
    labels = F.array_compact(
        F.array(
            *[
                F.when(
                    _belongs(case),
                    F.struct(F.lit(i).alias("label_pos"), F.lit(case.label).alias("label"), F.lit(case.top).alias("top")),
                )
                for i, case in enumerate(cases, start=1)
            ]
        )
    )
    listed = items.select(
        "id", "name", "stars", short_description().alias("description"), F.explode(labels).alias("l")
    ).select("id", "name", "stars", "description", "l.*")
    widest = max(case.top for case in cases)
    return (
        top_k_per_key(listed, ["label_pos", "label"], [F.desc("stars"), F.asc("id")], widest, "rank")
        .filter(F.col("rank") <= F.col("top"))
        .select("label_pos", "label", "rank", "id", "name", "description", "stars")
    )


# ---- rows ------------------------------------------------------------------
def _note_text() -> Column:
    return F.concat_ws("; ", F.nullif("description", F.lit("")), F.nullif("notes", F.lit("")))


def directory_rows(items: DataFrame) -> DataFrame:
    """RPT-4: the visible rows of the directory, to be written in category order."""
    return visible(items).select(
        "id", "name", "url", "stars", "category", _note_text().alias("notes")
    )


def _last_updated() -> Column:
    months = F.col("months_stale")
    ago = F.when(months > 0, F.concat(F.lit(" ("), months, F.lit(" months ago)")))
    return F.concat(F.coalesce(long_date("pushed_at"), F.lit("")), F.coalesce(ago, F.lit("")))


def stale_rows(stale: DataFrame) -> DataFrame:
    """RPT-5: visible stale items with their last update; tools apart from themes."""
    return visible(stale).select(
        "id",
        F.when(F.col("category") == "Tool", F.lit("tool")).otherwise(F.lit("theme")).alias("section"),
        "name",
        "url",
        "stars",
        text_or("category", OTHER).alias("category"),
        _last_updated().alias("last_updated"),
        _note_text().alias("notes"),
    )


def report_tools(stale: DataFrame) -> DataFrame:
    """PRJ-7: the tools of the stale report."""
    return (
        visible(stale)
        .filter(F.col("category") == "Tool")
        .select(
            "id", "name", "url",
            F.coalesce("description", F.lit("")).alias("description"),
            long_date("pushed_at").alias("pushed_at"),
            "months_stale",
        )
    )


def run_metrics(**counts: DataFrame) -> DataFrame:
    """AGG-13: one row per named table with its number of rows."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("metric"), "n")
        for name, df in counts.items()
    ]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return found


def metric_rows(spark: SparkSession, counted: dict[str, int]) -> DataFrame:
    """AGG-13 from numbers that were counted as the tables were written."""
    return spark.createDataFrame(list(counted.items()), "metric string, n long")
