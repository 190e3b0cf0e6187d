"""Catalog rows from the first HTML table of each page."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions import html
from gleanery.functions.columns import clamp, contains_any, has_text, moment, points, strip, total
from gleanery.profiles import WEB_BASE_TAG, WEB_FEATURE_TAGS

# The number of stars as it is written in a cell. Fixed value.
_STARS = r"(?i)(\d+(?:[.,]\d+)?)\s*k?\s*stars?"


def cell_text(cell: Column) -> Column:
    return html.text_of(cell)


def link_target(cell: Column) -> Column:
    """The trimmed href of the first link, null without one."""
    return F.nullif(strip(html.attribute(F.get(html.start_tags(cell, "a"), F.lit(0)), "href")), F.lit(""))


def _cut(pages: DataFrame, page_id: str, html_column: str) -> DataFrame:
    return pages.select(F.col(page_id).alias("page_id"), html.tokens(html_column).alias("_tokens"))


def _rows() -> Column:
    return F.transform(html.first_table(F.col("_tokens")), lambda cells, i: F.struct(i.alias("row_pos"), cells.alias("cells")))


def page_rows(pages: DataFrame, *, page_id: str = "page_id", html_column: str = "html") -> DataFrame:
    """WEB-1: for each page the ``rows`` of its first table, each with the HTML of its cells.

    A page is one string, so its rows are at hand in one record; nothing is shuffled.
    """
    return _cut(pages, page_id, html_column).select("page_id", _rows().alias("rows"))


def table_rows(pages: DataFrame, *, page_id: str = "page_id", html_column: str = "html") -> DataFrame:
    """WEB-1: the same, one row each.

    The rows are unfolded where they are made: for a column that is unfolded, Spark adds a filter on its size and on null,
    which would read every page two times more.
    """
    return _cut(pages, page_id, html_column).select("page_id", F.inline(_rows()))


def category_from_header(text: Column) -> Column:
    """WEB-2."""
    t = F.upper(text)
    return (
        F.when(contains_any(t, ("OFFICIAL", "TRYGHOST")), "Official")
        .when(contains_any(t, ("TOOL", "RESOURCE")), "Tool")
        .when(contains_any(t, ("STARTER", "DEVELOPMENT")), "Starter")
        .otherwise("Theme")
    )


def fill_category_down(paged: DataFrame, *, default: str = "Other") -> DataFrame:
    """WIN-8: a one-cell row names the category of the rows below it.

    Within the record of a page: its header rows cut ``rows`` into slices, and each slice takes the category of its header.
    """

    def slices(heads: Column) -> Column:
        def one(head: Column, i: Column) -> Column:
            end = F.coalesce(F.get(heads, i + 1)["pos"], F.size("rows"))
            some = F.slice("rows", head["pos"] + 1, end - head["pos"])
            return F.transform(some, lambda r: F.struct(r["row_pos"].alias("row_pos"), r["cells"].alias("cells"), head["category"].alias("category")))

        return F.flatten(F.transform(heads, one))

    start = F.array(F.struct(F.lit(0).alias("pos"), F.lit(default).alias("category")))
    headers = F.transform(
        F.filter("rows", lambda r: F.size(r["cells"]) == 1),
        lambda r: html.let(
            cell_text(F.get(r["cells"], F.lit(0))), lambda t: F.struct(r["row_pos"].alias("pos"), category_from_header(t).alias("category"))
        ),
    )
    return paged.select("page_id", F.inline(html.let(F.concat(start, headers), slices)))


def extract_rows(pages: DataFrame, *, page_id: str = "page_id", html_column: str = "html") -> DataFrame:
    """WEB-1: data rows (three cells or more) with their category."""
    return fill_category_down(page_rows(pages, page_id=page_id, html_column=html_column)).filter(F.size("cells") >= 3)


def star_count(text: Column, *, thousands: bool = False) -> Column:
    """The number before "stars".  The letter k is not read unless ``thousands``."""
    number = F.replace(F.regexp_extract(text, _STARS, 1), F.lit(","), F.lit(""))
    whole = F.regexp_extract(number, r"^\d+", 0).try_cast("long")
    if thousands:
        in_k = F.regexp_extract(text, _STARS, 0).rlike(r"(?i)\d\s*k")
        scaled = F.floor(number.try_cast("double") * 1000 + F.lit(0.5))
        whole = F.when(in_k, scaled).otherwise(whole)
    return F.coalesce(whole, F.lit(0))


def row_description(text: Column) -> Column:
    """The text before the star count, up to the first semicolon."""
    stars = F.regexp_extract(text, _STARS, 0)
    before = F.when(stars != "", strip(F.split_part(text, stars, F.lit(1)))).otherwise(text)
    return F.when(F.contains(before, F.lit(";")), strip(F.split_part(before, F.lit(";"), F.lit(1)))).otherwise(before)


def feature_tags(category: Column, description: Column, notes: Column) -> Column:
    """WEB-4."""
    content = F.lower(F.concat_ws(" ", F.coalesce(description, F.lit("")), F.coalesce(notes, F.lit(""))))
    return F.array_distinct(
        F.array_compact(
            F.array(
                F.lit(WEB_BASE_TAG),
                F.when(category == "Official", F.lit("official")),
                *[F.when(contains_any(content, words), F.lit(tag)) for tag, words in WEB_FEATURE_TAGS],
            )
        )
    )


def legacy_score(stars: Column, category: Column, description: Column) -> Column:
    """WEB-5."""
    by_stars = (
        F.when(stars > 2000, 30).when(stars > 1000, 25).when(stars > 500, 20)
        .when(stars > 100, 15).when(stars > 50, 10).when(stars > 10, 5).otherwise(0)
    )
    by_category = F.when(category == "Official", 15).when(category == "Tool", 10).otherwise(0)
    return clamp(total([F.lit(50), by_stars, by_category, points(F.length(description) > 20, 5)]), 0, 100)


def clean_notes(notes: Column) -> Column:
    """WEB-6."""
    text = F.regexp_replace(notes, r"(?i)\d+(?:[.,]\d+)?k?\s*stars?[;,]?\s*", "")
    text = F.regexp_replace(text, r"^[;,\s]+", "")
    text = F.regexp_replace(text, r"[;,\s]+$", "")
    return F.when(F.length(text) >= 5, text)


def row_items(rows: DataFrame, as_of: datetime | Column, *, thousands: bool = False) -> DataFrame:
    """WEB-3: items of the data rows, with ``problem`` set where a row is rejected."""
    read = rows.select(
        "page_id",
        "row_pos",
        "category",
        cell_text(F.get("cells", F.lit(0))).alias("name"),
        link_target(F.get("cells", F.lit(1))).alias("url"),
        cell_text(F.get("cells", F.lit(2))).alias("_notes"),
    )
    read = read.withColumns(
        {
            "repo": F.nullif(F.regexp_extract("url", r"github\.com/([^/]+/[^/]+)", 1), F.lit("")),
            "stars": star_count(F.col("_notes"), thousands=thousands),
            "_description": row_description(F.col("_notes")),
        }
    )
    empty = F.array().cast("array<string>")
    stars, category, description = F.col("stars"), F.col("category"), F.col("_description")
    return read.select(
        "page_id",
        "row_pos",
        F.when(
            ~has_text("name") | F.col("url").isNull(),
            F.concat(
                F.lit("Skipping row with missing name or URL: "),
                F.coalesce(F.nullif("name", F.lit("")), F.lit("unnamed")),
            ),
        )
        .when(F.col("repo").isNull(), F.concat(F.lit("Invalid GitHub URL: "), F.col("url")))
        .alias("problem"),
        F.col("repo").alias("id"),
        "name",
        "repo",
        "url",
        F.nullif(description, F.lit("")).alias("description"),
        "category",
        feature_tags(category, description, F.col("_notes")).alias("tags"),
        "stars",
        moment(as_of).alias("pushed_at"),
        F.lit(False).alias("archived"),
        F.lit(False).alias("fork"),
        F.lit(None).cast("string").alias("license"),
        empty.alias("topics"),
        legacy_score(stars, category, description).alias("score"),
        F.when(stars > 1000, "high").when(stars > 100, "medium").otherwise("low").alias("confidence"),
        clean_notes(F.col("_notes")).alias("notes"),
        F.lit(False).alias("hidden"),
    )


def web_items(read: DataFrame) -> DataFrame:
    """WEB-7: the accepted rows.  The test is on the fields and not on ``problem``:
    filters move below the texts they are made of, and this one is the cheaper."""
    return read.filter(has_text("name") & F.col("repo").isNotNull()).drop("problem")


def web_warnings(read: DataFrame) -> DataFrame:
    return read.filter(F.col("problem").isNotNull()).select("page_id", "row_pos", F.col("problem").alias("message"))


def migration_category_counts(items: DataFrame) -> DataFrame:
    """AGG-12."""
    return items.groupBy("category").agg(F.count(F.lit(1)).alias("items"))


def page_links(pages: DataFrame, *, page_id: str = "page_id", html_column: str = "html") -> DataFrame:
    """Targets of all links of each page with their position among the links; links without a target are passed over."""
    targets = F.transform(html.start_tags(html_column, "a"), lambda tag: html.attribute(tag, "href"))
    return pages.select(F.col(page_id).alias("page_id"), F.posexplode(F.filter(targets, lambda x: x.isNotNull())).alias("row_pos", "url"))
