"""Data-quality rules.  Every check yields rows, never an exception."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.columns import (
    contains_any,
    has_text,
    is_blank,
    is_json,
    is_url,
    parse_time,
)
from gleanery.operators.rules import split_patterns
from gleanery.profiles import CATEGORIES, CONFIDENCES, PAGE_PATTERNS
from gleanery.schemas import ITEM_COLUMNS, STALE_ITEM


def _first(findings: list[Column]) -> Column:
    return F.coalesce(*findings)


def _text(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit("null"))


def _outside(c: str, values: Iterable[str]) -> Column:
    return F.coalesce(~F.col(c).isin(*values), F.lit(True))


# ---- strict load checks: the first broken rule of a row ---------------------
def strict_item_error() -> Column:
    """VAL-1: the first rule an item breaks, or null.

    ``pushed_at`` may be text or a timestamp; text has to parse.
    """
    findings = [
        F.when(~has_text(c), F.lit(f"{c} is required and must be a string"))
        for c in ("id", "name", "repo", "url", "category")
    ]
    findings += [F.when(F.col(c).isNull(), F.lit(f"{c} must be an array")) for c in ("tags", "topics")]
    findings += [
        F.when(F.coalesce(F.col("stars") < 0, F.lit(True)), F.lit("stars must be a non-negative number")),
        F.when(
            F.coalesce((F.col("score") < 0) | (F.col("score") > 100), F.lit(True)),
            F.lit("score must be a number between 0 and 100"),
        ),
    ]
    findings += [F.when(F.col(c).isNull(), F.lit(f"{c} must be a boolean")) for c in ("archived", "fork", "hidden")]
    findings += [
        F.when(_outside("confidence", CONFIDENCES), F.lit("confidence must be one of: high, medium, low")),
        F.when(_outside("category", CATEGORIES), F.lit("category must be one of: Theme, Tool, Starter, Official")),
        F.when(
            parse_time(F.col("pushed_at").cast("string")).isNull(),
            F.lit("pushedAt must be a valid ISO date string"),
        ),
    ]
    return _first(findings)


def validate_items(items: DataFrame) -> DataFrame:
    """VAL-1: add ``error``; rows without one are fit to load."""
    return items.withColumn("error", strict_item_error())


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to load and rows to set aside."""
    return checked.filter(F.col("error").isNull()).drop("error"), checked.filter(F.col("error").isNotNull())


def require_valid(items: DataFrame, pos: str) -> DataFrame:
    """VAL-1 as a gate: reading the rows fails on the first broken one."""
    error = strict_item_error()
    message = F.concat(F.lit("Item "), F.col(pos), F.lit(": "), error)
    return items.filter(F.when(error.isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True))


def validate_overrides(overrides: DataFrame) -> DataFrame:
    """VAL-3; the other type rules are the schema's."""
    return overrides.withColumn("error", F.when(~has_text("repo"), F.lit("repo is required and must be a string")))


def validate_rules(rules: DataFrame) -> DataFrame:
    """VAL-4: values present and patterns that compile."""
    kind, pos = F.col("kind"), F.col("pos")
    checked = split_patterns(rules).withColumnRenamed("error", "_why")
    name = F.when(kind == "pattern", F.lit("patterns[")).otherwise(F.lit("repos["))
    return checked.withColumn(
        "error",
        F.when(F.col("value").isNull(), F.concat(name, pos, F.lit("] must be a string"))).when(
            (kind == "pattern") & F.col("_why").isNotNull(),
            F.concat(name, pos, F.lit("] must be a valid regex pattern")),
        ),
    ).drop("_why", "valid")


def validate_search_specs(specs: DataFrame) -> DataFrame:
    """VAL-5."""
    return specs.withColumn(
        "error",
        _first(
            [
                F.when(~has_text("query"), F.lit("query is required and must be a string")),
                F.when(F.coalesce(F.col("max_results") <= 0, F.lit(True)), F.lit("maxResults must be a positive number")),
                F.when(F.coalesce(F.col("min_stars") < 0, F.lit(True)), F.lit("minStars must be a non-negative number")),
            ]
        ),
    )


def validate_all(items: DataFrame, overrides: DataFrame, rules: DataFrame, specs: DataFrame) -> DataFrame:
    """VAL-7: the failures of the four inputs as (source, row_key, error)."""

    def failures(checked: DataFrame, source: str, key: str) -> DataFrame:
        return checked.filter(F.col("error").isNotNull()).select(
            F.lit(source).alias("source"), F.col(key).cast("string").alias("row_key"), "error"
        )

    return (
        failures(validate_items(items), "items", "id")
        .unionByName(failures(validate_overrides(overrides), "overrides", "pos"))
        .unionByName(failures(validate_rules(rules), "rules", "pos"))
        .unionByName(failures(validate_search_specs(specs), "sources", "query_pos"))
    )


# ---- consistency: every broken rule of a row --------------------------------
def _item(text: str, *more: Column) -> Column:
    return F.concat(F.lit("Item "), _text("id"), F.lit(text), *more)


def consistency_findings() -> Column:
    """VAL-2: array of (severity, rule, message) in rule order."""

    def finding(where: Column, severity: str, rule: str, message: Column) -> Column:
        return F.when(
            where,
            F.struct(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), message.alias("message")),
        )

    url_given = ~is_blank("url")
    return F.array_compact(
        F.array(
            finding(is_blank("id"), "error", "id", F.concat(F.lit("Item missing ID: "), F.to_json(F.struct(*ITEM_COLUMNS)))),
            finding(is_blank("name"), "error", "name", _item(" missing name")),
            finding(is_blank("repo"), "error", "repo", _item(" missing repo")),
            finding(~url_given, "error", "url", _item(" missing URL")),
            finding(url_given & ~is_url("url"), "error", "url_format", _item(" has invalid URL: ", _text("url"))),
            finding(is_blank("description"), "warning", "description", _item(" missing description")),
            finding(is_blank("category"), "error", "category", _item(" missing category")),
            finding(
                has_text("category") & _outside("category", CATEGORIES),
                "warning",
                "category_value",
                _item(" has non-standard category: ", _text("category")),
            ),
            finding(
                F.coalesce(F.col("stars") < 0, F.lit(True)), "error", "stars",
                _item(" has invalid stars count: ", _text("stars")),
            ),
            finding(
                F.coalesce((F.col("score") < 0) | (F.col("score") > 100), F.lit(True)), "error", "score",
                _item(" has invalid score: ", _text("score")),
            ),
            finding(
                _outside("confidence", CONFIDENCES), "error", "confidence",
                _item(" has invalid confidence: ", _text("confidence")),
            ),
            finding(F.col("tags").isNull(), "error", "tags", _item(" tags must be an array")),
            finding(F.col("topics").isNull(), "error", "topics", _item(" topics must be an array")),
            finding(F.col("archived").isNull(), "error", "archived", _item(" archived must be boolean")),
            finding(F.col("fork").isNull(), "error", "fork", _item(" fork must be boolean")),
            finding(F.col("hidden").isNull(), "error", "hidden", _item(" hidden must be boolean")),
        )
    )


def consistency_errors(items: DataFrame) -> DataFrame:
    """VAL-2: one row per finding."""
    return items.select("id", F.explode(consistency_findings()).alias("f")).select("id", "f.*")


def consistency_stats(items: DataFrame) -> DataFrame:
    """AGG-10."""
    given = ~is_blank("url")
    return items.agg(
        F.count(F.lit(1)).alias("total_items"),
        F.count_if(given & is_url("url")).alias("valid_urls"),
        F.count_if(given & ~is_url("url")).alias("invalid_urls"),
        F.count_if(is_blank("description")).alias("missing_descriptions"),
        F.count_if(is_blank("category")).alias("missing_categories"),
    )


# ---- state checks -----------------------------------------------------------
def missing_columns(state: DataFrame) -> list[str]:
    return [c for c in STALE_ITEM.fieldNames() if c not in state.columns]


def validate_state(state: DataFrame) -> DataFrame:
    """VAL-8: (severity, check, message) rows for a stale table.

    A missing column is a finding; the checks that do not read it go on.

    ``tags`` and ``topics`` may be arrays or JSON text; text has to parse.
    """
    spark = state.sparkSession
    absent = missing_columns(state)
    shape = "severity string, check string, message string"
    schema_findings = spark.createDataFrame(
        [("error", "columns", f"Missing required column: {c}") for c in absent], shape
    )
    text_lists = [c for c in ("tags", "topics") if dict(state.dtypes).get(c) == "string"]

    def finding(where: Column, check: str, message: Column) -> Column:
        return F.when(
            where,
            F.struct(F.lit("error").alias("severity"), F.lit(check).alias("check"), message.alias("message")),
        )

    def with_columns(names: str, make) -> list[Column]:
        """A check, if the columns that it reads are there."""
        return [] if set(names.split()) & set(absent) else [make()]

    item_id = _text("id") if "id" in state.columns else F.lit("unknown")
    numbers = [F.coalesce(F.col(c) < 0, F.lit(False)) for c in ("stars", "score", "months_stale") if c not in absent]
    rows = state.select(
        F.explode(
            F.array_compact(
                F.array(
                    F.lit(None).cast("struct<severity:string,check:string,message:string>"),
                    *[
                        finding(~is_json(c), c, F.concat(F.lit(f"Invalid JSON in {c} for item "), item_id))
                        for c in text_lists
                    ],
                    *with_columns(
                        "id name repo",
                        lambda: finding(
                            ~(has_text("id") & has_text("name") & has_text("repo")), "required",
                            F.concat(F.lit("Item missing required fields: "), F.coalesce(F.nullif("id", F.lit("")), F.lit("unknown"))),
                        ),
                    ),
                    *with_columns(
                        "stale_detected_at",
                        lambda: finding(
                            F.col("stale_detected_at").isNull(), "stale_detected_at",
                            F.concat(F.lit("Item missing staleDetectedAt: "), item_id),
                        ),
                    ),
                    *with_columns(
                        "months_stale",
                        lambda: finding(
                            F.coalesce(F.col("months_stale") < 0, F.lit(True)), "months_stale",
                            F.concat(F.lit("Item has invalid monthsStale: "), item_id),
                        ),
                    ),
                )
            )
        ).alias("f")
    ).select("f.*")
    negative = reduce(Column.__or__, numbers, F.lit(False))
    counted = (
        state.agg(F.count_if(negative).alias("n"))
        .filter("n > 0")
        .select(
            F.lit("error").alias("severity"),
            F.lit("negative").alias("check"),
            F.concat(F.lit("Found "), F.col("n"), F.lit(" items with negative numeric values")).alias("message"),
        )
    )
    return schema_findings.unionByName(rows).unionByName(counted)


# ---- pages ------------------------------------------------------------------
def page_lint(
    pages: DataFrame,
    *,
    html: str = "html",
    patterns: tuple[tuple[str, str, str], ...] = PAGE_PATTERNS,
    statistics_words: tuple[str, ...] = ("stale items", "average"),
    links: tuple[str, ...] = ("stale.html", "index.html"),
    max_tag_difference: int = 10,
    name: str | None = None,
) -> DataFrame:
    """VAL-10: flags and warnings per page; ``name`` tells in the link warnings which page it is.

    Adds a boolean per pattern, ``statistics``, the tag counts, ``balanced``, one
    ``links_<n>`` flag per link and the ordered ``warnings``.
    """
    text = F.col(html)
    checked = pages.withColumns(
        {
            **{f"has_{key}": F.coalesce(text.rlike(regex), F.lit(False)) for key, regex, _ in patterns},
            "has_statistics": F.coalesce(contains_any(text, statistics_words), F.lit(False)),
            "open_tags": F.coalesce(F.regexp_count(text, F.lit("<[^/][^>]*>")), F.lit(0)),
            "close_tags": F.coalesce(F.regexp_count(text, F.lit("</[^>]*>")), F.lit(0)),
            **{f"links_{i}": F.coalesce(F.contains(text, F.lit(link)), F.lit(False)) for i, link in enumerate(links)},
        }
    )
    balanced = F.abs(F.col("open_tags") - F.col("close_tags")) <= max_tag_difference
    warnings = [
        *[F.when(~F.col(f"has_{key}"), F.lit(f"{label} not found in HTML")) for key, _, label in patterns],
        F.when(~F.col("has_statistics"), F.lit("Statistics display not found in HTML")),
        F.when(
            ~balanced,
            F.concat(
                F.lit("HTML tag mismatch: "), F.col("open_tags"), F.lit(" open tags, "),
                F.col("close_tags"), F.lit(" close tags"),
            ),
        ),
        *[F.when(~F.col(f"links_{i}"), F.lit(f"Link to {link} not found" + (f" in {name}" if name else ""))) for i, link in enumerate(links)],
    ]
    return checked.withColumn("balanced", balanced).withColumn("warnings", F.array_compact(F.array(*warnings)))


def site_findings(pages: DataFrame) -> DataFrame:
    """VAL-10 by role: (severity, check, page_id, message) for pages with a ``role``, "stale" or "index".

    Title, warning, headers, statistics, tags and the link back belong to the stale page, the link to it to the index
    page; a role without a page is a finding of its own.
    """
    stale = page_lint(pages.filter("role = 'stale'"), links=("index.html",), name="stale.html")
    index = pages.filter((F.col("role") == "index") & ~F.coalesce(F.contains("html", F.lit("stale.html")), F.lit(False)))
    absent = pages.agg(F.count_if(F.col("role") == "stale").alias("stale"), F.count_if(F.col("role") == "index").alias("index"))

    def missing(role: str, severity: str, message: str) -> DataFrame:
        return absent.filter(F.col(role) == 0).select(F.lit(severity), F.lit("page"), F.lit(None).cast(kind), F.lit(message))

    kind = pages.schema["page_id"].dataType
    warning = F.lit("warning").alias("severity"), F.lit("page").alias("check"), F.col("page_id")
    found = stale.select("page_id", F.explode("warnings").alias("message")).select(*warning, "message")
    found = found.union(index.select(*warning, F.lit("Link to stale.html not found in index.html").alias("message")))
    found = found.union(missing("stale", "error", "Stale HTML file not found: stale.html"))
    return found.union(missing("index", "warning", "Main index file not found: index.html"))
