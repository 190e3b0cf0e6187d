"""Weighted, explainable scoring of repositories."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.columns import (
    clamp,
    contains_any,
    count_words,
    has_text,
    is_blank,
    join_words,
    matching,
    points,
    round_half_up,
    strip,
    total,
    two_years_before,
)
from gleanery.operators.structure import structure_reasons, structure_signal
from gleanery.profiles import LIBRARY_PROFILE, ScoringProfile, Thresholds

# ---- fixed values: words looked for in a README ---------------------------
_SETUP_WORDS = ("install", "setup", "download")
_DEMO_WORDS = ("demo", "preview", "live")
_IMAGE_MARKS = ("![", "<img")
_UNFINISHED_WORDS = ("work in progress", "wip")
_ABANDONED_WORDS = ("not maintained", "deprecated")
_PERSONAL_WORDS = ("personal project", "learning")


def with_search_text(repos: DataFrame, profile: ScoringProfile = LIBRARY_PROFILE) -> DataFrame:
    """Lower-cased texts and matched topics, computed once per row.

    ``repos`` has name, description, topics and readme.
    """
    return repos.withColumns(
        {
            "_text": F.lower("readme"),
            "_name": F.lower("name"),
            "_label": F.lower(F.concat_ws(" ", "name", F.coalesce("description", F.lit("")))),
            "_domain": F.coalesce(matching("topics", profile.domain_keywords), F.array().cast("array<string>")),
            "_theme": F.coalesce(matching("topics", profile.theme_keywords), F.array().cast("array<string>")),
        }
    )


# ---- signals, over the columns of ``with_search_text`` ---------------------
def topic_signal() -> Column:
    """CLS-1."""
    domain, theme = F.size("_domain"), F.size("_theme")
    score = (
        points(domain > 0, 60)
        + F.least(theme * 15, F.lit(40))
        + points((domain > 0) & (theme > 0), 10)
    )
    return F.least(score, F.lit(100))


def text_signal(profile: ScoringProfile = LIBRARY_PROFILE) -> Column:
    """CLS-2."""
    score = total(
        [
            points(contains_any("_text", profile.domain_keywords), 50),
            F.least(count_words("_text", profile.theme_keywords) * 8, F.lit(30)),
            points(contains_any("_text", _SETUP_WORDS), 15),
            points(contains_any("_text", _DEMO_WORDS), 10),
            points(contains_any("_text", _IMAGE_MARKS), 5),
        ]
    )
    return F.when(has_text("_text"), F.least(score, F.lit(100))).otherwise(F.lit(0))


def penalty_signal(as_of: datetime | Column, profile: ScoringProfile = LIBRARY_PROFILE) -> Column:
    """CLS-7."""
    stars = F.col("stargazers_count")
    return total(
        [
            points(F.col("archived"), 60),
            points(F.col("pushed_at") < two_years_before(as_of), 25),
            F.when(stars < 3, 20).when(stars < 10, 10).otherwise(0),
            count_words("_name", profile.non_theme_words) * 8,
            count_words("_label", profile.penalty_keywords) * 12,
            count_words("_text", profile.penalty_keywords) * 6,
            points(contains_any("_text", _UNFINISHED_WORDS), 15),
            points(contains_any("_text", _ABANDONED_WORDS), 25),
            points(contains_any("_text", _PERSONAL_WORDS), 10),
            points(F.col("fork"), 15),
            points(is_blank("description"), 8),
            points(has_text("description") & (F.length(strip("description")) < 20), 5),
        ]
    )


def weighted_score(
    topics: Column, readme: Column, structure: Column, penalties: Column, profile: ScoringProfile = LIBRARY_PROFILE
) -> Column:
    """CLS-8: double arithmetic in this term order, half-up, 0..100."""
    w = profile.weights

    def part(signal: Column, weight: float) -> Column:
        return signal.cast("double") * F.lit(weight)

    raw = (
        part(topics, w.topics) + part(readme, w.readme) + part(structure, w.structure) - part(penalties, w.penalties)
    )
    return clamp(round_half_up(raw), 0, 100).cast("int")


def confidence_bucket(score: Column, thresholds: Thresholds = LIBRARY_PROFILE.thresholds) -> Column:
    """CLS-9."""
    return (
        F.when(score >= thresholds.high, "high").when(score >= thresholds.medium, "medium").otherwise("low")
    )


# ---- explanations ----------------------------------------------------------
def topic_reasons(profile: ScoringProfile) -> list[Column]:
    label = profile.domain_label
    none = F.coalesce(F.size("topics") <= 0, F.lit(True))
    domain, theme = F.size("_domain") > 0, F.size("_theme") > 0
    return [
        F.when(none, F.lit("No GitHub topics found")),
        F.when(domain, F.concat(F.lit(f"Found {label}-specific topics: "), F.array_join("_domain", ", "))),
        F.when(theme, F.concat(F.lit("Found theme-related topics: "), F.array_join("_theme", ", "))),
        F.when(domain & theme, F.lit("Multiple relevant topic categories found")),
    ]


def text_reasons(profile: ScoringProfile) -> list[Column]:
    label = profile.domain_label
    shown = F.array_join(
        F.slice(F.split(join_words("_text", profile.theme_keywords, ","), ","), 1, 5), ", "
    )
    return [
        F.when(~has_text("_text"), F.lit("No README found")),
        F.when(
            contains_any("_text", profile.domain_keywords),
            F.concat(F.lit(f"README mentions {label}: "), join_words("_text", profile.domain_keywords)),
        ),
        F.when(
            contains_any("_text", profile.theme_keywords),
            F.concat(F.lit("README contains theme keywords: "), shown),
        ),
        F.when(contains_any("_text", _SETUP_WORDS), F.lit("Contains installation/setup instructions")),
        F.when(contains_any("_text", _DEMO_WORDS), F.lit("Contains demo/preview links")),
        F.when(contains_any("_text", _IMAGE_MARKS), F.lit("Contains images/screenshots")),
    ]


def penalty_reasons(as_of: datetime | Column, profile: ScoringProfile) -> list[Column]:
    stars = F.col("stargazers_count")

    def listed(source: str, words: tuple[str, ...], text: str) -> Column:
        return F.when(contains_any(source, words), F.concat(F.lit(text), join_words(source, words)))

    return [
        F.when(F.col("archived"), F.lit("Repository is archived (major penalty)")),
        F.when(
            F.col("pushed_at") < two_years_before(as_of),
            F.concat(F.lit("No activity since "), F.date_format("pushed_at", "EEE MMM dd yyyy")),
        ),
        F.when(stars < 3, F.concat(F.lit("Very low star count: "), stars)).when(
            stars < 10, F.concat(F.lit("Low star count: "), stars)
        ),
        listed("_name", profile.non_theme_words, "Repository name suggests non-theme: "),
        listed("_label", profile.penalty_keywords, "Contains penalty keywords: "),
        listed("_text", profile.penalty_keywords, "README contains penalty keywords: "),
        F.when(contains_any("_text", _UNFINISHED_WORDS), F.lit("README indicates work in progress")),
        F.when(contains_any("_text", _ABANDONED_WORDS), F.lit("README indicates project is not maintained")),
        F.when(contains_any("_text", _PERSONAL_WORDS), F.lit("README indicates personal/learning project")),
        F.when(F.col("fork"), F.lit("Repository is a fork")),
        F.when(is_blank("description"), F.lit("No repository description provided")),
        F.when(
            has_text("description") & (F.length(strip("description")) < 20),
            F.lit("Very short repository description"),
        ),
    ]


def reasoning(as_of: datetime | Column, profile: ScoringProfile = LIBRARY_PROFILE) -> Column:
    """CLS-10: all explanations in signal order, each with its prefix."""
    groups = (
        ("Topics: ", topic_reasons(profile)),
        ("README: ", text_reasons(profile)),
        ("Structure: ", structure_reasons(profile.domain_label)),
        ("Penalty: ", penalty_reasons(as_of, profile)),
    )
    return F.array_compact(
        F.array(*[F.concat(F.lit(prefix), r) for prefix, reasons in groups for r in reasons])
    )


def classify(
    repos: DataFrame, as_of: datetime | Column, profile: ScoringProfile = LIBRARY_PROFILE
) -> DataFrame:
    """CLS-8..11: add signals, score, confidence and reasoning to each row.

    ``repos`` carries the columns of ``structure.with_structure`` and ``readme``.
    Every part is a column expression, so a reader that does not select the
    explanations does not pay for them.
    """
    extra = ("_text", "_name", "_label", "_domain", "_theme")
    scored = with_search_text(repos, profile).withColumn(
        "signals",
        F.struct(
            topic_signal().alias("topics"),
            text_signal(profile).alias("readme"),
            structure_signal().alias("structure"),
            penalty_signal(as_of, profile).alias("penalties"),
        ),
    )
    score = weighted_score(
        F.col("signals.topics"), F.col("signals.readme"), F.col("signals.structure"), F.col("signals.penalties"), profile
    )
    return (
        scored.withColumn("score", score)
        .withColumn("confidence", confidence_bucket(F.col("score"), profile.thresholds))
        .withColumn("reasoning", reasoning(as_of, profile))
        .drop(*extra)
    )


def score_gate(items: DataFrame, min_score: int = LIBRARY_PROFILE.min_score) -> DataFrame:
    """FLT-6.  The row number keeps the filter above the projection that works the score out; pushed below it, every
    text would be searched twice."""
    numbered = items.withColumn("_at", F.monotonically_increasing_id())
    return numbered.filter((F.col("score") >= min_score) & (F.col("_at") >= 0)).drop("_at")


