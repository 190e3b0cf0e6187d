"""Merging a new snapshot into the previous catalog, and comparing snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.columns import has_any_topic, json_array_text
from gleanery.functions.ranking import first_per_key
from gleanery.operators.hits import to_item
from gleanery.operators.rules import latest_overrides, match_rules, matcher, overridden
from gleanery.profiles import DOMAIN_TOPICS, OFFICIAL_OWNER
from gleanery.schemas import ITEM_COLUMNS

KEPT_OUTCOMES = ("added", "updated", "kept")


def one_per_key(items: DataFrame, key: str, pos: str | None) -> DataFrame:
    """Repeated keys resolve to the last listed row; skipped when ``pos`` is None
    because the caller's keys are unique."""
    return items if pos is None else first_per_key(items, [key], [F.desc(pos)])


def valid_existing(
    *,
    topics: tuple[str, ...] = DOMAIN_TOPICS,
    owner: str = OFFICIAL_OWNER,
    min_score: int = 50,
    prefix: str = "",
) -> Column:
    """FLT-5: reasons to keep an item that was not seen again."""
    return (
        has_any_topic(f"{prefix}topics", topics)
        | F.lower(f"{prefix}repo").startswith(f"{owner}/")
        | F.coalesce(F.col(f"{prefix}score") >= min_score, F.lit(False))
    )


def merge_outcomes(
    existing: DataFrame,
    new: DataFrame,
    overrides: DataFrame,
    rules: DataFrame,
    *,
    topics: tuple[str, ...] = DOMAIN_TOPICS,
    owner: str = OFFICIAL_OWNER,
    min_score: int = 50,
    new_pos: str | None = None,
    existing_pos: str | None = None,
    domain_label: str = "Ghost",
) -> DataFrame:
    """MRG-1: every repository of either side with its outcome.

    Columns: the item after overrides, ``outcome`` (added, updated, kept,
    ignored, hidden, unclassified, removed_rule, removed_invalid), ``change``
    (added, updated, removed, ignored or null) and ``details``.

    ``new`` may carry a boolean ``classified``; false drops the row (MRG-2).
    """
    flagged = "classified" in new.columns
    new = one_per_key(new, "repo", new_pos)
    existing = one_per_key(existing, "repo", existing_pos)
    ready, patches = matcher(rules), latest_overrides(overrides)

    def side(table: DataFrame, name: str, *more: Column) -> DataFrame:
        """One snapshot with its rule and override.  They are joined before the
        snapshots meet: a left join keeps the partitioning by repository, so the
        wide rows move once even where rules and overrides are too big to send."""
        rows = table.select(F.col("repo").alias(f"{name}_repo"), F.struct(*ITEM_COLUMNS).alias(name), *more)
        rows = match_rules(rows, ready, f"{name}_repo").drop("rule_value")
        rows = rows.withColumnRenamed("rule_kind", f"{name}_rule")
        rows = rows.join(patches, F.col(f"{name}_repo") == F.col("_ov_repo"), "left").drop("_ov_repo")
        return rows.withColumnRenamed("_ov", f"{name}_ov")

    classified = F.col("classified") if flagged else F.lit(True)
    new_side = side(new, "_n", classified.alias("_classified"))
    both = new_side.join(side(existing, "_e"), F.col("_n_repo") == F.col("_e_repo"), "full_outer")

    seen, known = F.col("_n_repo").isNotNull(), F.col("_e_repo").isNotNull()
    patched = both.select(
        *[F.when(seen, F.col(f"_n.{c}")).otherwise(F.col(f"_e.{c}")).alias(c) for c in ITEM_COLUMNS],
        "_e",
        F.coalesce("_n_ov", "_e_ov").alias("_ov"),
        F.coalesce("_n_rule", "_e_rule").alias("rule_kind"),
        "_classified",
        seen.alias("_seen"),
        known.alias("_known"),
    ).select(
        *overridden(ITEM_COLUMNS),
        F.col("_e.stars").alias("_old_stars"),
        F.col("_e.score").alias("_old_score"),
        "rule_kind",
        "_classified",
        "_seen",
        "_known",
    )

    ruled = F.col("rule_kind").isNotNull()
    outcome = (
        F.when(F.col("_seen") & ruled, "ignored")
        .when(F.col("_seen") & ~F.coalesce("_classified", F.lit(False)), "unclassified")
        .when(F.col("_seen") & F.coalesce("hidden", F.lit(False)), "hidden")
        .when(F.col("_seen") & F.col("_known"), "updated")
        .when(F.col("_seen"), "added")
        .when(ruled, "removed_rule")
        .when(~valid_existing(topics=topics, owner=owner, min_score=min_score), "removed_invalid")
        .otherwise("kept")
    )
    found = patched.withColumn("outcome", outcome)
    return found.select(
        *ITEM_COLUMNS,
        "outcome",
        change_type().alias("change"),
        change_details(min_score=min_score, domain_label=domain_label, with_topics=not flagged).alias("details"),
    )


def change_type() -> Column:
    o = F.col("outcome")
    return (
        F.when(o.isin("added", "updated"), o)
        .when(o.isin("ignored", "hidden"), "ignored")
        .when(o.startswith("removed"), "removed")
    )


def change_details(*, min_score: int, domain_label: str, with_topics: bool) -> Column:
    """MRG-3: the text of the change log.  The wording is fixed."""
    o = F.col("outcome")
    if with_topics:
        invalid = F.concat(
            F.lit(f"Existing item removed: no {domain_label} topic (topics: "),
            json_array_text("topics"),
            F.lit(") and score "),
            F.col("score"),
            F.lit(f" < {min_score}"),
        )
    else:
        invalid = F.concat(
            F.lit(f"Existing item removed: no {domain_label} topic and score "),
            F.col("score"),
            F.lit(f" < {min_score}"),
        )
    return (
        F.when(o == "ignored", F.lit("Repository matches ignore rules"))
        .when(o == "hidden", F.lit("Repository hidden by override rules"))
        .when(
            o == "updated",
            F.concat(
                F.lit("Updated: stars "), F.col("_old_stars"), F.lit(" → "), F.col("stars"),
                F.lit(", score "), F.col("_old_score"), F.lit(" → "), F.col("score"),
            ),
        )
        .when(
            o == "added",
            F.concat(
                F.lit("Added: "), F.col("category"), F.lit(" with "), F.col("stars"),
                F.lit(" stars, score "), F.col("score"),
            ),
        )
        .when(o == "removed_rule", F.lit("Existing item removed: matches ignore rules"))
        .when(o == "removed_invalid", invalid)
    )


def merged_items(outcomes: DataFrame) -> DataFrame:
    """The catalog after the merge; order it with ``catalog_order`` when writing."""
    return outcomes.filter(F.col("outcome").isin(*KEPT_OUTCOMES)).select(*ITEM_COLUMNS)


def change_log(outcomes: DataFrame) -> DataFrame:
    """One row per repository that was added, updated, removed or ignored."""
    return outcomes.filter(F.col("change").isNotNull()).select(F.col("change").alias("type"), "repo", "details")


def change_stats(outcomes: DataFrame) -> DataFrame:
    """AGG-4: one row of counters."""
    return outcomes.agg(
        *[F.count_if(F.col("change") == c).alias(c) for c in ("added", "updated", "removed", "ignored")]
    )


def merge_classified(
    existing: DataFrame,
    repos: DataFrame,
    classified: DataFrame,
    overrides: DataFrame,
    rules: DataFrame,
    **options,
) -> DataFrame:
    """MRG-2 / JN-4: merge raw repositories with their classification.

    A repository without classification is dropped, and so is its old version.
    """
    scored = repos.join(
        classified.select("full_name", "score", "confidence", F.lit(True).alias("classified")),
        "full_name",
        "left",
    ).withColumn("classified", F.coalesce("classified", F.lit(False)))
    new = to_item(scored, keep=("classified",))
    return merge_outcomes(existing, new, overrides, rules, **options)


# ---- comparing snapshots ---------------------------------------------------
COMPARED_FIELDS = (
    "name", "description", "category", "stars", "archived", "fork",
    "license", "score", "confidence", "notes", "hidden",
)
COMPARED_LISTS = ("tags", "topics")


def row_changed(old: str, new: str) -> Column:
    """DIF-2: any compared field differs; lists are compared without order."""
    differs = F.lit(False)
    for field in COMPARED_FIELDS:
        differs = differs | ~F.col(f"{old}.{field}").eqNullSafe(F.col(f"{new}.{field}"))
    for field in COMPARED_LISTS:
        differs = differs | ~F.array_sort(f"{old}.{field}").eqNullSafe(F.array_sort(f"{new}.{field}"))
    return differs


def compare_snapshots(
    old: DataFrame, new: DataFrame, *, old_pos: str | None = None, new_pos: str | None = None
) -> DataFrame:
    """DIF-1 / JN-9: ``id``, ``status`` and both versions as structs."""
    left = one_per_key(old, "id", old_pos).select(F.col("id").alias("_old_id"), F.struct(*ITEM_COLUMNS).alias("old"))
    right = one_per_key(new, "id", new_pos).select(F.col("id").alias("_new_id"), F.struct(*ITEM_COLUMNS).alias("new"))
    status = (
        F.when(F.col("_old_id").isNull(), "added")
        .when(F.col("_new_id").isNull(), "removed")
        .when(row_changed("old", "new"), "updated")
        .otherwise("unchanged")
    )
    return left.join(right, F.col("_old_id") == F.col("_new_id"), "full_outer").select(
        F.coalesce("_new_id", "_old_id").alias("id"), status.alias("status"), "old", "new"
    )
