"""Run-over-run staleness: which items are stale, newly stale or back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.columns import is_stale, moment, months_stale, round_1dp, text_or
from gleanery.profiles import STALE_THRESHOLD_MONTHS, check_stale_threshold
from gleanery.schemas import ITEM_COLUMNS

ACTIVE, NEWLY_STALE, STILL_STALE, REACTIVATED, REMAINING = (
    "active", "newly_stale", "still_stale", "reactivated", "remaining",
)
STALE_COLUMNS = [*ITEM_COLUMNS, "stale_detected_at", "months_stale"]


def with_staleness(
    items: DataFrame, as_of: datetime | Column, threshold: int = STALE_THRESHOLD_MONTHS
) -> DataFrame:
    """ST-1 + FLT-8: add ``months_stale`` and ``is_stale``."""
    check_stale_threshold(threshold)
    return items.withColumn("months_stale", months_stale("pushed_at", as_of).cast("int")).withColumn(
        "is_stale", is_stale("pushed_at", as_of, threshold)
    )


def detect_staleness(
    items: DataFrame,
    prior: DataFrame,
    as_of: datetime | Column,
    threshold: int = STALE_THRESHOLD_MONTHS,
) -> DataFrame:
    """ST-2 / JN-7: one row per id of either side with its ``state``.

    ``remaining`` rows are in the prior state but not in the input and keep their
    stored values.  Ids are unique on both sides, so the join has no hot key.
    """
    columns = [c for c in items.columns if c in ITEM_COLUMNS]
    now = with_staleness(items, as_of, threshold).select(
        F.col("id").alias("_now_id"), F.struct(*columns).alias("_now"), "is_stale", F.col("months_stale").alias("_months")
    )
    before = prior.select(
        F.col("id").alias("_old_id"), F.struct(*columns).alias("_old"), "stale_detected_at", "months_stale"
    )
    seen, was = F.col("_now_id").isNotNull(), F.col("_old_id").isNotNull()
    state = (
        F.when(~seen, REMAINING)
        .when(F.col("is_stale") & was, STILL_STALE)
        .when(F.col("is_stale"), NEWLY_STALE)
        .when(was, REACTIVATED)
        .otherwise(ACTIVE)
    )
    # PRJ-6: the first detection is kept; months are refreshed when seen again.
    stale_now = seen & F.col("is_stale")
    return now.join(before, F.col("_now_id") == F.col("_old_id"), "full_outer").select(
        *[F.when(seen, F.col(f"_now.{c}")).otherwise(F.col(f"_old.{c}")).alias(c) for c in columns],
        F.when(~seen | (stale_now & was), F.col("stale_detected_at"))
        .when(stale_now, moment(as_of))
        .alias("stale_detected_at"),
        F.when(~seen, F.col("months_stale")).when(stale_now, F.col("_months")).alias("months_stale"),
        state.alias("state"),
    )


def staleness_counters(detected: DataFrame) -> DataFrame:
    """ST-3, one row."""
    state = F.col("state")
    return detected.agg(
        F.count_if(state != REMAINING).alias("total_processed"),
        F.count_if(state.isin(ACTIVE, REACTIVATED)).alias("active_count"),
        F.count_if(state == NEWLY_STALE).alias("newly_stale"),
        F.count_if(state == REACTIVATED).alias("reactivated"),
        F.count_if(state == REMAINING).alias("remaining_stale"),
    )


def active_items(detected: DataFrame) -> DataFrame:
    """ST-4: the items that stay in the catalog."""
    return detected.filter(F.col("state").isin(ACTIVE, REACTIVATED)).drop("state", "stale_detected_at", "months_stale")


def next_state(detected: DataFrame) -> DataFrame:
    """ST-4: the stale table after the run.

    The detection already holds every old and new row, so the upsert and the
    delete of ``upsert_state`` come down to a filter, without another join.
    """
    return detected.filter(F.col("state").isin(NEWLY_STALE, STILL_STALE, REMAINING)).drop("state")


def upsert_state(state: DataFrame, upserts: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """JN-6: insert or replace by id, then delete the ids in ``removed``."""
    kept = state.join(upserts.select("id"), "id", "left_anti").select(*state.columns)
    merged = kept.unionByName(upserts.select(*state.columns))
    if removed is None:
        return merged
    return merged.join(removed.select("id"), "id", "left_anti").select(*state.columns)


def stale_order(stale: DataFrame) -> DataFrame:
    """SRC-9 order: category, then stars, highest first."""
    return stale.orderBy(F.asc("category"), F.desc("stars"), F.asc("id"))


def stale_by_category(stale: DataFrame, category: str) -> DataFrame:
    """FLT-9; a state partitioned by category is read for that category only."""
    return stale.filter(F.col("category") == category).orderBy(F.desc("stars"), F.asc("id"))


def overlap_check(active: DataFrame, stale: DataFrame) -> DataFrame:
    """JN-8: ids that are both active and stale."""
    return active.join(stale.select("id"), "id", "left_semi").select(
        "id", F.concat(F.lit("Item "), F.col("id"), F.lit(" is in both active and stale lists")).alias("message")
    )


# ---- statistics ------------------------------------------------------------
def _shown() -> Column:
    return ~F.coalesce("hidden", F.lit(False))


def _per_category(stale: DataFrame, category: Column) -> DataFrame:
    return stale.groupBy(category.alias("category")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("months_stale").cast("long")).alias("months"),
        F.count("months_stale").alias("dated"),
    )


def _one_row(per_category: DataFrame, average: Column, *extra: Column) -> DataFrame:
    """From a few rows per category to one row; an empty input gives zeros."""
    return per_category.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_stale"),
        *extra,
        average.alias("average_months_stale"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "n")))).alias("by_category"),
    )


def stale_statistics(stale: DataFrame) -> DataFrame:
    """AGG-1: total, counts per category and average months of all stale rows."""
    per_category = _per_category(stale, F.coalesce("category", F.lit("null")))
    average = F.sum("months").cast("double") / F.nullif(F.sum("dated"), F.lit(0))
    return _one_row(per_category, F.coalesce(round_1dp(average), F.lit(0.0)))


def stale_report_statistics(stale: DataFrame, total_items: int | Column) -> DataFrame:
    """AGG-2: visible rows only, with the share of ``total_items``."""
    whole = total_items if isinstance(total_items, Column) else F.lit(total_items)
    per_category = _per_category(stale.filter(_shown()), text_or("category", "Other"))
    n = F.coalesce(F.sum("n"), F.lit(0)).cast("double")
    share = round_1dp_percent(n / F.nullif(whole.cast("double"), F.lit(0.0)))
    average = F.coalesce(F.sum("months"), F.lit(0)).cast("double") / F.nullif(n, F.lit(0.0))
    return _one_row(
        per_category,
        F.coalesce(round_1dp(average), F.lit(0.0)),
        F.when(whole > 0, share).otherwise(F.lit(0.0)).alias("percentage_of_total"),
    )


def round_1dp_percent(ratio: Column) -> Column:
    return F.floor(ratio * F.lit(100.0) * F.lit(10.0) + F.lit(0.5)) / F.lit(10.0)


def staleness_totals(detected: DataFrame) -> DataFrame:
    """Active plus all stale rows (hidden ones too): the whole of AGG-2."""
    return detected.agg(F.count(F.lit(1)).alias("total_items"))


def stale_summary(detected: DataFrame) -> DataFrame:
    """RPT-6: one row from a single pass over the detection."""
    state = F.col("state")
    stale = state.isin(NEWLY_STALE, STILL_STALE, REMAINING)
    shown = stale & _shown()
    n, shown_n = F.count(F.lit(1)).cast("double"), F.count_if(shown).cast("double")
    months = F.sum(F.when(shown, F.coalesce("months_stale", F.lit(0)).cast("long")))
    return detected.agg(
        F.count_if(stale).alias("total"),
        F.count_if(state == NEWLY_STALE).alias("newly_stale"),
        F.count_if(state == REACTIVATED).alias("reactivated"),
        F.coalesce(round_1dp_percent(shown_n / F.nullif(n, F.lit(0.0))), F.lit(0.0)).alias("percentage"),
        F.coalesce(
            round_1dp(F.coalesce(months, F.lit(0)).cast("double") / F.nullif(shown_n, F.lit(0.0))), F.lit(0.0)
        ).alias("average_months_stale"),
    )


def reconcile_statistics(stale: DataFrame, stored: DataFrame, tolerance: float = 0.1) -> DataFrame:
    """AGG-14: mismatches between the stale rows and stored statistics.

    ``stored`` has one row shaped like ``stale_statistics``.
    """
    columns = ("total_stale", "average_months_stale", "by_category")
    actual = stale_statistics(stale).select(*[F.col(c).alias(f"a_{c}") for c in columns])
    # One row each: laid side by side by an aggregate over their union, not by a join.
    both = (
        stored.select(*columns)
        .unionByName(actual, allowMissingColumns=True)
        .agg(*[F.any_value(c, F.lit(True)).alias(c) for c in (*columns, *actual.columns)])
    )
    found = both.select(
        F.explode(
            F.array_compact(
                F.concat(
                    F.array(
                        F.when(
                            F.col("total_stale") != F.col("a_total_stale"),
                            _finding(
                                "error", "total",
                                F.concat(
                                    F.lit("Statistics mismatch: totalStale="), F.col("total_stale"),
                                    F.lit(", actual count="), F.col("a_total_stale"),
                                ),
                            ),
                        ),
                        F.when(
                            F.abs(F.col("average_months_stale") - F.col("a_average_months_stale")) > F.lit(tolerance),
                            _finding(
                                "warning", "average",
                                F.concat(
                                    F.lit("Average months stale mismatch: stats="), F.col("average_months_stale"),
                                    F.lit(", expected="), F.col("a_average_months_stale"),
                                ),
                            ),
                        ),
                    ),
                    F.transform(
                        F.map_entries("a_by_category"),
                        lambda e: F.when(
                            ~F.coalesce(F.try_element_at("by_category", e["key"]) == e["value"], F.lit(False)),
                            _finding(
                                "error", "category",
                                F.concat(
                                    F.lit("Category count mismatch for "), e["key"], F.lit(": stats="),
                                    F.coalesce(
                                        F.try_element_at("by_category", e["key"]).cast("string"), F.lit("undefined")
                                    ),
                                    F.lit(", actual="), e["value"],
                                ),
                            ),
                        ),
                    ),
                )
            )
        ).alias("f")
    )
    return found.select("f.*")


def _finding(severity: str, check: str, message: Column) -> Column:
    return F.struct(F.lit(severity).alias("severity"), F.lit(check).alias("check"), message.alias("message"))
