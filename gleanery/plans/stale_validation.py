"""Checks over the stored catalog, stale state, pages and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators import quality, staleness


def stale_validation(
    active: DataFrame, stale: DataFrame, stored_statistics: DataFrame, pages: DataFrame | None = None
) -> DataFrame:
    """PIP-2: all findings as (severity, check, message); ``pages`` have a ``role``."""
    overlap = staleness.overlap_check(active, stale).select(
        F.lit("warning").alias("severity"), F.lit("overlap").alias("check"), "message"
    )
    found = (
        quality.validate_state(stale)
        .unionByName(overlap)
        .unionByName(staleness.reconcile_statistics(stale, stored_statistics))
    )
    if pages is None:
        return found
    return found.unionByName(quality.site_findings(pages).drop("page_id"))
