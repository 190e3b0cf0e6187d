"""Catalog items out of HTML tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from gleanery.functions.ranking import materialize
from gleanery.operators import reports, webtables


@dataclass
class Migration:
    items: DataFrame
    warnings: DataFrame
    category_counts: DataFrame


def migrate_pages(
    pages: DataFrame, as_of: datetime, *, page_id: str = "page_id", html_column: str = "html", thousands: bool = False
) -> Migration:
    """WEB-7 / E3.  Pages are read once: the rows found are written to the scratch folder for all three results."""
    rows = webtables.extract_rows(pages, page_id=page_id, html_column=html_column)
    read = materialize(webtables.row_items(rows, as_of, thousands=thousands))
    items = webtables.web_items(read)
    return Migration(
        items=reports.category_order(items, others_first=True),
        warnings=webtables.web_warnings(read),
        category_counts=webtables.migration_category_counts(items),
    )
