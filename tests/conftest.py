from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import DataFrame, SparkSession

from checks.compare import session
from gleanery import schemas as S

AS_OF = datetime(2026, 4, 15, 12, 0, 0)


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    return session(4)


def item(**given) -> dict:
    """A valid item; ``repo`` follows ``id`` unless given."""
    base = {
        "id": "owner/name",
        "name": "Name",
        "url": "https://github.com/owner/name",
        "description": "A description of some length",
        "category": "Theme",
        "tags": [],
        "stars": 10,
        "pushed_at": datetime(2026, 3, 1),
        "archived": False,
        "fork": False,
        "license": None,
        "topics": [],
        "score": 60,
        "confidence": "medium",
        "notes": None,
        "hidden": False,
    }
    base.update(given)
    base.setdefault("repo", base["id"])
    return base


def items(spark: SparkSession, *rows: dict) -> DataFrame:
    full = [item(**r) for r in rows]
    return spark.createDataFrame([tuple(r[c] for c in S.ITEM_COLUMNS) for r in full], S.ITEM)


def stale_items(spark: SparkSession, *rows: dict) -> DataFrame:
    full = [item(**r) | {k: r.get(k) for k in ("stale_detected_at", "months_stale")} for r in rows]
    columns = S.STALE_ITEM.fieldNames()
    return spark.createDataFrame([tuple(r[c] for c in columns) for r in full], S.STALE_ITEM)


def rules(spark: SparkSession, repos=(), patterns=()) -> DataFrame:
    rows = [(i, "exact", v) for i, v in enumerate(repos)] + [(i, "pattern", v) for i, v in enumerate(patterns)]
    return spark.createDataFrame(rows, S.RULE)


def overrides(spark: SparkSession, *rows: dict) -> DataFrame:
    columns = S.OVERRIDE.fieldNames()
    return spark.createDataFrame(
        [tuple({"pos": i, **r}.get(c) for c in columns) for i, r in enumerate(rows)], S.OVERRIDE
    )


def by(df: DataFrame, key: str) -> dict:
    return {r[key]: r for r in df.collect()}
