"""Versioned sinks.

A table is a folder of versions and a commit log.  A run writes a new version
and then appends one line to the log, so a reader never sees half a write, the
table being read is never the one being overwritten, and a lost job leaves the
previous version in place.  Tables that belong together are written by ``store.Store``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators.reports import catalog_order
from gleanery.schemas import STALE_ITEM

_LOG = "number long, version string, committed_at timestamp"


def version_name(as_of: datetime) -> str:
    return as_of.strftime("%Y%m%dT%H%M%S")


def _log_path(root: str) -> str:
    return f"{root.rstrip('/')}/_commits"


def version_path(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/v-{version}"


def _commits(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(_LOG).json(_log_path(root))
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version committed last, whatever its date, or None."""
    log = _commits(spark, root)
    return None if log is None else log.agg(F.max_by("version", F.struct(F.coalesce("number", F.lit(0)), "committed_at"))).first()[0]


def current_path(spark: SparkSession, root: str) -> str | None:
    version = current_version(spark, root)
    return None if version is None else version_path(root, version)


def write_version(
    df: DataFrame, root: str, as_of: datetime, *, partition_by: tuple[str, ...] = (), fmt: str = "parquet"
) -> str:
    """Write a new version and commit it; an uncommitted leftover is replaced, a committed version never is."""
    spark = df.sparkSession
    version = version_name(as_of)
    log, number = _commits(spark, root), 1
    if log is not None:
        known = log.agg(F.max("number"), F.count(F.lit(1)), F.count_if(F.col("version") == version)).first()
        if known[2]:
            raise ValueError(f"version {version} is already committed")
        number = max(known[0] or 0, known[1]) + 1
    path = version_path(root, version)
    df.write.mode("overwrite").partitionBy(*partition_by).format(fmt).save(path)
    spark.createDataFrame([(number, version, as_of)], _LOG).coalesce(1).write.mode("append").json(_log_path(root))
    return path


def write_items(items: DataFrame, root: str, as_of: datetime) -> str:
    """SNK-1: the catalog, most stars first."""
    return write_version(catalog_order(items), root, as_of)


def write_stale(state: DataFrame, root: str, as_of: datetime) -> str:
    """SNK-2: the stale state, one folder per category for pruned reads."""
    return write_version(spread_by_category(state), root, as_of, partition_by=("category",))


def spread_by_category(state: DataFrame) -> DataFrame:
    """Rows of one category are spread over tasks by id, so a category with most of
    the rows is not written by one task."""
    return state.repartition(F.col("category"), F.pmod(F.xxhash64("id"), F.lit(_writers(state))))


def _writers(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def backup_state(spark: SparkSession, root: str, backup_root: str, as_of: datetime) -> str | None:
    """SNK-3: copy the committed state aside before a change; None without one.

    A state without rows has no files to take a schema from, so it is given.  A backup that
    is complete stays as it is, as a run that is tried again may find the state changed already.
    """
    path = current_path(spark, root)
    if path is None:
        return None
    target = f"{backup_root.rstrip('/')}/backup_ts={version_name(as_of)}"
    if not _complete(spark, target):
        spark.read.schema(STALE_ITEM).parquet(path).write.mode("overwrite").parquet(target)
    return target


def _complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` came to its end."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def write_report(tables: dict[str, DataFrame], root: str, as_of: datetime, *, fmt: str = "parquet") -> dict[str, str]:
    """SNK-5: publish report tables, each under its own version; a published one is not written again."""
    written = {}
    for name, df in tables.items():
        folder = f"{root.rstrip('/')}/{name}"
        log = _commits(df.sparkSession, folder)
        known = log is not None and log.where(F.col("version") == version_name(as_of)).limit(1).count() > 0
        written[name] = version_path(folder, version_name(as_of)) if known else write_version(df, folder, as_of, fmt=fmt)
    return written
