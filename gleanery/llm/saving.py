"""The folder that all executors share, and cutting lineage in it."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Only a local session, where driver and tasks are one process, may leave the setting out.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="gleanery-llm-"))
        folder = _OWN[0]
    return folder


def saved(df: DataFrame) -> DataFrame:
    """The rows of ``df``, kept by ``checkpoint()`` in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
