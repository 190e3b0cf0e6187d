"""A store of tables that change together: one commit record for all that a run writes.

``<root>/_runs/<number>.json`` names the folders that make up each table after that run. A run first writes new folders, which
nobody reads yet, then puts one record in place by a rename that fails where the number is taken. So readers see all
tables of one run or of the one before; a run that fails at any step leaves the store as it was and can simply be run again; and a
run whose version is committed writes nothing. Folders in use are never written to.

A table is a base folder and the change folders since. Readers merge them; when there are many, the next run writes a new base.

The rename must not replace files: true for HDFS and local disks, for object stores where their Hadoop connector has it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.operators import deltas
from gleanery.sources.writers import version_name

MOST_CHANGES = 20  # change folders of a table before it gets a new base


class ConcurrentRun(RuntimeError):
    """Another run was committed since this one read the store."""


@dataclass(frozen=True)
class Folders:
    base: str
    changes: tuple[str, ...] = ()


@dataclass(frozen=True)
class Run:
    number: int
    version: str
    tables: dict[str, Folders]
    metrics: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class Table:
    """What a run makes of one table: all ``rows``, or with ``key`` the changes against what is there."""

    rows: DataFrame
    key: str | None = None
    partition_by: tuple[str, ...] = ()


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._files = self._path(self.root).getFileSystem(self._conf)

    # ---- reading -----------------------------------------------------------
    def _record(self, number: int) -> str:
        return f"{self.root}/_runs/{number:012d}.json"

    def numbers(self) -> list[int]:
        """Numbers of the committed runs."""
        log = self._path(f"{self.root}/_runs")
        if not self._files.exists(log):
            return []
        names = [f.getPath().getName() for f in self._files.listStatus(log)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def run(self, number: int) -> Run:
        text = self.spark.read.text(self._record(number), wholetext=True).first()[0]
        found = json.loads(text)
        tables = {name: Folders(t["base"], tuple(t["changes"])) for name, t in found["tables"].items()}
        return Run(found["number"], found["version"], tables, found["metrics"])

    def last(self) -> Run | None:
        numbers = self.numbers()
        return self.run(numbers[-1]) if numbers else None

    def _committed(self, version: str) -> Run | None:
        return next((r for r in map(self.run, reversed(self.numbers())) if r.version == version), None)

    def read(self, name: str, schema: T.StructType, run: Run | None = None, *, key: str = "id") -> DataFrame:
        """A table as ``run`` (the last one) left it; without rows where there is none."""
        run = run or self.last()
        folders = run.tables.get(name) if run else None
        if folders is None:
            return self.spark.createDataFrame([], schema)
        base = self.spark.read.schema(schema).parquet(f"{self.root}/{folders.base}")
        if not folders.changes:
            return base
        with_op = T.StructType([T.StructField("number", T.IntegerType()), T.StructField("op", T.StringType()), *schema.fields])
        later = self.spark.read.schema(with_op).parquet(*[f"{self.root}/{c}" for c in folders.changes])
        return deltas.merged(base, later, key)

    # ---- writing -----------------------------------------------------------
    def save(self, as_of: datetime, tables: Mapping[str, Table], *, after: int | None = None, metrics: dict[str, int] | None = None) -> Run:
        """Write ``tables`` and commit them as one run; other tables stay. A run of this version that is there is returned.

        ``after`` is the number of the run that was read (0: none). If another was committed since, nothing is.
        """
        version = version_name(as_of)
        done = self._committed(version)
        if done is not None:
            return done
        last = self.last()
        number = last.number if last else 0
        if after is not None and after != number:
            raise ConcurrentRun(f"run {after} was read, run {number} is committed")
        attempt = f"{version}-{uuid.uuid4().hex[:8]}"
        folders = dict(last.tables) if last else {}
        for name, table in tables.items():
            folders[name] = self._write(name, table, attempt, number + 1, folders.get(name), last)
        run = Run(number + 1, version, folders, metrics or {})
        self._commit(run)
        return run

    def _write(self, name: str, table: Table, attempt: str, number: int, old: Folders | None, last: Run | None) -> Folders:
        if table.key and old and len(old.changes) < MOST_CHANGES:
            before = self.read(name, table.rows.schema, last, key=table.key)
            path = f"{name}/c-{attempt}"
            changed = deltas.changes(before, table.rows, table.key)
            changed.select(F.lit(number).alias("number"), "*").write.parquet(f"{self.root}/{path}")
            return Folders(old.base, (*old.changes, path))
        path = f"{name}/v-{attempt}"
        table.rows.write.partitionBy(*table.partition_by).parquet(f"{self.root}/{path}")
        return Folders(path)

    def _commit(self, run: Run) -> None:
        """Write the record beside its place, then move it there unless the place is taken."""
        draft = self._path(f"{self.root}/_runs/.{uuid.uuid4().hex}.draft")
        tables = {name: {"base": f.base, "changes": list(f.changes)} for name, f in run.tables.items()}
        out = self._files.create(draft, False)
        out.write(bytearray(json.dumps({"number": run.number, "version": run.version, "tables": tables, "metrics": run.metrics}).encode()))
        out.close()
        jvm = self.spark._jvm
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), self._conf)
        try:
            context.rename(draft, self._path(self._record(run.number)), options)
        except Py4JJavaError as problem:
            self._files.delete(draft, False)
            if "FileAlreadyExists" in str(problem.java_exception.getClass().getName()):
                raise ConcurrentRun(f"run {run.number} was committed meanwhile") from problem
            raise

    # ---- upkeep ------------------------------------------------------------
    def unused(self) -> list[str]:
        """Folders of tables that no committed run names: what failed runs have left. Meant for when no run is under way."""
        used, tables = set(), set()
        for run in map(self.run, self.numbers()):
            tables |= run.tables.keys()
            used |= {x for f in run.tables.values() for x in (f.base, *f.changes)}
        found = []
        for name in sorted(tables):
            found += [f"{name}/{f.getPath().getName()}" for f in self._files.listStatus(self._path(f"{self.root}/{name}")) if f.getPath().getName()[:2] in ("v-", "c-")]
        return [x for x in found if x not in used]
