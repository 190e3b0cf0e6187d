"""Connected components of a link table, by contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.saving import saved

SMALL = 100_000  # links that one task joins; more are contracted first


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``links`` (columns ``a``, ``b``): the smallest node that it can reach.

    While there are more than ``SMALL`` links, a round points every node to its smallest neighbour, follows the pointers
    to their ends, and keeps the links between different ends only. All steps are aggregates that combine before they
    shuffle and joins whose one side is unique, so one node with very many links is no single task. What is left then is
    of a bounded size and joined in one task. Only the number of links reaches the driver.
    """
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    edges, found = saved(edges), None
    while True:
        few = edges.count() <= SMALL
        ends = saved(_united(edges)) if few else _ends(edges)
        if found is None:
            found = ends
        else:
            more = ends.select(F.col("node").alias("n"), F.col("label").alias("further"))
            found = found.join(more, found["label"] == more["n"], "left")
            found = saved(found.select("node", F.coalesce("further", "label").alias("label")))
        if few:
            return found
        left = ends.select(F.col("node").alias("a"), F.col("label").alias("x"))
        right = ends.select(F.col("node").alias("b"), F.col("label").alias("y"))
        edges = edges.join(left, "a").join(right, "b").where("x <> y")
        edges = saved(edges.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())


def _united(edges: DataFrame) -> DataFrame:
    """The components of at most ``SMALL`` links, in one task."""
    kind = edges.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict = {}
        schema = None

        def root(x):
            up.setdefault(x, x)
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for batch in batches:
            schema = batch.schema
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(a), root(b)
                up[max(a, b)] = min(a, b)
        if schema is not None:
            nodes = list(up)
            columns = [pa.array(nodes, schema.field(0).type), pa.array(list(map(root, nodes)), schema.field(0).type)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "label"])

    return edges.coalesce(1).mapInArrow(run, f"node {kind}, label {kind}")


def _ends(edges: DataFrame) -> DataFrame:
    """For each node the end of the way over ever smaller neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    ends = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label"))
    ends = saved(ends)
    while True:
        target = ends.select(F.col("node").alias("t"), F.col("label").alias("further"))
        step = saved(ends.join(target, ends["label"] == target["t"]).select("node", "label", "further"))
        ends = step.select("node", F.col("further").alias("label"))
        if step.where("label <> further").limit(1).count() == 0:
            return ends
