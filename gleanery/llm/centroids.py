"""Centroid clustering with an exact nearest-centroid search in the Walsh-Hadamard domain.

Vectors become integers, floor(256 x). Vectors and centroids are transformed by the integer Walsh-Hadamard transform, which
multiplies every squared distance by the number of dimensions, so no rounding enters. The coefficients are taken in the order
of their number of sign changes, coarse ones first, and squared differences are added up in growing steps. A partial sum
never exceeds the distance; so a centroid whose partial sum is strictly above the full distance of a first guess can't be
nearest and goes. Those that are left are finished over all coefficients; ties go to the smaller number.

A round reads the vectors where they are. Each task sends one row of sums per centroid (and limb, see below), which Spark
adds up; only the centroids, k x dimensions numbers, pass the driver. So equal or hot vectors make no difference, and
nothing is shuffled but the sums.

Exactness at any size: components beyond 2**21 are summed in limbs of 21 bits, and compared as Python integers. A
distance or inertia that does not fit a long is null.

Kept are vectors with exactly ``dims`` components, none of them null, NaN or infinite; all others are left out, null
vectors too. A null id is ordered last among the starting centroids and is assigned like any other. Repeated rows and ids are vectors of their own; rows with
one id are ordered by their vectors when the start is picked. With fewer than ``k`` kept vectors there are as many
centroids as vectors; an empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.saving import saved

SCALE = 256
LIMB = 21
LIMB_MASK = (1 << LIMB) - 1
FIRST = 4  # coefficients compared before the first guess
ROWS = 4096  # vectors compared at a time


def sequency_order(dims: int) -> np.ndarray:
    """Rows of the transform by their number of sign changes."""
    signs = transform(np.eye(dims, dtype=np.int64))
    return np.argsort((np.diff(signs, axis=1) != 0).sum(axis=1), kind="stable")


def transform(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, in natural order, by additions alone."""
    n, dims, half = len(x), x.shape[1], 1
    while half < dims:
        pair = x.reshape(n, dims // (2 * half), 2, half)
        a, b = pair[:, :, 0], pair[:, :, 1]
        x = np.stack([a + b, a - b], axis=2).reshape(n, dims)
        half *= 2
    return x


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """floor(256 x): int64 where all fit 21 bits, else Python integers."""
    wide = values.astype(np.float64)
    if not len(wide) or np.abs(wide).max() < (1 << LIMB) / SCALE - 1:
        return np.floor(wide * SCALE).astype(np.int64)
    whole = [int(x) * SCALE if abs(x) >= 2.0**53 else int(np.floor(x * SCALE)) for x in wide.ravel().tolist()]
    return np.array(whole, dtype=object).reshape(wide.shape)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return (d * d).sum(axis=-1)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``x`` the number of the nearest centroid (the smallest of equal ones) and the squared distance."""
    n, dims = x.shape
    if x.dtype != centroids.dtype or (len(x) and max(np.abs(x).max(), np.abs(centroids).max()) >= 1 << LIMB):
        x, centroids = x.astype(object), centroids.astype(object)
    order = sequency_order(dims)
    coarse, ours = transform(x)[:, order], transform(centroids)[:, order]
    step = min(FIRST, dims)
    part = _squares(coarse[:, None, :step], ours[None, :, :step])
    guess = np.argmin(part, axis=1)
    bound = _squares(coarse, ours[guess])
    row, which = np.nonzero(part <= bound[:, None])
    part = part[row, which]
    while step < dims:
        to = min(2 * step, dims)
        part = part + _squares(coarse[row, step:to], ours[which, step:to])
        left = part <= bound[row]
        row, which, part, step = row[left], which[left], part[left], to
    first = np.flatnonzero(np.diff(row, prepend=-1))
    best = np.minimum.reduceat(part, first) if len(first) else part
    hit = np.flatnonzero(part == best[row])
    hit = hit[np.flatnonzero(np.diff(row[hit], prepend=-1))]
    return which[hit], best // dims


def _kept(vectors: DataFrame, vector: str, dims: int) -> DataFrame:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where((F.size(vector) == dims) & fine)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return whole_numbers(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            yield batch.slice(at, ROWS)


class _Sums:
    """Per centroid the number of its vectors and their sum, in limbs of 21 bits."""

    def __init__(self, k: int, dims: int):
        self.count, self.limbs = np.zeros(k, np.int64), [np.zeros((k, dims), np.int64)]

    def add(self, x: np.ndarray, which: np.ndarray) -> None:
        self.count += np.bincount(which, minlength=len(self.count))
        if x.dtype != object:
            np.add.at(self.limbs[0], which, x)
            return
        sign, rest, level = np.where(x < 0, -1, 1).astype(np.int64), abs(x), 0
        while (rest > 0).any():
            if level == len(self.limbs):
                self.limbs.append(np.zeros_like(self.limbs[0]))
            np.add.at(self.limbs[level], which, (rest & LIMB_MASK).astype(np.int64) * sign)
            rest, level = rest >> LIMB, level + 1

    def rows(self) -> Iterator[tuple[int, int, int, list[int]]]:
        for level, sums in enumerate(self.limbs):
            for c in np.flatnonzero(self.count):
                yield int(c), level, int(self.count[c]) if level == 0 else 0, sums[c].tolist()


def _moved(kept: DataFrame, vector: str, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round; empty ones stay."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(k, dims)
        for batch in _slices(batches):
            x = _matrix(batch.column(0), dims)
            sums.add(x, nearest(x, centroids)[0])
        rows = list(sums.rows())
        if rows:
            types = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["cluster", "limb", "n", "sums"])

    parts = kept.select(vector).mapInArrow(run, "cluster int, limb int, n long, sums array<long>")
    added = parts.groupBy("cluster", "limb").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dims)])
    count, total = [0] * k, [[0] * dims for _ in range(k)]
    for r in added.collect():  # k rows a limb
        count[r.cluster] += r.n
        for i in range(dims):
            total[r.cluster][i] += r[f"s{i}"] << LIMB * r.limb
    rows = [[s // n for s in sums] if n else list(old) for n, sums, old in zip(count, total, centroids.tolist(), strict=True)]
    return _numbers(rows, dims)


def _numbers(rows: list[list[int]], dims: int) -> np.ndarray:
    big = any(abs(x) >= 1 << LIMB for r in rows for x in r)
    return np.array(rows, dtype=object if big else np.int64).reshape(len(rows), dims)


def cluster_vectors(
    vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, salt: str = "2", vector: str = "embedding", id: str = "vec_id"
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` for each kept vector.

    The centroids start as the ``k`` kept vectors with the smallest SHA-256 of ``salt:id``; ``dims`` is a power of two.
    """
    if dims & (dims - 1) or dims < 1:
        raise ValueError("the number of dimensions must be a power of two")
    kept = _kept(vectors.select(F.col(id).alias("vec_id"), F.col(vector).alias("vector")), "vector", dims)
    hashed = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    start = kept.orderBy(hashed.asc_nulls_last(), "vector").limit(k).collect()
    kind = kept.schema["vec_id"].dataType.simpleString()
    centroids = _numbers([whole_numbers(np.array([r.vector])).tolist()[0] for r in start], dims)
    for _ in range(rounds if start else 0):
        centroids = _moved(kept, "vector", centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            which, distance = nearest(_matrix(batch.column(1), dims), centroids)
            fits = [d if d < 1 << 63 else None for d in map(int, distance)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(which.astype(np.int32)), pa.array(fits, pa.int64())], ["vec_id", "cluster", "distance"]
            )

    assigned = saved(kept.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long"))
    exact = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)")))
    of_cluster = {r.cluster: r.total for r in assigned.groupBy("cluster").agg(exact.alias("total")).collect()}  # k rows
    sums = [of_cluster.get(c, 0) for c in range(len(centroids))]
    whole = None if any(s is None for s in sums) else sum(map(int, sums))
    long = lambda x: None if x is None or int(x) >= 1 << 63 else int(x)
    facts = [
        (c, long(sums[c]), long(whole), hashlib.sha256(",".join(map(str, row)).encode()).hexdigest())
        for c, row in enumerate(centroids.tolist())
    ]
    known = vectors.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
