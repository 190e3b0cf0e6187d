"""Line dedup: exact counts of the documents that hold each line, with sharded cuckoo filters in front of them.

A line's key is the line without blanks at both ends and with A-Z lower-cased; an empty key never counts. The exact
table ``(key, refs)`` has one row per key and grows or shrinks with the documents that come or go, so dedup is
reversible. Keys with at least ``threshold`` documents are also in the cuckoo filter of their shard. Reading a
document, only lines that a filter knows go on to the exact table, which has the last word.

The filters go to every task while their counted size is below ``MAX_FILTER_BYTES``; beyond that lines are dealt to the
filter of their shard, where each task holds one filter at a time. Either way a filter is asked first. Lines of one text
need one decision, whatever the number of copies, so decisions are joined by the text's digest. Copies of a text that
holds more than a thousandth of all rows, and texts of blanks alone, are spread over ``SALTS`` parts for that join.

Each row of the input is one document (repeated rows count each); a null text is an empty text, and either has one
empty line. ``doc_id`` may be null. Only id and text are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.llm.bytewords import buffer_of, row_slices
from gleanery.llm.names import unused
from gleanery.llm.saving import saved

BLANKS = b" \t\n\x0b\x0c\r"
MAX_FILTER_BYTES = 32 << 20
KEYS_PER_SHARD = 100_000
SALTS = 32
HEAVY = 1000  # a text with fewer copies is never spread


def line_keys(text: bytes) -> list[bytes]:
    """The key of each line; ``bytes.lower`` changes A-Z only."""
    return [line.strip(BLANKS) for line in text.lower().split(b"\n")]


def key_digest(key: bytes) -> bytes:
    return hashlib.md5(key, usedforsecurity=False).digest()


def line_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(key, refs)``: for the digest of each line key, the number of documents that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n: Counter = Counter()
            for value in batch.column(0):
                n.update({key_digest(k) for k in line_keys(value.as_py() or b"") if k})
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], ["key", "n"])

    found = docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(run, "key binary, n long")
    return found.groupBy("key").agg(F.sum("n").alias("refs"))


def add_documents(counts: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The exact table when ``docs`` come in."""
    return _moved(counts, line_counts(docs, text), 1)


def remove_documents(counts: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The exact table when ``docs``, that are in it, go."""
    return _moved(counts, line_counts(docs, text), -1)


def _moved(counts: DataFrame, change: DataFrame, sign: int) -> DataFrame:
    both = counts.select("key", "refs").unionByName(change.select("key", (F.col("refs") * sign).alias("refs")))
    return both.groupBy("key").agg(F.sum("refs").alias("refs")).where("refs > 0")


class CuckooFilter:
    """16-bit fingerprints in buckets of four, two buckets for each key; keys are 16-byte digests."""

    SLOTS, KICKS = 4, 500

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def of(cls, keys: list[bytes]) -> CuckooFilter:
        """A filter with all keys; it grows until they fit."""
        buckets = 1 << max(1, int(np.ceil(np.log2(max(1, len(keys)) / cls.SLOTS / 0.85))))
        while True:
            out = cls(np.zeros((buckets, cls.SLOTS), np.uint16))
            if all(map(out.insert, keys)):
                return out
            buckets *= 2

    @classmethod
    def read(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, cls.SLOTS).copy())

    def write(self) -> bytes:
        return self.table.tobytes()

    def _place(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints (never 0) and both buckets, for digests as rows of two 64-bit numbers."""
        mark = (keys[:, 1] % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        one = keys[:, 0] & np.uint64(len(self.table) - 1)
        return mark, one, self._other(one, mark)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return bucket ^ (mark.astype(np.uint64) * np.uint64(0x5BD1E995) & np.uint64(len(self.table) - 1))

    def insert(self, key: bytes) -> bool:
        mark, one, two = self._place(np.frombuffer(key, np.uint64).reshape(1, 2))
        rng, m, b = np.random.default_rng(int(mark[0])), mark, one
        for bucket in (one, two):
            free = np.flatnonzero(self.table[int(bucket[0])] == 0)
            if len(free):
                self.table[int(bucket[0]), free[0]] = mark[0]
                return True
        for _ in range(self.KICKS):
            slot = int(rng.integers(self.SLOTS))
            row = int(b[0])
            held = self.table[row, slot]
            self.table[row, slot], m = m[0], np.array([held], np.uint16)
            b = self._other(b, m)
            free = np.flatnonzero(self.table[int(b[0])] == 0)
            if len(free):
                self.table[int(b[0]), free[0]] = m[0]
                return True
        return False

    def delete(self, key: bytes) -> bool:
        mark, one, two = self._place(np.frombuffer(key, np.uint64).reshape(1, 2))
        for bucket in (int(one[0]), int(two[0])):
            held = np.flatnonzero(self.table[bucket] == mark[0])
            if len(held):
                self.table[bucket, held[0]] = 0
                return True
        return False

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, one, two = self._place(keys)
        hit = (self.table[one] == mark[:, None]).any(axis=1)
        return hit | (self.table[two] == mark[:, None]).any(axis=1)


def _shard(key: Column, shards: int) -> Column:
    """A shard number from the digest's last four bytes; ``_shards_of`` gives the same one in a task."""
    return F.pmod(F.conv(F.hex(F.substring(key, 13, 4)), 16, 10).cast("long"), F.lit(shards)).cast("int")


def _shards_of(keys: list[bytes], shards: int) -> np.ndarray:
    return np.frombuffer(b"".join(keys), ">u4").reshape(-1, 4)[:, 3] % shards


def filters(keys: DataFrame, shards: int) -> DataFrame:
    """``(shard, filter)`` with the keys of ``keys`` in them."""

    def build(group: pa.Table) -> pa.Table:
        made = CuckooFilter.of(group.column("key").to_pylist())
        return pa.table({"shard": group.column("shard").slice(0, 1), "filter": pa.array([made.write()], pa.binary())})

    some = keys.select(_shard(F.col("key"), shards).alias("shard"), "key")
    return some.groupBy("shard").applyInArrow(build, "shard int, filter binary")


def move_filters(old: DataFrame, added: DataFrame, removed: DataFrame, shards: int) -> DataFrame:
    """The filters when the keys ``added`` reach the threshold and ``removed``, that are in them, fall below it."""
    change = added.select("key", F.lit(1).alias("sign")).unionByName(removed.select("key", F.lit(-1).alias("sign")))
    change = change.select(_shard(F.col("key"), shards).alias("shard"), "key", "sign")

    def move(key: tuple, before: pa.Table, after: pa.Table) -> pa.Table:
        made = CuckooFilter.read(before.column("filter")[0].as_py()) if len(before) else CuckooFilter.of([])
        steps = sorted(zip(after.column("sign").to_pylist(), after.column("key").to_pylist(), strict=True))
        for sign, k in steps:
            fits = made.insert(k) if sign > 0 else made.delete(k)
            if sign > 0 and not fits:
                raise ValueError("a filter is full: make the filters anew from the exact table, with more shards")
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "filter": pa.array([made.write()], pa.binary())})

    return old.groupBy("shard").cogroup(change.groupBy("shard")).applyInArrow(move, "shard int, filter binary")


def frequent_lines(docs: DataFrame, counts: DataFrame, threshold: int, text: str = "text") -> DataFrame:
    """``(text_key, keys)``: for each distinct text with lines in ``threshold`` documents or more, those lines' digests."""
    hot = saved(counts.where(F.col("refs") >= threshold).select("key"))
    n = hot.count()
    shards = max(1, -(-n // KEYS_PER_SHARD))
    some = docs.select(text_key(text).alias("text_key"), F.col(text).cast("binary").alias("text"))
    known = filters(hot, shards)
    if n * 16 < MAX_FILTER_BYTES:  # two bytes a key, in tables at least an eighth full
        lines = _probed_in_place(some, known, shards)
    else:
        lines = _probed_by_shard(some, known, shards)
    return lines.distinct().join(hot, "key", "left_semi").groupBy("text_key").agg(F.collect_list("key").alias("keys"))


def _lines(batch: pa.RecordBatch) -> tuple[list[bytes], list[bytes]]:
    """The text key and the digest of each different line of each document."""
    texts, keys = [], []
    for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        mine = {key_digest(k) for k in line_keys(value.as_py() or b"") if k}
        texts += [key] * len(mine)
        keys += mine
    return texts, keys


def _probed_in_place(some: DataFrame, known: DataFrame, shards: int) -> DataFrame:
    """``(text_key, key)`` of the lines that a filter knows; every task holds all filters."""
    shared = some.sparkSession.sparkContext.broadcast({r["shard"]: r["filter"] for r in known.collect()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = {s: CuckooFilter.read(x) for s, x in shared.value.items()}
        for batch in batches:
            texts, keys = _lines(batch)
            if keys:
                shard, as_numbers = _shards_of(keys, shards), np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)
                hit = np.zeros(len(keys), bool)
                for s, one in probe.items():
                    at = np.flatnonzero(shard == s)
                    hit[at] = one.contains(as_numbers[at])
                texts = [t for t, x in zip(texts, hit, strict=True) if x]
                keys = [k for k, x in zip(keys, hit, strict=True) if x]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array(keys, pa.binary())], ["text_key", "key"])

    return some.mapInArrow(run, "text_key binary, key binary")


def _probed_by_shard(some: DataFrame, known: DataFrame, shards: int) -> DataFrame:
    """``(text_key, key)`` of the lines that a filter knows; lines go to the filter of their shard.

    The lines of a shard are dealt to several cells by their text, so that one frequent line is spread too. A cell's
    filter comes in front of its lines, which pass by in batches.
    """
    parts = max(1, -(-4 * int(some.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys = _lines(batch)
            cell = _shards_of(keys, shards).astype(np.int64) * parts + _shards_of(texts, parts)
            columns = [pa.array(cell), pa.array(texts, pa.binary()), pa.array(keys, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["cell", "text_key", "key"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, one = -1, CuckooFilter.of([])
        for batch in batches:
            cells, keep = batch.column(0).to_numpy(), np.zeros(len(batch), bool)
            edges = np.concatenate([[0], np.flatnonzero(np.diff(cells)) + 1, [len(cells)]]) if len(cells) else [0]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if batch.column(3)[a].is_valid:
                    at, one = cells[a], CuckooFilter.read(batch.column(3)[a].as_py())
                    a += 1
                if a < b and at == cells[a]:  # else no key of the shard is frequent
                    rows = np.frombuffer(b"".join(batch.column(2).slice(a, b - a).to_pylist()), np.uint64).reshape(-1, 2)
                    keep[a:b] = one.contains(rows)
            yield batch.filter(pa.array(keep)).select(["text_key", "key"])

    lowest = F.col("shard").cast("long") * parts
    first = known.select(F.explode(F.sequence(lowest, lowest + (parts - 1))).alias("cell"), "filter")
    rows = some.mapInArrow(deal, "cell long, text_key binary, key binary").unionByName(first, allowMissingColumns=True)
    rows = rows.repartition("cell").sortWithinPartitions("cell", F.col("filter").isNull())
    return rows.select("cell", "text_key", "key", "filter").mapInArrow(probe, "text_key binary, key binary")


def text_key(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def drop_lines(docs: DataFrame, threshold: int = 10, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Per document ``doc_id``, ``n_lines``, ``n_dropped``, and the ``kept`` text without the lines that are in
    ``threshold`` documents or more."""
    doomed = frequent_lines(docs, line_counts(docs, text), threshold, text)
    share = max(HEAVY, docs.count() // 1000)  # so at most 1,000 different texts are heavy
    copies = docs.groupBy(text_key(text).alias("text_key")).agg(F.count(F.lit(1)).alias("copies"))
    heavy = F.broadcast(copies.where(F.col("copies") > share).select("text_key", F.lit(True).alias("heavy")))
    some = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("binary").alias("text"), text_key(text).alias("text_key"))
    blank = F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"^[\x20\x09-\x0D]*\z")
    spread = F.when(F.col("heavy").isNotNull() | blank, F.spark_partition_id() % SALTS).otherwise(0)
    some = some.join(heavy, "text_key", "left").withColumn("salt", spread)
    salts = F.when(F.col("heavy").isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    doomed = doomed.join(heavy, "text_key", "left").select("text_key", "keys", F.explode(salts).alias("salt"))
    some = some.join(doomed, ["text_key", "salt"], "left").select("doc_id", "text", "keys")
    schema = T.StructType([some.schema["doc_id"]])
    schema = schema.add("n_lines", "long").add("n_dropped", "long").add("kept", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = buffer_of(batch.column(1))
            for at, to in row_slices(offsets, 4 << 20):
                yield cut(batch.slice(at, to - at))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_lines, n_dropped, kept = [], [], []
        for value, keys in zip(batch.column(1), batch.column(2), strict=True):
            value, drop = value.as_py() or b"", set(keys.as_py() or ())
            lines = value.split(b"\n")
            left = lines
            if drop:
                left = [x for x, k in zip(lines, line_keys(value), strict=True) if not k or key_digest(k) not in drop]
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(left))
            kept.append(b"\n".join(left) if len(left) < len(lines) else value)
        columns = [batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_lines", "n_dropped", "kept"])

    return some.mapInArrow(run, schema).withColumn("kept", F.col("kept").cast("string"))


def clean_texts(docs: DataFrame, threshold: int = 10, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` with their frequent lines dropped; a column ``length``, if there, is counted anew."""
    (more,) = unused(docs.columns, "_")  # a struct needs a field
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text], F.lit(0).alias(more))
    out = drop_lines(docs.select(row.alias("doc_id"), F.col(f"`{text}`").alias("text")), threshold)
    names = {c: F.col("doc_id").getField(c) for c in docs.columns}
    names[text] = F.col("kept")
    if length in names:
        names[length] = F.length("kept").cast(docs.schema[length].dataType)
    return out.select(*[x.alias(c) for c, x in names.items()])
