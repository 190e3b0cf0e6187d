"""Trie of conversation prefixes by van Emde Boas recursion.

A trie of height 2h is cut at half height: the cut prefixes get names, the sequences above the cut make an upper trie, those
below it a forest of lower tries with the names as roots, and both are built the same way, all at the same time. So a depth d
belongs to the cut of its lowest set bit b: its prefix is the prefix of length d - b, the root of its trie, followed by a block
of b turns. Its name is a digest of the root's name and the block's digest.

* Names of one conversation are made in chunks of 256 turns; the ends of full chunks are the turns of a sequence 256 times
  shorter, which is named first and gives each chunk the name it starts from. So one very long conversation is many rows.
  Turn texts leave the first scan as 128 bits of SHA-256 and a length.
* Equal prefixes have equal names, so one sum per name, which combines before it is shuffled, makes the nodes. Copies and common
  first turns are one row from there on.
* Totals are grafted upward over the nodes alone. From the lowest cut on, each node hands its own total and that of the tries
  hung below it to its root; then, from the highest cut down, the totals at the lower border of each trie are handed to the
  prefixes it was cut at. Both take as many rounds as there are halvings, the logarithm of the longest conversation.
* The ids that end at a node are packed in ranges of 65,536 before they meet, and hashed as they come.

Null roles and texts are empty. Rows with a null ``conv_id`` belong to no conversation and are left out. Turns are ordered by
``turn`` (null first), equal ones by a digest of role and text; repeated rows are turns of their own.
``conv_id - conv_id % 5`` takes the sign of the id, as SQL does. Equal digests of 128 bits are taken as equal. An empty table
gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.saving import saved
from gleanery.llm.turns import turns_of

CHUNK_BITS = 8
CHUNK = 1 << CHUNK_BITS
ID_RANGE_BITS = 16
FAMILY, MOST_SHARED = 5, 8
ROOT = b""


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``(conv, pos, digest, bytes)``, ``pos`` from 0 in the order of the conversation.

    Range partitions over conversation and order are numbered where they are. Only the first conversation of a partition
    can have begun before it; what is ahead of it follows from one row per partition.
    """
    turns = turns_of(conversations.where("conv_id IS NOT NULL"))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv"), "turn", "digest", F.octet_length("text").cast("long").alias("bytes"))
    order = ["conv", rows["turn"].asc_nulls_first(), "digest"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pos, task = None, 0, TaskContext.get().partitionId()
        for batch in batches:
            places = []
            for conv in batch.column("conv").to_pylist():
                now, pos = conv, pos + 1 if conv == now else 0
                places.append(pos)
            columns = [pa.array([task] * len(batch), pa.int32()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, *[batch.column(c) for c in ("conv", "digest", "bytes")]], ["slice", "place", "conv", "digest", "bytes"])

    sliced = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "digest", "bytes")
    sliced = saved(sliced.mapInArrow(number, "slice int, place long, conv long, digest binary, bytes long"))
    edges = sliced.groupBy("slice").agg(F.min("conv").alias("first"), F.max(F.struct("conv", "place")).alias("last")).orderBy("slice").collect()
    ahead, open_conv, so_far = [], None, 0  # one row per partition
    for e in edges:
        if e["first"] == open_conv:
            ahead.append((e["slice"], e["first"], so_far))
        before = so_far if e["last"]["conv"] == open_conv else 0
        open_conv, so_far = e["last"]["conv"], before + e["last"]["place"] + 1
    offsets = sliced.sparkSession.createDataFrame(ahead, "slice int, conv long, ahead long")
    placed = sliced.join(F.broadcast(offsets), ["slice", "conv"], "left")
    return placed.select("conv", (F.col("place") + F.coalesce("ahead", F.lit(0))).alias("pos"), "digest", "bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations ``(conv, length)`` and their turns ``(conv, pos, digest, bytes, length)`` after the first ``h`` turns of the
    family's first conversation have replaced each one's own."""
    shared = F.crc32(F.col("conv").cast("string").cast("binary")) % (MOST_SHARED + 1)
    own = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    heads = own.select(F.col("conv").alias("head"), F.least("n", F.lit(MOST_SHARED)).alias("head_n"))
    convs = own.select("conv", "n", (F.col("conv") - F.col("conv") % FAMILY).alias("head"), shared.alias("h")).join(heads, "head", "left")
    taken = F.least("h", F.coalesce("head_n", F.lit(0)))
    convs = convs.select("conv", "head", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    convs = saved(convs)
    rest = turns.join(convs.drop("head"), "conv").where("pos >= h").withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
    first = turns.where(F.col("pos") < MOST_SHARED).withColumnRenamed("conv", "head").join(convs, "head").where("pos < taken")
    columns = ["conv", "pos", "digest", "bytes", "length"]
    return convs.select("conv", "length"), rest.select(columns).unionByName(first.select(columns))


def _sequence(chunks: list[dict]) -> list[list[bytes]]:
    """Digests of all blocks of 1, 2, 4 ... turns of a chunk that begin at a multiple of their size."""
    blocks = [[t["digest"] for t in chunks]]
    while len(blocks[-1]) > 1:
        last = blocks[-1]
        blocks.append([_short(last[i] + last[i + 1]) for i in range(0, len(last) - 1, 2)])
    return blocks


def _short(x: bytes) -> bytes:
    return hashlib.sha256(x).digest()[:16]


def _full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Full chunks as turns of the shorter sequence."""
    for batch in batches:
        turns = batch.column("turns").to_pylist()
        digests = pa.array([_sequence(x)[CHUNK_BITS][0] for x in turns], pa.binary())
        sizes = pa.array([x[-1]["bytes"] for x in turns], pa.int64())
        columns = [batch.column("conv"), batch.column("chunk"), digests, sizes, batch.column("length")]
        yield pa.RecordBatch.from_arrays(columns, ["conv", "pos", "digest", "bytes", "length"])


_NAMED = "conv long, name binary, depth long, level int, ups array<struct<level:int,up:binary>>, bytes long, ends long"
_UPS = pa.list_(pa.struct([("level", pa.int32()), ("up", pa.binary())]))


def _name(bits: int):
    """Names the depths of each chunk, whose start (and end, if full) have been named. The row of a named end, with null
    ``bytes``, only adds to the prefixes that the end was cut at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, chunk, turns, length, start, end in zip(
                *[batch.column(k).to_pylist() for k in ("conv", "chunk", "turns", "length", "start", "end")], strict=True
            ):
                blocks, names = _sequence(turns), [start or ROOT]
                for t, turn in enumerate(turns[: CHUNK - 1], 1):
                    k = (t & -t).bit_length() - 1
                    names.append(_short(names[t - (1 << k)] + blocks[k][(t >> k) - 1]))
                    depth = (chunk * CHUNK + t) << bits
                    ups = [{"level": bits + i, "up": names[t - (1 << i)]} for i in range(k + 1)]
                    rows.append((conv, names[t], depth, bits + k, ups, turn["bytes"], int(depth == length)))
                if end is not None:
                    ups = [{"level": bits + i, "up": names[CHUNK - (1 << i)]} for i in range(CHUNK_BITS)]
                    rows.append((conv, end, (chunk + 1) * CHUNK << bits, None, ups, None, 0))
            if rows:
                types = (pa.int64(), pa.binary(), pa.int64(), pa.int32(), _UPS, pa.int64(), pa.int64())
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["conv", "name", "depth", "level", "ups", "bytes", "ends"])

    return run


def named_prefixes(turns: DataFrame, longest: int) -> DataFrame:
    """A row for each depth of each conversation: ``conv, name, depth, level, ups, bytes, ends``. ``level`` is the number of the
    depth's lowest set bit, ``ups`` are the names of the prefixes that are shorter by powers of two up to that bit, the last being
    the root's; ``ends`` is 1 at the conversation's end."""
    sequences, bits = [], 0
    while longest >> bits:
        chunk = F.shiftright("pos", CHUNK_BITS).alias("chunk")
        turns_of_chunk = F.sort_array(F.collect_list(F.struct("pos", "digest", "bytes"))).alias("turns")
        chunks = turns.groupBy("conv", chunk).agg(turns_of_chunk, F.max("length").alias("length"))
        sequences.append((bits, chunks))
        bits += CHUNK_BITS
        if longest >> bits:
            sequences[-1] = (bits - CHUNK_BITS, saved(chunks))
            full = sequences[-1][1].where(F.size("turns") == CHUNK)
            turns = full.mapInArrow(_full, "conv long, pos long, digest binary, bytes long, length long")
    out: list[DataFrame] = []
    for bits, chunks in reversed(sequences):
        if out:
            above = _union(out).where("bytes IS NOT NULL").select("conv", F.shiftright("depth", bits + CHUNK_BITS).alias("chunk"), "name")
            ends = above.select("conv", (F.col("chunk") - 1).alias("chunk"), F.col("name").alias("end"))
            chunks = chunks.join(above.withColumnRenamed("name", "start"), ["conv", "chunk"], "left").join(ends, ["conv", "chunk"], "left")
        else:
            nothing = F.lit(None).cast("binary")
            chunks = chunks.select("*", nothing.alias("start"), nothing.alias("end"))
        out.append(chunks.mapInArrow(_name(bits), _NAMED))
        if bits:
            out[-1] = saved(out[-1])
    return _union(out)


def _ends(rows: DataFrame) -> DataFrame:
    """``(name, ends_sha256)`` from ``(name, conv)``: the digest of the sorted ids that end at each node."""
    ids = F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv")), lambda x: x.cast("string"))).alias("ids")
    packed = rows.groupBy("name", F.shiftright("conv", ID_RANGE_BITS).alias("range")).agg(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, done = None, None, []

        def batch_of() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.binary(), pa.string()), strict=True)]
            return pa.RecordBatch.from_arrays(columns, ["name", "ends_sha256"])

        for batch in batches:
            for name, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if name == now:
                    sha.update(b",")
                else:
                    if now is not None:
                        done.append((now, sha.hexdigest()))
                    now, sha = name, hashlib.sha256()
                sha.update(ids.encode())
            if done:
                yield batch_of()
                done = []
        if now is not None:
            done.append((now, sha.hexdigest()))
            yield batch_of()

    in_order = packed.repartition("name").sortWithinPartitions("name", "range")
    return in_order.mapInArrow(run, "name binary, ends_sha256 string")


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("name", "level").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))


def _with(nodes: DataFrame, *given: DataFrame) -> DataFrame:
    """Nodes with what they were given added to their own totals."""
    for g in given:
        more = g.select("name", F.col("saved").alias("more_saved"), F.col("leaves").alias("more_leaves"))
        nodes = nodes.join(more, "name", "left")
        for c in ("saved", "leaves"):
            nodes = nodes.withColumn(c, F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).drop(f"more_{c}")
    return nodes


def _totals(nodes: DataFrame, top: int) -> DataFrame:
    """``(name, saved, leaves)``: what each node is given by the rest of its subtree, in up to two rows.

    ``pending`` is what nodes of higher (then lower) cuts have been given so far; a round takes what is there for its own cut
    and hands it on.
    """
    given: list[DataFrame] = []
    inner: dict[int, DataFrame] = {}
    pending = nodes.where("false").select("name", "level", "saved", "leaves")
    for k in range(top + 1):
        inner[k] = pending.where(F.col("level") == k)
        up = F.element_at("ups", -1)
        at = _with(nodes.where(F.col("level") == k), inner[k]).select(up["up"].alias("name"), "above", "saved", "leaves")
        to_root = at.select("name", F.col("above").alias("level"), "saved", "leaves")
        pending = saved(_summed(pending.where(F.col("level") > k).unionByName(to_root)))
        given.append(inner[k])
    given.append(pending)
    pending = nodes.where("false").select("name", "level", "saved", "leaves")
    for k in range(top, -1, -1):
        mine = pending.where(F.col("level") == k)
        given.append(mine)
        if not k:
            break
        at = _with(nodes.where(F.col("level") == k), inner[k], mine).select(F.explode("ups").alias("up"), "saved", "leaves")
        to_cuts = at.where(F.col("up.level") < k).select("up.up", "up.level", "saved", "leaves").withColumnRenamed("up", "name")
        pending = saved(_summed(pending.where(F.col("level") < k).unionByName(to_cuts)))
    return _union([g.select("name", "saved", "leaves") for g in given])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    convs, turns = rebuilt(numbered_turns(conversations))
    facts = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n"), F.sum((F.col("length") == 0).cast("long")).alias("n_ends"), F.max("length").alias("longest"))
    longest = facts.first().longest or 0
    top = longest.bit_length() - 1
    no_ups = F.array().cast("array<struct<level:int,up:binary>>").alias("ups")
    zero = F.lit(0).cast("long")
    nodes = facts.where("n > 0").select(F.lit(ROOT).alias("name"), zero.alias("depth"), F.lit(top + 1).alias("level"), no_ups, zero.alias("bytes"), "conv", "n", "n_ends")
    ended = convs.where("length = 0").select(F.lit(ROOT).alias("name"), "conv")
    if longest:
        rows = saved(named_prefixes(turns, longest))
        any_of = [F.first(c).alias(c) for c in ("depth", "level", "ups", "bytes")]
        inner = rows.where("bytes IS NOT NULL").groupBy("name").agg(*any_of, F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n"), F.sum("ends").alias("n_ends"))
        if longest >= CHUNK:
            more = rows.where("bytes IS NULL").select("name", F.explode("ups").alias("up")).groupBy("name", "up.level").agg(F.first("up").alias("up"))
            more = more.groupBy("name").agg(F.sort_array(F.collect_list("up")).alias("more"))  # one for each cut
            inner = inner.join(more, "name", "left").withColumn("ups", F.concat(F.coalesce("more", no_ups), "ups")).drop("more")
        nodes = nodes.unionByName(inner)
        ended = ended.unionByName(rows.where("ends = 1").select("name", "conv"))
    above = F.col("depth").bitwiseAND(F.col("depth") - 1)
    own = ((F.col("n") - 1) * F.col("bytes")).alias("saved"), (F.col("n") == F.col("n_ends")).cast("long").alias("leaves")
    nodes = saved(nodes.select("*", *own, F.when(above <= 0, top + 1).otherwise(_level(above)).alias("above")))
    totals = _totals(nodes, top) if longest else nodes.where("false").select("name", "saved", "leaves")
    totals = totals.unionByName(nodes.select("name", "saved", "leaves")).groupBy("name").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))
    parent = F.element_at("ups", 1)["up"]
    children = nodes.where("depth > 0").groupBy(parent.alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    facts_of = nodes.select(F.col("name").alias("parent"), F.col("conv").alias("parent_conv_id"))
    out = nodes.withColumn("parent", F.when(F.col("depth") > 0, parent)).join(totals, "name").join(children, "name", "left").join(_ends(ended), "name", "left")
    return out.join(facts_of, "parent", "left").select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def _level(depth: Column) -> Column:
    """The number of the lowest set bit."""
    return F.bit_count(depth.bitwiseAND(-depth) - 1).cast("int")
