"""Blocks of documents that trade sorted numbers: how corpus-wide facts reach every document without moving all of them.

Documents are dealt to blocks of a bounded size by a hash of id and text. A block sends each distinct number it holds
once, sorted and packed, to the part that owns the number; parts answer every block with one bit per number sent, in the
same order. So a number that is very frequent reaches a part once per block, whatever its count. Blocks are grouped from
one exchange of the documents, which Spark reuses for each step.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm import bytewords as B

BLOCK_BYTES = 4 << 20


def blocked(docs: DataFrame, text: str, id: str, block_bytes: int = BLOCK_BYTES, **more: Column) -> tuple[DataFrame, int]:
    """``(block, doc_id, text, ...)`` with binary texts, dealt by block, and the number of blocks, from the counted bytes."""
    some = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("binary").alias("text"), *[c.alias(k) for k, c in more.items()])
    total = some.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    tasks = max(n // 4, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")
    return some.select(block.alias("block"), "doc_id", "text", *more).repartition(tasks, "block"), n


def pack(values: np.ndarray, ordered: bool = False) -> bytes:
    """Numbers as planes of bytes, which compress well in the shuffle; ``ordered`` ones as differences."""
    if ordered and len(values):
        values = np.concatenate([values[:1], values[1:] - values[:-1]])
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def unpack(data: bytes, kind=np.uint64, ordered: bool = False) -> np.ndarray:
    size = np.dtype(kind).itemsize
    values = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)
    return np.cumsum(values, dtype=kind) if ordered else values


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part that owns a well mixed number; it rises with the number."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def letters(block: int, part: np.ndarray, columns: dict[str, np.ndarray], ordered: str, kind: int | None = None) -> pa.Table:
    """One row for each part with the packed columns that go there; ``part`` rises, as ``ordered`` does within a part.
    ``kind`` marks the rows where a block sends more than one list."""
    edges = np.flatnonzero(np.diff(part, prepend=-1))
    ends = np.append(edges[1:], len(part))[: len(edges)]  # a block with nothing to send has no edges
    out = {"part": pa.array(part[edges].astype(np.int32)), "block": pa.array(np.full(len(edges), block, np.int32))}
    if kind is not None:
        out["kind"] = pa.array(np.full(len(edges), kind, np.int32))
    for name, values in columns.items():
        out[name] = pa.array([pack(values[a:b], name == ordered) for a, b in zip(edges, ends, strict=True)], pa.binary())
    return pa.table(out)


def answers(parts: pa.Table, bits: list[np.ndarray], kind: int) -> pa.Table:
    """One row of bits for each row that a part has received."""
    return pa.table(
        {
            "block": parts.column("block"),
            "part": parts.column("part"),
            "kind": pa.array(np.full(len(parts), kind, np.int32)),
            "bits": pa.array([np.packbits(b).tobytes() for b in bits], pa.binary()),
        }
    )


ANSWER = "block int, part int, kind int, bits binary"


def bits_of(replies: pa.Table, part: np.ndarray, kind: int) -> np.ndarray:
    """A block's bits, in the order in which it sent its numbers (``part``: the parts they went to, rising)."""
    out = np.zeros(len(part), bool)
    for p, k, bits in zip(replies.column("part").to_pylist(), replies.column("kind").to_pylist(), replies.column("bits").to_pylist(), strict=True):
        if k == kind:
            a, b = np.searchsorted(part, [p, p + 1])
            out[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a).astype(bool)
    return out


def paired(keys: np.ndarray, rests: np.ndarray) -> np.ndarray:
    """One number for each key and rest: the key's rank among those given, then the rest. It is equal for equal pairs only,
    and in the order of the pairs."""
    rank = np.unique(keys, return_inverse=True)[1].astype(np.uint64)
    return rank << np.uint64(32) | rests


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``width`` values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[: len(out) - step], out[step:])
        have += step
    return out


class Windows:
    """The windows of ``width`` units (bytes or words) in one piece of rows.

    ``at``: places of the windows that lie in one row. A window's anchor is the least hash of its grams of ``gram`` units,
    so equal windows have equal anchors; ``anchors`` are the hashes that some window picks, once for each place. ``key`` and
    ``rest``: 32 bits of a hash of the window's first half, then 64 bits of a hash of the whole window (32 of them in
    ``rest``). A run is a row of windows, each one unit after the other, with one anchor; ``run`` numbers them,
    ``run_key`` stands for all units that a run covers.
    """

    def __init__(self, units: np.ndarray, first: np.ndarray, width: int, gram: int):
        n = len(units)
        self.anchors = self.key = self.run_key = self.run_anchor = np.zeros(0, np.uint64)
        self.at = self.run = np.zeros(0, np.int32)
        self.rest = np.zeros(0, np.uint32)
        if n < width:
            return
        up, down = (B._UP[:n], B._DOWN) if n <= len(B._UP) else (B._powers(B._BASE, n), B._powers(B._INVERSE, n))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(units * up, out=sums[1:])

        def hashes(size: int) -> np.ndarray:
            return B.mix((sums[size:] - sums[: n + 1 - size]) * down[: n + 1 - size])

        grams = hashes(gram)
        span = width - gram + 1
        anchor = sliding(grams, span, np.minimum)
        whole = np.ones(n - width + 1, bool)
        for end in first[1:-1].tolist():
            whole[max(0, end - width + 1) : end] = False
        masked = np.where(whole, anchor, np.uint64(0))
        padded = np.concatenate([np.zeros(span - 1, np.uint64), masked, np.zeros(span - 1, np.uint64)])
        self.anchors = B.mix(grams[sliding(padded, span, np.maximum) == grams])
        at = np.flatnonzero(whole)
        if not len(at):
            return
        anchor = anchor[at]
        half = hashes(width // 2)
        head = half[at]
        whole = B.mix(head + B.mix(half[at + width // 2]))
        self.key = head >> np.uint64(32) << np.uint64(32) | whole >> np.uint64(32)
        self.rest = whole.astype(np.uint32)
        new = np.ones(len(at), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
        starts = np.flatnonzero(new)
        begin, end = at[starts], at[np.append(starts[1:], len(at)) - 1] + width
        self.run_key = B.mix(B.mix((sums[end] - sums[begin]) * down[begin]) + (end - begin).astype(np.uint64))
        self.run_anchor = B.mix(anchor[starts])
        self.at, self.run = at.astype(np.int32), (np.cumsum(new) - 1).astype(np.int32)

    def live_runs(self, live: np.ndarray) -> np.ndarray:
        """Which runs have an anchor in ``live`` (sorted)."""
        if not len(live):
            return np.zeros(len(self.run_anchor), bool)
        return live[np.minimum(np.searchsorted(live, self.run_anchor), len(live) - 1)] == self.run_anchor


def anchor_letters(block: int, pieces, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's distinct anchors, the parts they go to, and whether each is at two places or more."""
    found = [w.anchors for w in pieces]
    keys, count = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
    return keys, part_of(keys, parts), count > 1


def live_anchors(group: pa.Table) -> pa.Table:
    return live_numbers(group, 0)


def live_numbers(group: pa.Table, kind: int) -> pa.Table:
    """Answers of a part: which numbers are at two places or more in all blocks together."""
    keys = [unpack(x, ordered=True) for x in group.column("keys").to_pylist()]
    more = [unpack(x, np.uint8).astype(bool) for x in group.column("more").to_pylist()]
    all_keys, count = np.unique(np.concatenate(keys), return_counts=True)
    live = count > 1
    live[np.searchsorted(all_keys, np.concatenate([k[m] for k, m in zip(keys, more, strict=True)]))] = True
    return answers(group, [live[np.searchsorted(all_keys, k)] for k in keys], kind)
