"""Blocks that have nothing to send, and answers that don't depend on the order in which rows come."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

from gleanery.llm import blocks, bwt_dedup, suffix_trees
from tests.llm import brute


def test_nothing_to_send_gives_no_rows():
    none = blocks.letters(3, np.zeros(0, np.int64), {"keys": np.zeros(0, np.uint64), "more": np.zeros(0, bool)}, "keys", 0)
    assert len(none) == 0 and none.column_names == ["part", "block", "kind", "keys", "more"]


@pytest.mark.parametrize("block_bytes", [300, 4 << 20])
def test_blocks_without_a_repeated_string(spark, block_bytes):
    """Short texts only, texts that share nothing, and blocks of both kinds beside one with copies."""
    rng = random.Random(2)
    unique = ["".join(rng.choice("abcdefgh ") for _ in range(260)) for _ in range(6)]
    short = [(1, "short"), (2, None), (3, ""), (4, "x" * 199), (None, None)]
    for rows in (short, list(enumerate(unique)), [*short, *enumerate(unique, 10), (20, unique[0]), (21, unique[1][30:240])]):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = bwt_dedup.drop_repeats(docs, digest=True, block_bytes=block_bytes).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(brute.strings(rows), key=repr)


@pytest.mark.parametrize("block_bytes", [300, 4 << 20])
def test_blocks_without_a_repeated_window(spark, block_bytes):
    rng = random.Random(2)
    unique = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(999)) for _ in range(40)) for _ in range(6)]
    short = [(1, "short"), (2, None), (3, ""), (4, "x " * 19)]
    for rows in (short, list(enumerate(unique)), [*short, *enumerate(unique, 10), (20, unique[0])]):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = suffix_trees.drop_repeats(docs, digest=True, block_bytes=block_bytes).collect()
        assert sorted(map(tuple, got)) == sorted(brute.windows(rows))


def test_the_cover_that_goes_on_is_the_same_in_any_order():
    """Two blocks hold one cover of a core with another cover; which block goes on is asked twice and must be told alike."""
    core, cover = [np.array([5, 9], np.uint64), np.array([9, 9], np.uint64)], [np.array([1, 2], np.uint64), np.array([2, 3], np.uint64)]
    rows = [
        {"part": 0, "block": k, "keys": blocks.pack(x, True), "cover": blocks.pack(y), "more": blocks.pack(np.zeros(2, bool))}
        for k, (x, y) in enumerate(zip(core, cover, strict=True))
    ]
    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("cover", pa.binary()), ("more", pa.binary())])

    def told(some):
        return {(b, kind): np.unpackbits(np.frombuffer(x, np.uint8), count=2).tolist() for b, _, kind, x in (r.values() for r in bwt_dedup._told(pa.Table.from_pylist(some, schema)).to_pylist())}

    assert told(rows) == told(rows[::-1]) == {(0, 0): [0, 1], (1, 0): [1, 0], (0, 1): [0, 1], (1, 1): [0, 1]}


def test_copies_with_changes_send_few_strings():
    """Of near copies only what is near a change is asked about string by string."""
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh ") for _ in range(20_000))
    near = "".join("#" if i % 1000 == 500 else c for i, c in enumerate(text))
    shards = [bwt_dedup._Shard(pa.table({"block": pa.array([k], pa.int32()), "text": [t.encode()]}), 200, 1) for k, t in enumerate((text, near))]
    told = bwt_dedup._told(pa.concat_tables([s.asks() for s in shards]))
    for k, s in enumerate(shards):
        s.read(told.filter(pa.compute.equal(told["block"], k)))
        assert len(s.keys) < 20 * 2 * 100 and len(s.places) > 20 * 600


@pytest.mark.parametrize("length", [22, 40, 200])
def test_any_length(spark, length):
    rng = random.Random(5)
    some = ["".join(rng.choice("ab") for _ in range(rng.choice([15, 21, 22, 39, 40, 100, 250]))) for _ in range(8)]
    rows = [(k, "".join(rng.choice(some) for _ in range(rng.randrange(6)))) for k in range(60)]
    got = bwt_dedup.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length, digest=True, block_bytes=2000).collect()
    assert sorted(map(tuple, got)) == sorted(brute.strings(rows, length))
