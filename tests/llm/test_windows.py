"""Windows that share one half and agree in 32 bits of the other half's hash are still different."""

from __future__ import annotations

import numpy as np

from gleanery.llm import blocks, bwt_dedup, suffix_trees
from gleanery.llm import bytewords as B
from tests.llm import brute


def colliding(units: np.ndarray) -> tuple[int, int]:
    """Two rows of units whose hashes agree in the upper 32 bits."""
    top = B.mix((units * B._UP[: units.shape[1]]).sum(1, dtype=np.uint64)) >> np.uint64(32)
    order = np.argsort(top, kind="stable")
    k = np.flatnonzero(top[order][1:] == top[order][:-1])[0]
    return int(order[k]), int(order[k + 1])


def test_strings_with_a_shared_half_and_a_half_collision_stay(spark):
    rng = np.random.default_rng(5)
    tails = rng.integers(97, 123, (300_000, 100), np.uint8)
    one, two = (tails[k].tobytes() for k in colliding(B._TABLE[tails]))
    assert one != two
    heads = [rng.integers(97, 123, 100, np.uint8).tobytes() for _ in range(20)]
    rows = [(2 * k + j, (h + t).decode()) for k, h in enumerate(heads) for j, t in enumerate((one, two))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = bwt_dedup.drop_repeats(docs, digest=True, block_bytes=2000).collect()
    assert sorted(map(tuple, got)) == sorted(brute.strings(rows))


def test_word_windows_with_a_shared_half_and_a_half_collision_stay(spark):
    rng = np.random.default_rng(6)
    names = [f"w{i}" for i in range(5000)]
    data = " ".join(names).encode()
    hashes = B.word_hashes(np.frombuffer(data, np.uint8), B.find_words(np.frombuffer(data, np.uint8), np.array([0, len(data)])))
    tails = rng.integers(0, len(names), (300_000, 10))
    one, two = (" ".join(names[w] for w in tails[k]) for k in colliding(hashes[tails]))
    assert one != two
    heads = [" ".join(names[w] for w in rng.integers(0, len(names), 10)) for _ in range(20)]
    rows = [(2 * k + j, f"{h} {t}") for k, h in enumerate(heads) for j, t in enumerate((one, two))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_trees.drop_repeats(docs, digest=True, block_bytes=2000).collect()
    assert sorted(map(tuple, got)) == sorted(brute.windows(rows))


def test_pairs_are_equal_only_with_key_and_rest():
    keys = np.array([5, 5, 1 << 63, 5, 0], np.uint64)
    rests = np.array([9, 8, 9, 9, 1 << 31], np.uint32)
    pair = blocks.paired(keys, rests)
    assert pair[0] == pair[3] and len(np.unique(pair)) == 4
    assert (np.argsort(pair, kind="stable") == np.lexsort((rests, keys))).all()
