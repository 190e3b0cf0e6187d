"""Benchmark decontamination by greedy string tiling.

Tokens are runs of letters, digits and other non-ASCII characters, with A-Z lower-cased. Runs of ``min_match`` tokens are
seeds; a document that shares a seed with a benchmark item becomes a pair. In a pair, the longest common runs of tokens
that no earlier tile covers are marked as tiles, longest first (running Karp-Rabin: hashes of all runs of one length in
the item find the runs in the document, then the length halves or falls), until none of ``min_match`` tokens is left. As
tiles may stand in any order, passages that were moved around count whole. An item is found in a document if tiles
cover ``threshold`` of its tokens.

The benchmark is read in slices of at most ``SLICE_TOKENS`` tokens; each is sent to all tasks, which search their
documents for it, so no document is shuffled and the memory of a task is bounded for a benchmark of any size. A pair looks
only at the places of the document that hold its seeds, so a document that holds many items is not read again for each.

Items with fewer tokens than ``min_match`` are found as a whole run of tokens (``item_tokens`` tells them); as any text may
hold a word or two, ``keep_clean`` drops for them only a document that is the item. Null texts and texts without tokens match
nothing. Equal items each give their own pair; equal documents too. Ids may be null and of any type. Other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from gleanery.llm import bytewords as B
from gleanery.llm.bytewords import row_slices
from gleanery.llm.names import unused

SLICE_TOKENS = 2_000_000
_BREAK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all rows, and where each row's begin."""
    data, offsets = B.buffer_of(texts)
    words = B.find_words(data, offsets, _BREAK)
    return B.word_hashes(data, words, fold=True), words.first


def runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` tokens of one token sequence."""
    return B.windows(hashes, B.Words(hashes, hashes, np.array([0, len(hashes)])), width)[1]


def _longest(doc: np.ndarray, item: np.ndarray, doc_free: np.ndarray, item_free: np.ndarray, low: int) -> int:
    """The length of the longest common run of free tokens, 0 if it is below ``low``.

    Whether some common run has a given length can be bisected: each run holds the shorter ones.
    """

    def common(width: int) -> bool:
        return len(_matches(doc, item, doc_free, item_free, width)[0]) > 0

    if not common(low):
        return 0
    good, bad = low, len(item) + 1
    while bad - good > 1:
        middle = (good + bad) // 2
        good, bad = (middle, bad) if common(middle) else (good, middle)
    return good


def _free_runs(hashes: np.ndarray, free: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    all_runs = runs(hashes, width)
    taken = np.concatenate([[0], np.cumsum(~free)])
    at = np.flatnonzero(taken[width:] == taken[:-width]) if len(all_runs) else np.zeros(0, np.int64)
    return at, all_runs[at]


def _matches(doc, item, doc_free, item_free, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Free runs of the item that are also free runs of the document: places in the item, and the document's runs."""
    item_at, item_runs = _free_runs(item, item_free, width)
    doc_at, doc_runs = _free_runs(doc, doc_free, width)
    doc_hit = np.isin(doc_runs, item_runs)
    doc_at, doc_runs = doc_at[doc_hit], doc_runs[doc_hit]
    return item_at[np.isin(item_runs, doc_runs)], doc_at, doc_runs


def tile(doc: np.ndarray, item: np.ndarray, min_match: int, free: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """The tiles (place in the document, place in the item, length), longest first, then by place in the item, then in the
    document. ``free``: the document's tokens that may be in tiles."""
    doc_free = np.ones(len(doc), bool) if free is None else free.copy()
    item_free, tiles = np.ones(len(item), bool), []
    low = min(min_match, len(item))
    while low and (width := _longest(doc, item, doc_free, item_free, low)):
        item_at, doc_at, doc_runs = _matches(doc, item, doc_free, item_free, width)
        wanted = runs(item, width)
        for i in item_at.tolist():
            if not item_free[i : i + width].all():
                continue
            for d in doc_at[doc_runs == wanted[i]].tolist():
                if doc_free[d : d + width].all() and (doc[d : d + width] == item[i : i + width]).all():
                    doc_free[d : d + width] = item_free[i : i + width] = False
                    tiles.append((d, i, width))
                    break
    return tiles


def around(doc: np.ndarray, seeds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The document's tokens in seeds (``seeds``: their rising places) and whether each is free; between seeds that don't
    touch stands one token that isn't. All tiles lie in seeds."""
    new = np.ones(len(seeds), bool)
    new[1:] = seeds[1:] > seeds[:-1] + width
    begin, end = seeds[new], np.append(seeds[:-1][new[1:]], seeds[-1]) + width
    size = end - begin + 1
    stops = np.cumsum(size) - 1
    places = np.arange(size.sum()) + np.repeat(begin - stops + size - 1, size)
    free = np.ones(len(places), bool)
    free[stops] = False
    return doc[np.minimum(places, len(doc) - 1)], free


class Slice:
    """Some benchmark items, with an index of their seeds."""

    def __init__(self, ids: list, hashes: np.ndarray, first: np.ndarray, min_match: int):
        self.ids, self.hashes, self.first, self.min_match = ids, hashes, first, min_match
        seeds, owners, short = [], [], {}
        for k in range(len(ids)):
            mine = hashes[first[k] : first[k + 1]]
            if len(mine) >= min_match:
                found = np.unique(runs(mine, min_match))
                seeds.append(found)
                owners.append(np.full(len(found), k))
            elif len(mine):
                short.setdefault(len(mine), []).append(k)
        self.by_width: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        if seeds:
            self._index(min_match, np.concatenate(seeds), np.concatenate(owners))
        for width, ks in short.items():
            self._index(width, np.concatenate([runs(hashes[first[k] : first[k + 1]], width) for k in ks]), np.array(ks))

    def _index(self, width: int, seeds: np.ndarray, owners: np.ndarray) -> None:
        order = np.argsort(seeds, kind="stable")
        self.by_width[width] = seeds[order], owners[order]

    def pairs(self, hashes: np.ndarray, words: B.Words) -> Iterator[tuple[int, int, np.ndarray, int]]:
        """(row, item, places of shared seeds in the row, their width), by width, row and item."""
        for width, (seeds, owners) in sorted(self.by_width.items()):
            at, found = B.windows(hashes, words, width)
            coarse = np.zeros(1 << 16, bool)
            coarse[(seeds >> np.uint64(48)).astype(np.int64)] = True
            maybe = np.flatnonzero(coarse[(found >> np.uint64(48)).astype(np.int64)])
            at, found = at[maybe], found[maybe]
            left, right = np.searchsorted(seeds, found), np.searchsorted(seeds, found, side="right")
            hit = np.flatnonzero(right > left)
            if not len(hit):
                continue
            rows = np.searchsorted(words.first, at[hit], side="right") - 1
            size = right[hit] - left[hit]
            items = owners[np.repeat(left[hit] - np.cumsum(size) + size, size) + np.arange(size.sum())]
            pair = np.repeat(rows, size).astype(np.int64) * np.int64(len(self.ids)) + items
            places = np.repeat(at[hit] - words.first[rows], size)
            order = np.argsort(pair, kind="stable")
            pair, places = pair[order], places[order]
            edges = np.flatnonzero(np.diff(pair, prepend=-1))
            for p, where in zip(pair[edges].tolist(), np.split(places, edges[1:]), strict=True):
                yield *divmod(p, len(self.ids)), where, width


def _slices(benchmark: DataFrame, min_match: int, text: str, id: str) -> Iterator[Slice]:
    """The benchmark's items, a bounded number of tokens at a time; only one slice is on the driver at once."""
    ids: list = []
    parts: list[np.ndarray] = []
    n = 0

    def made() -> Slice:
        first = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        return Slice(ids, np.concatenate(parts), first, min_match)

    for row in benchmark.select(F.col(id).alias("id"), F.col(text).alias("text")).toLocalIterator():
        mine = tokens(pa.array([row["text"]], pa.string()))[0]
        if not len(mine):
            continue
        if parts and n + len(mine) > SLICE_TOKENS:
            yield made()
            ids, parts, n = [], [], 0
        ids.append(row["id"])
        parts.append(mine)
        n += len(mine)
    if parts:
        yield made()


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = 5,
    threshold: float = 0.8,
    text: str = "text",
    id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
) -> DataFrame:
    """``(doc_id, item_id, n_tiles, covered, item_tokens, doc_tokens)`` for each item found in a document."""
    some = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    schema_names = ["doc_id", "item_id", "n_tiles", "covered", "item_tokens", "doc_tokens"]
    kinds = some.schema["doc_id"].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, n_tiles int, covered int, item_tokens int, doc_tokens int"
    kind = to_arrow_type(benchmark.schema[item_id].dataType)

    def search(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, offsets = B.buffer_of(batch.column(1))
                for at, to in row_slices(offsets):
                    yield from found(shared.value, batch.slice(at, to - at))

        def found(items: Slice, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            data, offsets = B.buffer_of(batch.column(1))
            words = B.find_words(data, offsets, _BREAK)
            hashes = B.word_hashes(data, words, fold=True)
            rows, ids, counts = [], [], []
            for row, k, seeds, width in items.pairs(hashes, words):
                doc = hashes[words.first[row] : words.first[row + 1]]
                item = items.hashes[items.first[k] : items.first[k + 1]]
                near, free = around(doc, seeds, width)
                tiles = tile(near, item, min_match, free)
                covered = sum(t[2] for t in tiles)
                if covered >= threshold * len(item):
                    rows.append(row)
                    ids.append(items.ids[k])
                    counts.append((len(tiles), covered, len(item), len(doc)))
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(ids, kind)]
            columns += [pa.array([c[j] for c in counts], pa.int32()) for j in range(4)]
            if rows:
                yield pa.RecordBatch.from_arrays(columns, schema_names)

        return run

    out = some.sparkSession.createDataFrame([], schema)
    for items in _slices(benchmark, min_match, item_text, item_id):
        shared = some.sparkSession.sparkContext.broadcast(items)
        out = out.unionByName(some.mapInArrow(search(shared), schema))
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, threshold: float = 0.8, text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item of ``min_match`` tokens or more is found and that are no shorter item, with all
    their columns.

    A document is known by the digest of its text here, so rows without id or with one id twice are judged rightly.
    """
    key = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    keyed = docs.select(key.alias("doc_id"), F.col(text).alias("text"))
    found = contaminated(keyed, benchmark, min_match, threshold)
    found = found.where((F.col("item_tokens") >= min_match) | (F.col("item_tokens") == F.col("doc_tokens")))
    own, leaked = unused(docs.columns, "_text_key", "_found")
    found = found.select(F.col("doc_id").alias(leaked)).distinct()
    return docs.withColumn(own, key).join(found, F.col(own) == F.col(leaked), "left_anti").drop(own)
