"""Near-duplicates by circulant MinHash, banding and exact confirmation.

Two permutations of the numbers below 2^32 give all coordinates of a signature: the first scatters the shingles once,
and coordinate k is the least value of the second over the scattered shingles, moved k places around the ring. Bands of
four coordinates find candidates; a link counts only when the full shingle sets confirm it.

Texts with one shingle set are one class, so copies never meet each other.

1. In each bucket of a band every class is compared with the bucket's smallest class only; confirmed links join classes
   into components, and classes that share buckets, directly or over others, are a family.
2. Where a family still holds several components, pairs across components are compared too, in blocks of bounded size:
   on full sets, where the signatures agree as much as those of similar sets do (six standard deviations below the mean
   at the least similarity). A block gives out only links that join components, so never more rows than it has.

Pairs within one component need no comparison, so no link that matters to the components is left out except with the
chance that banding misses a pair (below 1e-7 at similarity 0.8 with 32 bands of 4, far less above) or that the
agreement test does (below 1e-8).

Each row is a document; a null text is an empty text. Texts without a word have an empty set, no links, and themselves as
component. Texts with fewer words than a shingle are one shingle. Ids may be null or repeat: a component's id is its
smallest id that is not null. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm import bytewords as B
from gleanery.llm.components import components
from gleanery.llm.line_dedup import text_key
from gleanery.llm.names import unused
from gleanery.llm.saving import saved

BANDS, ROWS = 32, 4
BLOCK, BLOCK_SHINGLES = 4000, 2_000_000  # classes, and their shingles, on each side of one step within a family


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of all rows, as (row, hash) in order of row, then hash."""
    words = B.find_words(data, offsets)
    hashes = B.word_hashes(data, words, fold=True)
    at, found = B.windows(hashes, words, width)
    rows = [np.searchsorted(words.first, at, side="right") - 1]
    all_found = [found]
    count = np.diff(words.first)
    for n in range(1, width):
        if (short := np.flatnonzero(count == n)).size:
            at, found = B.windows(hashes, words, n)
            row = np.searchsorted(words.first, at, side="right") - 1
            mine = np.isin(row, short)
            rows.append(row[mine])
            all_found.append(found[mine] ^ np.uint64(n))
    row, found = np.concatenate(rows), np.concatenate(all_found)
    order = np.lexsort((found, row))
    row, found = row[order], found[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
    return row[new], found[new]


def _permuted(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit numbers."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signatures(found: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """A row of ``size`` coordinates for each set; the sets follow each other in ``found``, from ``starts`` on."""
    out = np.empty((len(starts), size), np.uint32)
    scattered = _permuted((found >> np.uint64(32)).astype(np.uint32) * np.uint32(0x9E3779B1))
    for k in range(size):
        out[:, k] = np.minimum.reduceat(_permuted(scattered + np.uint32(k)), starts)
    return out


def _band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(sig), bands), np.uint64)
    for j in range(rows):
        out = B.mix(out + sig[:, j::rows][:, :bands].astype(np.uint64) + np.uint64(1))
    return B.mix(out + np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def sets(docs: DataFrame, width: int, text: str, id: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per document its set's digest, size, band keys and the low bytes of its signature (null for an empty set)."""
    some = docs.select(F.col(id).alias("doc_id"), text_key(text).alias("text_key"), F.col(text).cast("binary").alias("text"))
    kind = some.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = B.buffer_of(batch.column(2))
            for a, b in B.row_slices(offsets):
                row, found = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)
                n = np.bincount(row, minlength=b - a)
                full = np.flatnonzero(n)
                starts = (np.cumsum(n) - n)[full]
                ends = starts + n[full]
                keys, band, sig = [None] * (b - a), [None] * (b - a), [None] * (b - a)
                if len(full):
                    made = signatures(found, starts, bands * rows)
                    band_keys, low = _band_keys(made, bands, rows), made.astype(np.uint8)
                    for i, r in enumerate(full.tolist()):
                        keys[r] = hashlib.md5(found[starts[i] : ends[i]].tobytes(), usedforsecurity=False).digest()
                        band[r], sig[r] = band_keys[i], low[i].tobytes()
                columns = [c.slice(a, b - a) for c in (batch.column(0), batch.column(1))]
                columns += [pa.array(keys, pa.binary()), pa.array(n, pa.int64()), pa.array(band, pa.list_(pa.int64())), pa.array(sig, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "set_key", "n_shingles", "bands", "sig"])

    schema = f"doc_id {kind}, text_key binary, set_key binary, n_shingles long, bands array<long>, sig binary"
    return some.mapInArrow(run, schema)


def _overlap(first: pa.Array, second: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the intersections and unions of the shingle sets of two columns of texts."""
    n = len(first)
    sides = [shingles(*B.buffer_of(x), width) for x in (first, second)]
    row, found = np.concatenate([s[0] for s in sides]), np.concatenate([s[1] for s in sides])
    order = np.lexsort((found, row))
    row, found = row[order], found[order]
    twice = row[1:][(row[1:] == row[:-1]) & (found[1:] == found[:-1])]
    shared = np.bincount(twice, minlength=n)
    return shared, np.bincount(row, minlength=n) - shared


def confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``: set keys) whose full sets have ``100 * shared >= percent * union``."""
    left = texts.select(F.col("set_key").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("set_key").alias("b"), F.col("text").alias("b_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = B.buffer_of(batch.column(2))
            for a, b in B.row_slices(offsets):
                some = batch.slice(a, b - a)
                shared, union = _overlap(some.column(2), some.column(3), width)
                yield some.select(["a", "b"]).filter(pa.array(100 * shared >= percent * union))

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "a_text", "b_text")
    return both.mapInArrow(run, "a binary, b binary")


class _Roots:
    """Union-find over small numbers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def of(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x


def _joined(width: int, percent: int, least: int):
    """Links that join components within one block of a family.

    Pairs whose components are joined already need no comparison; the others are confirmed on full sets where the
    signatures agree in ``least`` places. Only links that join something are given out, so no more than there are rows.
    """

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        keys, label = group.column("set_key").to_pylist(), group.column("label").to_pylist()
        parts = np.array(group.column("part").to_pylist())
        one, two = int(group.column("one")[0].as_py()), int(group.column("two")[0].as_py())
        names = {x: i for i, x in enumerate(dict.fromkeys(label))}
        label = np.array([names[x] for x in label])
        roots = _Roots(len(names))
        sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint8).reshape(len(keys), -1)
        row, found = shingles(*B.buffer_of(group.column("text")), width)
        first = np.searchsorted(row, np.arange(len(keys) + 1))
        size = np.diff(first)
        other = np.flatnonzero(parts == two)
        a, b = [], []
        for i in np.flatnonzero(parts == one).tolist():
            mine = found[first[i] : first[i + 1]]
            js = other[label[other] != label[i]]
            agree = (sig[js] == sig[i]).sum(axis=1)
            js = js[agree >= least][np.argsort(-agree[agree >= least], kind="stable")]
            js = js[100 * np.minimum(size[js], size[i]) >= percent * np.maximum(size[js], size[i])]
            while len(js):
                home = roots.of(int(label[i]))
                js = js[[roots.of(x) != home for x in label[js].tolist()]]
                some, js = js[:64], js[64:]
                if not len(some):
                    break
                theirs = np.concatenate([found[first[j] : first[j + 1]] for j in some])
                at = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
                ends = np.cumsum(size[some])
                hits = np.concatenate([[0], np.cumsum(mine[at] == theirs)])
                shared = hits[ends] - hits[ends - size[some]]
                for j in some[100 * shared >= percent * (size[some] + size[i] - shared)].tolist():
                    x, y = roots.of(int(label[i])), roots.of(int(label[j]))
                    if x != y:
                        roots.up[x] = y
                        a.append(min(keys[i], keys[j]))
                        b.append(max(keys[i], keys[j]))
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return run


def _links(all_sets: DataFrame, docs: DataFrame, width: int, percent: int, text: str, bands: int, rows: int) -> DataFrame:
    """Confirmed links between classes, enough of them to join all classes that similarity joins."""
    classes = all_sets.where("set_key IS NOT NULL").groupBy("set_key").agg(
        F.min("text_key").alias("text_key"), F.first("bands").alias("bands"), F.first("sig").alias("sig"),
        F.first("n_shingles").alias("n_shingles"),
    )
    banded = classes.select("set_key", F.explode("bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.min("set_key").alias("hub"), F.count("*").alias("n")).where("n > 1")
    crowded = saved(banded.join(hubs.select("band", "hub"), "band"))  # only buckets with company
    star = saved(crowded.where("set_key <> hub").select(F.col("hub").alias("a"), F.col("set_key").alias("b")).distinct())
    needed = crowded.select("set_key").distinct()
    one_text = classes.select("set_key", "text_key").join(needed, "set_key", "left_semi")
    whole = docs.select(text_key(text).alias("text_key"), F.col(text).cast("binary").alias("text"))
    texts = saved(one_text.join(whole, "text_key").groupBy("set_key").agg(F.first("text").alias("text")))
    first = saved(confirm(star, texts, width, percent))

    families, labels = components(star), components(first)
    families = families.select(F.col("node").alias("set_key"), F.col("label").alias("family"))
    labels = labels.select(F.col("node").alias("set_key"), "label")
    member = families.join(labels, "set_key", "left").join(classes.select("set_key", "sig", "n_shingles"), "set_key")
    member = member.select("set_key", "family", F.coalesce("label", "set_key").alias("label"), "sig", "n_shingles")
    mixed = member.groupBy("family").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"), F.sum("n_shingles").alias("size")
    )
    mixed = mixed.where((F.col("low") != F.col("high")) & (F.col("n") > 2))
    parts = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("size") / BLOCK_SHINGLES)).cast("int")
    left = member.join(mixed.select("family", parts.alias("parts")), "family").join(texts, "set_key")
    left = left.withColumn("part", F.pmod(F.xxhash64("set_key"), F.col("parts")).cast("int"))
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    left = left.select("family", "set_key", "label", "sig", "text", "part", F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"))
    similarity, size = percent / 100, bands * rows
    least = int(size * similarity - 6 * (size * similarity * (1 - similarity)) ** 0.5)
    rest = left.groupBy("family", "one", "two").applyInArrow(_joined(width, percent, least), "a binary, b binary")
    return first.unionByName(rest)


def _members(docs: DataFrame, width: int, percent: int, text: str, id: str, bands: int, rows: int) -> DataFrame:
    """Per document ``doc_id``, ``text_key``, ``n_shingles`` and its component's ``label``, null without a word."""
    all_sets = saved(sets(docs, width, text, id, bands, rows))
    labels = components(_links(all_sets, docs, width, percent, text, bands, rows))
    members = all_sets.select("doc_id", "text_key", "set_key", "n_shingles")
    return members.join(labels, members["set_key"] == labels["node"], "left").select(
        "doc_id", "text_key", "n_shingles", F.coalesce("label", "set_key").alias("label")
    )


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    text: str = "text",
    id: str = "doc_id",
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Per document ``doc_id``, ``text_key`` (digest of its text), ``n_shingles``, ``component_id`` and ``kept``.

    ``kept`` marks the document with the component's id; a document without id is kept if its component has no id.
    """
    members = _members(docs, width, percent, text, id, bands, rows)
    least = members.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("least"))
    out = members.join(least, "label", "left").select(
        "doc_id", "text_key", "n_shingles", F.coalesce("least", "doc_id").alias("component_id")
    )
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row of ``docs`` for each component, with all its columns, and all rows without a word. Within a component the
    least id stays, null last, then the least digest of the text; of rows with one id and text the least row as JSON."""
    members = _members(docs, width, percent, text, id, BANDS, ROWS).select("label", "doc_id", "text_key")
    counted = members.where("label IS NOT NULL").groupBy("label", "doc_id", "text_key").agg(F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key", "n")
    one = counted.groupBy("label").agg(F.min(order).alias("one")).select("one.doc_id", "one.text_key", "one.n")
    empty = members.where("label IS NULL").select("doc_id", "text_key").distinct().withColumn("n", F.lit(1).cast("long"))
    own, its_id, its_key, its_n = unused(docs.columns, "_text_key", "_id", "_key", "_n")
    found = saved(one.unionByName(empty).select(F.col("doc_id").alias(its_id), F.col("text_key").alias(its_key), F.col("n").alias(its_n)))
    keyed = docs.withColumn(own, text_key(text))
    match = (F.col(own) == F.col(its_key)) & F.col(f"`{id}`").eqNullSafe(F.col(its_id))
    out = keyed.join(found.where(F.col(its_n) == 1), match, "left_semi").drop(own)
    repeated = found.where(F.col(its_n) > 1)
    if repeated.isEmpty():
        return out
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    same = keyed.join(repeated, match, "left_semi").groupBy(F.col(own), F.col(f"`{id}`").alias(its_id))
    return out.unionByName(same.agg(F.min_by(row, F.to_json(row)).alias("_row")).select("_row.*"))
