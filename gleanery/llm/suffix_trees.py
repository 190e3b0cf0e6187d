"""Removal of repeated word windows, by prefix-partitioned suffix trees.

A word goes if a window of ``width`` words that covers it starts earlier too: in a document with a smaller id, or in the
same one at an earlier word. The steps run over blocks of documents (``blocks``):

1. Anchors. A window's anchor is the least hash of its grams, so equal windows have equal anchors; windows whose anchor
   is at one place only can't be repeated and go no further.
2. Prefixes. Suffixes are read as two fingerprints: 32 bits of the first ``width / 2`` words, 64 bits of all words. Blocks
   send how many distinct suffixes begin with each first symbol. A prefix with more than ``GROUP`` suffixes in all is made
   longer: its suffixes are dealt by both symbols, those of other prefixes by the first one.
3. Trees. Each block sends its distinct suffixes, each with its earliest place, to the part of their prefix. A part builds
   the subtrees of its prefixes: suffixes in order, inner nodes where neighbours share symbols. A node with all symbols in
   common is a repeat; its earliest place stays, and the blocks learn for each suffix sent whether that is theirs.

Two different windows with equal fingerprints would count as one. Of pairs that share their first half, and are told
apart by the other fingerprint alone, p give about p / 2^64 wrong matches.

Each row is a document. Rows with one id are read as one document, so only an earlier word counts between them; rows
without id are read as one document that comes last. A null text has no words. Other columns are not looked at. ``id`` is
a column of whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gleanery.llm import blocks as K
from gleanery.llm import bytewords as B
from gleanery.llm.bytewords import row_slices

GRAM = 8
GROUP = 200_000
LAST = np.iinfo(np.int64).max


class _Block:
    """The suffixes of a block: its texts are scanned twice, for anchors and then for the windows that go on."""

    def __init__(self, table: pa.Table, width: int, parts: int):
        self.table, self.width, self.parts = table, width, parts
        self.number = table.column("block")[0].as_py()
        self.anchors, self.anchor_part, self.anchor_more = K.anchor_letters(0, (w for _, w, _ in self._pieces()), parts)

    def _pieces(self) -> Iterator[tuple[int, K.Windows, B.Words]]:
        data, offsets = B.buffer_of(self.table.column("text"))
        for a, b in row_slices(offsets):
            span = data[offsets[a] : offsets[b]]
            words = B.find_words(span, offsets[a : b + 1] - offsets[a])
            yield a, K.Windows(B.word_hashes(span, words), words.first, self.width, min(GRAM, self.width // 2)), words

    def read(self, replies: pa.Table) -> None:
        """Keeps row, word and key of each window with a live anchor, and the distinct keys with their earliest place."""
        live = self.anchors[K.bits_of(replies, self.anchor_part, 0)]
        rows, places, keys, rests, counts = [], [], [], [], []
        for base, w, words in self._pieces():
            mine = w.live_runs(live)[w.run]
            at = w.at[mine].astype(np.int64)
            row = np.searchsorted(words.first, at, side="right") - 1
            rows.append(row + base)
            places.append(at - words.first[row])
            keys.append(w.key[mine])
            rests.append(w.rest[mine])
            counts.append(np.diff(words.first))
        none = np.zeros(0, np.int64)
        self.row, self.place = np.concatenate([none, *rows]), np.concatenate([none, *places])
        self.n_words = np.concatenate([none, *counts])
        ids = self.table.column("doc_id").cast(pa.int64()).fill_null(LAST).to_numpy()
        self.doc = ids[self.row]
        all_keys, all_rests = (np.concatenate([np.zeros(0, t), *x]) for t, x in ((np.uint64, keys), (np.uint32, rests)))
        pair = K.paired(all_keys, all_rests)
        order = np.lexsort((self.place, self.doc, pair))
        new = np.ones(len(order), bool)
        new[1:] = pair[order][1:] != pair[order][:-1]
        first = order[new]
        self.keys, self.rests, self.first_doc, self.first_place = all_keys[first], all_rests[first], self.doc[first], self.place[first]
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(new) - 1

    def prefixes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct first symbols, mixed and in order, their parts and their numbers of suffixes."""
        symbols, count = np.unique(B.mix(self.keys >> np.uint64(32)), return_counts=True)
        return symbols, K.part_of(symbols, self.parts), count.astype(np.uint32)

    def dealt(self, replies: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """The order in which the distinct suffixes are sent, and the part of each: by a prefix as long as need be."""
        symbols, part, _ = self.prefixes()
        long = K.bits_of(replies, part, 1)
        mixed = B.mix(self.keys >> np.uint64(32))
        longer = long[np.searchsorted(symbols, mixed)] if len(symbols) else np.zeros(0, bool)
        to = K.part_of(np.where(longer, B.mix(self.keys), mixed), self.parts)
        order = np.argsort(to, kind="stable")
        return order, to[order]


def _crowded(group: pa.Table) -> pa.Table:
    """Answers of a part: which prefixes have more suffixes than one group may hold."""
    keys = [K.unpack(x, ordered=True) for x in group.column("keys").to_pylist()]
    counts = [K.unpack(x, np.uint32) for x in group.column("n").to_pylist()]
    symbols, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(inverse, np.concatenate(counts), minlength=len(symbols))
    return K.answers(group, [(total > GROUP)[np.searchsorted(symbols, k)] for k in keys], 1)


def subtree(keys: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The leaves of the tree in order (by symbols, then place in the corpus), and for each the number of symbols that it
    shares with the leaf before; a run that shares both symbols hangs from one deep node."""
    order = np.lexsort((place, doc, keys))
    shared = np.zeros(len(keys), np.int8)
    apart = keys[order][1:] ^ keys[order][:-1]
    shared[1:] = (apart >> np.uint64(32) == 0).astype(np.int8) + (apart == 0)
    return order, shared


def _earliest(group: pa.Table) -> pa.Table:
    """Answers of a part: which suffixes were sent with the earliest place of their node."""
    own = [K.unpack(x, ordered=True) for x in group.column("keys").to_pylist()]
    rest = [K.unpack(x, np.uint32) for x in group.column("rest").to_pylist()]
    doc = np.concatenate([K.unpack(x, np.int64) for x in group.column("doc").to_pylist()])
    place = np.concatenate([K.unpack(x, np.int64) for x in group.column("place").to_pylist()])
    order, shared = subtree(K.paired(np.concatenate(own), np.concatenate(rest)), doc, place)
    node = np.cumsum(shared < 2) - 1  # the deep node, or the single leaf, that a leaf belongs to
    head = order[np.flatnonzero(shared < 2)[node]]
    first = np.zeros(len(order), bool)
    first[order] = (doc[order] == doc[head]) & (place[order] == place[head])
    ends = np.cumsum([len(k) for k in own])
    return K.answers(group, np.split(first, ends[:-1]), 2)


def drop_repeats(
    docs: DataFrame, width: int = 20, text: str = "text", id: str = "doc_id", digest: bool = False, block_bytes: int = K.BLOCK_BYTES
) -> DataFrame:
    """Per document ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and, unless ``digest``, the ``kept`` words
    joined by blanks. ``width`` is even."""
    if width < 4 or width % 2:
        raise ValueError("width must be even and at least 4")
    dealt, n = K.blocked(docs, text, id, block_bytes)
    parts = max(1, n // 4)
    kind = dealt.schema["doc_id"].dataType.simpleString()
    no_keys = np.zeros(0, np.uint64)

    def anchors(table: pa.Table) -> pa.Table:
        b = _Block(table, width, parts)
        return K.letters(b.number, b.anchor_part, {"keys": b.anchors, "more": b.anchor_more}, "keys")

    def prefixes(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(table):
            return K.letters(0, np.zeros(0, np.int64), {"keys": no_keys, "n": np.zeros(0, np.uint32)}, "keys")
        b = _Block(table, width, parts)
        b.read(replies)
        keys, part, count = b.prefixes()
        return K.letters(b.number, part, {"keys": keys, "n": count}, "keys")

    def suffixes(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(table):
            none = np.zeros(0, np.int64)
            return K.letters(0, none, {"keys": no_keys, "rest": np.zeros(0, np.uint32), "doc": none, "place": none}, "keys")
        b = _Block(table, width, parts)
        b.read(replies)
        order, part = b.dealt(replies)
        columns = {"keys": b.keys, "rest": b.rests, "doc": b.first_doc, "place": b.first_place}
        return K.letters(b.number, part, {k: x[order] for k, x in columns.items()}, "keys")

    def removed(table: pa.Table, replies: pa.Table) -> pa.Table:
        b = _Block(table, width, parts)
        b.read(replies)
        order, part = b.dealt(replies)
        earliest = np.zeros(len(order), bool)
        earliest[order] = K.bits_of(replies, part, 2)
        stays = earliest[b.which] & (b.doc == b.first_doc[b.which]) & (b.place == b.first_place[b.which])
        starts = np.concatenate([[0], np.cumsum(b.n_words)])
        change = np.zeros(starts[-1] + 1, np.int32)
        hit = (starts[b.row] + b.place)[~stays]
        np.add.at(change, hit, 1)
        np.add.at(change, hit + width, -1)
        stay = np.cumsum(change[:-1]) == 0
        kept = []
        for i, value in enumerate(table.column("text")):
            mine = stay[starts[i] : starts[i + 1]]
            kept.append(b" ".join(compress((value.as_py() or b"").split(), mine.tolist())))
        out = {
            "doc_id": table.column("doc_id"),
            "n_words": pa.array(b.n_words),
            "n_removed": pa.array(b.n_words - np.diff(np.concatenate([[0], np.cumsum(stay)])[starts])),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
        }
        return pa.table(out if digest else out | {"kept": pa.array(kept, pa.binary()).cast(pa.string())})

    by_block = dealt.groupBy("block")
    sent = "part int, block int, keys binary, "
    live = by_block.applyInArrow(anchors, sent + "more binary").groupBy("part").applyInArrow(K.live_anchors, K.ANSWER)
    counted = by_block.cogroup(live.groupBy("block")).applyInArrow(prefixes, sent + "n binary")
    long = counted.groupBy("part").applyInArrow(_crowded, K.ANSWER)
    told = live.unionByName(long)
    leaves = by_block.cogroup(told.groupBy("block")).applyInArrow(suffixes, sent + "rest binary, doc binary, place binary")
    first = leaves.groupBy("part").applyInArrow(_earliest, K.ANSWER)
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + ("" if digest else ", kept string")
    return by_block.cogroup(told.unionByName(first).groupBy("block")).applyInArrow(removed, schema)
