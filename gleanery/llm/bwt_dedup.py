"""Byte-exact removal of repeated strings, by merging the sorted suffixes of shards.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else too. Three steps, each over blocks of
documents (``blocks``):

1. Anchors and sectors. A string's anchor is the first of its least short grams, so repeated strings share it and its
   distance from their start. ``SECTORS`` ranges of that distance cut the strings of an anchor into runs: what all strings
   of such a range have in common is their core, what a run's strings cover together is their cover. Equal strings have
   equal cores. A cover at two places or more makes all its strings known to be repeated, and strings whose core has one
   cover only can't be repeated otherwise; they go no further. Of a core with several covers, the strings of each cover
   take part in what follows from one place, so that others can meet them.
2. Shards. Each block is a shard: it orders its remaining suffixes by their first ``length`` bytes, read as two
   fingerprints (32 bits of the first half, 64 bits of all), and sends each distinct one once to the part that owns its range.
3. Merging. A part merges its shards two by two. The interleave of two shards starts as one interval and is refined
   symbol by symbol: an interval of equal prefixes splits where the next symbols differ, which moves neither shard's
   own order. Suffixes that share an interval after the last symbol have a common prefix of ``length`` bytes. A part
   reads them as two symbols: the rank of the first 64 bits among all that it holds, and the last 32 bits.

The symbols are kept with the suffixes, as steps back through a transform would lead out of the part. Two different
strings with equal fingerprints would count as repeated. Of pairs that share their first half, and are told apart
by the other fingerprint alone, p give about p / 2^64 wrong matches. Cores and covers have a fingerprint of 64 bits each: of
pairs of covers with one core, p give about p / 2^64 wrong matches; a wrong match of cores alone changes nothing.

Each row is a document; repeated rows are repeats of each other. A null text is an empty text. Ids may be null or repeat.
Other columns are not looked at. Long texts are read whole, in overlapping pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gleanery.llm import blocks as K
from gleanery.llm import bytewords as B
from gleanery.llm.bytewords import row_slices

PIECE = 1 << 19
GRAM = 20
SECTORS = 4


class _Strings:
    """The strings of ``length`` bytes in one piece of rows.

    ``at``: places of those that lie in one row. They come in runs of neighbours with one anchor place and sector; ``sizes``
    has the strings of each run, ``core`` and ``cover`` stand for what they share and what they cover.
    """

    def __init__(self, data: np.ndarray, first: np.ndarray, length: int):
        n, self.half = len(data), length // 2
        self.at, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.core = self.cover = np.zeros(0, np.uint64)
        if n < length:
            return
        up, self.down = (B._UP[:n], B._DOWN) if n <= len(B._UP) else (B._powers(B._BASE, n), B._powers(B._INVERSE, n))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(B._TABLE[data] * up, out=self.sums[1:])
        whole = np.ones(n - length + 1, bool)
        for end in first[1:-1].tolist():
            whole[max(0, end - length + 1) : end] = False
        at = np.flatnonzero(whole)
        if not len(at):
            return
        grams = B.mix((self.sums[GRAM:] - self.sums[: n + 1 - GRAM]) * self.down[: n + 1 - GRAM])
        low = np.uint64((1 << (PIECE + length).bit_length()) - 1)  # bits of a place; the least gram is told by the others
        least = K.sliding(grams & ~low | np.arange(len(grams), dtype=np.uint64), length - GRAM + 1, np.minimum)
        place = (least[at] & low).astype(np.int64)
        span = length - GRAM + 1
        sector = (place - at) * SECTORS // span
        slot = place * SECTORS + sector
        starts = np.flatnonzero(np.diff(slot, prepend=-1))
        self.at, self.sizes = at.astype(np.int32), np.diff(np.append(starts, len(at)))
        place, sector = place[starts], sector[starts]
        nearest, farthest = -(-sector * span // SECTORS), -(-(sector + 1) * span // SECTORS) - 1
        self.core = B.mix(self._hashes(place - nearest, place - farthest + length) + sector.astype(np.uint64))
        begin, end = at[starts], at[starts + self.sizes - 1] + length
        self.cover = B.mix(self._hashes(begin, end) + (end - begin).astype(np.uint64))

    def _hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return B.mix((self.sums[end] - self.sums[begin]) * self.down[begin])

    def keys(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of strings: 32 bits of a hash of the first half, then 64 bits of a hash of the whole, 32 of them in the second array."""
        head, tail = self._hashes(at, at + self.half), self._hashes(at + self.half, at + 2 * self.half)
        whole = B.mix(head + B.mix(tail))
        return head >> np.uint64(32) << np.uint64(32) | whole >> np.uint64(32), whole.astype(np.uint32)


def pieces(column: pa.Array, length: int) -> Iterator[tuple[int, _Strings]]:
    """The strings of all rows, with the place in the block's bytes where each piece begins."""
    data, offsets = B.buffer_of(column)
    for a, b in row_slices(offsets, PIECE):
        lo, hi = int(offsets[a]), int(offsets[b])
        if b - a > 1 or hi - lo <= PIECE:
            yield lo, _Strings(data[lo:hi], offsets[a : b + 1] - lo, length)
            continue
        for start in range(lo, hi, PIECE):
            end = min(hi, start + PIECE + length - 1)
            yield start, _Strings(data[start:end], np.array([0, end - start]), length)


def merge(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two sorted lists of distinct suffixes (keys of two symbols of 32 bits, and whether each is repeated) become one.

    ``level`` numbers the intervals of suffixes that agree so far; each round refines it by one more symbol.
    """
    (a, a_more), (b, b_more) = one, two
    level_a, level_b = np.zeros(len(a), np.uint64), np.zeros(len(b), np.uint64)
    for shift in (32, 0):
        low = np.uint64(0xFFFFFFFF)
        sym_a = level_a << np.uint64(32) | (a >> np.uint64(shift) & low)
        sym_b = level_b << np.uint64(32) | (b >> np.uint64(shift) & low)
        # the interleave: before which suffix of the first shard each suffix of the second one stands
        place = np.searchsorted(sym_a, sym_b) + np.arange(len(b))
        both = np.empty(len(a) + len(b), np.uint64)
        from_b = np.zeros(len(both), bool)
        from_b[place] = True
        both[from_b], both[~from_b] = sym_b, sym_a
        new = np.ones(len(both), np.uint64)
        new[1:] = both[1:] != both[:-1]
        level = np.cumsum(new) - np.uint64(1)
        level_a, level_b = level[~from_b], level[from_b]
    starts = np.flatnonzero(new)  # intervals of suffixes with all symbols in common
    keys, more = np.empty(len(both), np.uint64), np.empty(len(both), bool)
    keys[from_b], keys[~from_b] = b, a
    more[from_b], more[~from_b] = b_more, a_more
    size = np.diff(np.append(starts, len(both)))
    return keys[starts], (np.logical_or.reduceat(more, starts) if len(starts) else more) | (size > 1)


def _merged(group: pa.Table) -> pa.Table:
    """Answers of a part: which suffixes are repeated in all shards together."""
    first = [K.unpack(x, ordered=True) for x in group.column("keys").to_pylist()]
    rest = [K.unpack(x, np.uint32) for x in group.column("rest").to_pylist()]
    own = np.split(K.paired(np.concatenate(first), np.concatenate(rest)), np.cumsum([len(k) for k in first])[:-1])
    more = [K.unpack(x, np.uint8).astype(bool) for x in group.column("more").to_pylist()]
    todo = list(zip(own, more, strict=True))
    while len(todo) > 1:
        todo = [merge(*todo[i : i + 2]) if i + 1 < len(todo) else todo[i] for i in range(0, len(todo), 2)]
    keys, repeated = todo[0]
    return K.answers(group, [repeated[np.searchsorted(keys, k)] for k in own], 2)


def _told(group: pa.Table) -> pa.Table:
    """Answers of a part on covers: 0, it is at two places or more; 1, its core has others too and yours is the one that goes on.

    Rows come from the shuffle in any order, and this is worked out more than once: the block with the least number goes on.
    """
    group = group.sort_by("block")
    own = [K.unpack(x, ordered=True) for x in group.column("keys").to_pylist()]
    core = np.concatenate(own)
    cover = np.concatenate([K.unpack(x) for x in group.column("cover").to_pylist()])
    more = np.concatenate([K.unpack(x, np.uint8) for x in group.column("more").to_pylist()])
    order, new_core, new = _ordered(core, cover)
    pair, which_core = np.cumsum(new) - 1, np.cumsum(new_core) - 1
    known, goes_on = np.empty(len(core), bool), np.empty(len(core), bool)
    known[order] = (np.bincount(pair, 1 + more[order]) > 1)[pair]
    goes_on[order] = new & (np.bincount(which_core, new) > 1)[which_core]
    ends = np.cumsum([len(k) for k in own])[:-1]
    return pa.concat_tables([K.answers(group, np.split(bits, ends), kind) for kind, bits in enumerate((known, goes_on))])


def _ordered(core: np.ndarray, cover: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order by core, then cover, then place; where a core begins in it, and where a cover of a core does."""
    order = np.lexsort((cover, core))
    new_core = np.ones(len(order), bool)
    new_core[1:] = core[order][1:] != core[order][:-1]
    new = new_core.copy()
    new[1:] |= cover[order][1:] != cover[order][:-1]
    return order, new_core, new


class _Shard:
    """A block's suffixes; its texts are scanned once."""

    def __init__(self, table: pa.Table, length: int, parts: int):
        self.number = table.column("block")[0].as_py()
        self.pieces = list(pieces(table.column("text"), length))
        core, cover = (np.concatenate([np.zeros(0, np.uint64), *x]) for x in ([w.core for _, w in self.pieces], [w.cover for _, w in self.pieces]))
        order, _, new = _ordered(core, cover)
        self.first_run = order[new]
        self.which_cover = np.empty(len(order), np.int64)
        self.which_cover[order] = np.cumsum(new) - 1
        self.core, self.cover = core[self.first_run], cover[self.first_run]
        self.more = np.bincount(self.which_cover, minlength=len(self.core)) > 1
        self.part = K.part_of(self.core, parts)

    def asks(self) -> pa.Table:
        return K.letters(self.number, self.part, {"keys": self.core, "cover": self.cover, "more": self.more}, "keys")

    def read(self, replies: pa.Table) -> None:
        """``places``: where suffixes known to be repeated begin. ``keys``, ``rests``: distinct suffixes that take
        part, in order, ``sure``: whether one is known to be repeated or is here twice. ``open``, ``which``: where the
        others begin, and which of the keys they are."""
        repeated = K.bits_of(replies, self.part, 0)[self.which_cover]
        goes_on = np.zeros(len(repeated), bool)
        goes_on[self.first_run] = K.bits_of(replies, self.part, 1)
        at = 0
        done, todo, sure = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
        keys, rests = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
        for base, w in self.pieces:
            n = len(w.sizes)
            known = np.repeat(repeated[at : at + n], w.sizes)
            some = np.flatnonzero(np.repeat(goes_on[at : at + n], w.sizes))
            at += n
            done.append(w.at[known] + np.int64(base))
            todo.append(w.at[some] + np.int64(base))
            if len(some):
                for out, x in zip((keys, rests), w.keys(w.at[some]), strict=True):
                    out.append(x)
            sure.append(known[some])
        self.pieces = []
        self.places, self.open, known = np.concatenate(done), np.concatenate(todo), np.concatenate(sure)
        all_keys, all_rests = np.concatenate(keys), np.concatenate(rests)
        _, at, self.which, count = np.unique(K.paired(all_keys, all_rests), True, True, True)
        self.keys, self.rests = all_keys[at], all_rests[at]
        self.sure = count > 1
        self.sure[self.which[known]] = True


def drop_repeats(
    docs: DataFrame, length: int = 200, text: str = "text", id: str = "doc_id", digest: bool = False, block_bytes: int = K.BLOCK_BYTES
) -> DataFrame:
    """Per document ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal runs removed), ``kept_sha256`` and,
    unless ``digest``, the ``kept`` bytes.

    ``length`` is even and above ``GRAM``.
    """
    if length <= GRAM or length % 2:
        raise ValueError(f"length must be even and above {GRAM}")
    dealt, n = K.blocked(docs, text, id, block_bytes)
    parts = max(1, n // 4)
    kind = dealt.schema["doc_id"].dataType.simpleString()

    def asked(block: pa.Table) -> pa.Table:
        return _Shard(block, length, parts).asks()

    def shard(block: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(block):
            none = {"keys": np.zeros(0, np.uint64), "rest": np.zeros(0, np.uint32), "more": np.zeros(0, bool)}
            return K.letters(0, np.zeros(0, np.int64), none, "keys")
        s = _Shard(block, length, parts)
        s.read(replies)
        return K.letters(s.number, K.part_of(s.keys, parts), {"keys": s.keys, "rest": s.rests, "more": s.sure}, "keys")

    def removed(block: pa.Table, replies: pa.Table) -> pa.Table:
        data, offsets = B.buffer_of(block.column("text"))
        s = _Shard(block, length, parts)
        s.read(replies)
        repeated = K.bits_of(replies, K.part_of(s.keys, parts), 2)
        hit = np.unique(np.concatenate([s.places, s.open[repeated[s.which]]]))
        change = np.zeros(len(data) + 1, np.int32)
        np.add.at(change, hit, 1)
        np.add.at(change, hit + length, -1)
        gone = np.cumsum(change[:-1]) > 0
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        begins[edges] = gone[edges]
        sums = [np.concatenate([[0], np.cumsum(x)])[offsets] for x in (gone, begins)]
        kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        out = {
            "doc_id": block.column("doc_id"),
            "n_bytes": pa.array(np.diff(offsets)),
            "n_removed": pa.array(np.diff(sums[0])),
            "n_spans": pa.array(np.diff(sums[1])),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
        }
        return pa.table(out if digest else out | {"kept": pa.array(kept, pa.binary())})

    sent = "part int, block int, keys binary, rest binary, more binary"
    by_block = dealt.groupBy("block")
    asks = by_block.applyInArrow(asked, "part int, block int, keys binary, cover binary, more binary")
    told = asks.groupBy("part").applyInArrow(_told, K.ANSWER)
    shards = by_block.cogroup(told.groupBy("block")).applyInArrow(shard, sent)
    repeated = shards.groupBy("part").applyInArrow(_merged, K.ANSWER)
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ("" if digest else ", kept binary")
    return by_block.cogroup(told.unionByName(repeated).groupBy("block")).applyInArrow(removed, schema)
