"""Byte-level BPE: a deterministic automaton over tokens, built merge by merge, encodes and decodes whole texts.

A state is the token read last; an arc ``a -> b`` exists when ``b`` may follow ``a`` in the one right tokenization.
The gadget of the merge (u, v) -> w takes the arc to v away from every state whose right edge shows u while v shows on
the left edge of what follows, and adds w with edges of its own. What an edge shows over time is a chain: w shows
itself from its rank on, before that v (or u on the left) from v's rank to w's, and so on. So a gadget is one entry
per merge, and an arc is looked up by walking two short chains; arcs seen are kept in a table.

Encoding follows arcs from left to right through each word that the vocabulary's pre-split gives. As each prefix of a
word has exactly one tokenization, a place that leads nowhere is dropped for good, so steps back stay few.
Decoding emits the labels of the arcs, the tokens' bytes.

The vocabulary file is read on the driver and sent to the tasks (its size is the vocabulary's, not the data's).
Each document gives one row. A null text is an empty text: no tokens. Repeated rows are encoded each on its own; other
columns are not looked at. Texts of any length are encoded whole, in bounded pieces.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.bytewords import buffer_of, row_slices

SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_INNER_BLANK = re.compile(r"\s (?!\S)")
NEVER = 1 << 60
MOST_WORDS, MOST_ARCS = 250_000, 300_000  # entries kept in memory; beyond that they are found anew


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: printable bytes themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TokenAutomaton:
    def __init__(self, vocabulary: bytes):
        spec = json.loads(vocabulary)
        pre = spec["pre_tokenizer"]
        if spec.get("normalizer") or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("only byte-level vocabularies without a normalizer are supported")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens with flags are not supported")
        letters = _byte_letters()
        ids = spec["model"]["vocab"]
        self.labels: dict[int, bytes] = {i: bytes(map(letters.__getitem__, t)) for t, i in ids.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels |= {i: t.encode() for t, i in self.added.items()}
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merge: dict[int, int] = {}
        self.edges: tuple[dict, dict] = ({}, {})
        for place, pair in enumerate(spec["model"]["merges"]):
            self._gadget(place, *(pair.split(" ") if isinstance(pair, str) else pair), ids)
        self.trie: dict[int, tuple[dict | None, int]] = {}
        self.shorter: dict[int, int] = {}  # the longest token that a token begins with, -1 if none
        self._trie(list(ids.values()))
        self.size = {i: len(label) for i, label in self.labels.items()}
        self.longest = max(self.size.values())
        size = max(self.labels) + 1
        self.length = np.array([len(self.labels.get(i, b"")) for i in range(size)], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        self.flat = np.frombuffer(b"".join(self.labels.get(i, b"") for i in range(size)), np.uint8)
        self.arcs: dict[int, bool] = {}
        self.split = regex.compile(SPLIT)
        self.outer = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None

    def _gadget(self, rank: int, left: str, right: str, ids: dict[str, int]) -> None:
        u, v, w = ids[left], ids[right], ids[left + right]
        self.merge[u << 32 | v] = rank
        if w not in self.parts:
            self.parts[w], self.rank[w] = (u, v), rank

    def _trie(self, tokens: list[int]) -> None:
        """``trie``: for each byte the table of what follows and the token that ends there (-1: none)."""
        for t in tokens:
            table, label = self.trie, self.labels[t]
            for b in label[:-1]:
                after = table.get(b)
                if after is None or after[0] is None:
                    after = table[b] = ({}, after[1] if after else -1)
                table = after[0]
            table[label[-1]] = (table.get(label[-1], (None, -1))[0], t)
        for t in tokens:
            table, self.shorter[t] = self.trie, -1
            for b in self.labels[t][:-1]:
                table, found = table[b]
                if found >= 0:
                    self.shorter[t] = found

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """What shows at an edge (0: left, 1: right) of a token, and until which rank."""
        known = self.edges[side].get(token)
        if known is None:
            known, part, until = [], token, NEVER
            while part in self.parts:
                known.append((part, until))
                until, part = self.rank[part], self.parts[part][side]
            known.append((part, until))
            self.edges[side][token] = known
        return known

    def follows(self, a: int, b: int) -> bool:
        """Whether the arc a -> b is left when all gadgets are in.

        A merge across the border takes it away if both parts show when its turn comes. Of equal merges the left
        one goes first: before one across the border inside a, after it inside b.
        """
        right, rank_of = self._edge(b, 0), self.merge.get
        for u, u_until in self._edge(a, 1):
            u <<= 32
            for v, v_until in right:
                rank = rank_of(u | v)
                if rank is not None and rank < u_until and rank <= v_until:
                    return False
        return True

    def _first(self, word: bytes, s: int) -> int:
        """The longest token at a place."""
        table, found = self.trie, -1
        for b in word[s : s + self.longest]:
            after = table.get(b)
            if after is None:
                return found
            table, t = after
            if t >= 0:
                found = t
            if table is None:
                return found
        return found

    def encode_word(self, word: bytes) -> list[int]:
        """Follows arcs to the word's end, the longest token first.

        A place is reached by its one right tokenization or not at all, so a place that leads nowhere is tried once.
        """
        n, s, dead = len(word), 0, set()
        labels, arcs, shorter = self.size, self.arcs, self.shorter
        path: list[int] = []
        t = self._first(word, 0) if n else -1
        while s < n:
            before = path[-1] if path else -1
            while t >= 0:
                if s + labels[t] not in dead:
                    if before < 0:
                        break
                    key = before << 32 | t
                    good = arcs.get(key)
                    if good is None:
                        if len(arcs) >= MOST_ARCS:
                            arcs.clear()
                        good = arcs[key] = self.follows(before, t)
                    if good:
                        break
                t = shorter[t]
            if t >= 0:
                path.append(t)
                s += labels[t]
                if s < n:
                    t = self._first(word, s)
            elif path:
                dead.add(s)
                t = path.pop()
                s -= labels[t]
                t = shorter[t]
            else:
                raise ValueError("a word without a tokenization: the merges are not a BPE vocabulary")
        return path

    def decode(self, ids: np.ndarray) -> bytes:
        size = self.length[ids]
        ends = np.cumsum(size)
        if not len(ids):
            return b""
        shift = np.repeat(self.start[ids] - (ends - size), size)
        return self.flat[shift + np.arange(ends[-1])].tobytes()


def _as_bytes(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class _Known(dict):
    """Strings seen, encoded as little-endian 32-bit ids; forgets all when full."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, key: str) -> bytes:
        out = self.make(key)
        if len(key) < 64:
            if len(self) >= MOST_WORDS:
                self.clear()
            self[key] = out
        return out


class Encoder:
    def __init__(self, vocabulary: bytes):
        self.automaton = a = TokenAutomaton(vocabulary)
        self.word = lambda w: _as_bytes(a.encode_word(w.encode()))
        self.any_word = _Known(self.word)
        self.after_blank = _Known(self._after_blank)

    def _after_blank(self, part: str) -> bytes:
        words = self.automaton.split.findall(" " + part)
        return self.word(words[0]) if len(words) == 1 else b"".join(map(self.any_word.__getitem__, words))

    def _plain(self, text: str) -> Iterator[bytes]:
        """A blank is where the pre-split may be cut unless white space is on both sides of it, or before it at the
        text's end: a run of white space stays whole but for its last character. So other texts are split on their
        own between blanks, each part with the blank before it."""
        split = self.automaton.split
        if not _INNER_BLANK.search(text):
            parts = text.split(" ")
            yield from map(self.word, split.findall(parts[0]))
            yield b"".join(map(self.after_blank.__getitem__, parts[1:]))
            return
        found = split.finditer(text)
        while some := [m.group() for m in islice(found, 1 << 17)]:
            yield b"".join(map(self.any_word.__getitem__, some))

    def encode(self, text: str) -> bytes:
        """The ids of a text, four bytes each."""
        a = self.automaton
        out = []
        for part in a.outer.split(text) if a.outer and any(t in text for t in a.added) else [text]:
            if part in a.added:
                out.append(np.array([a.added[part]], "<u4").tobytes())
            elif part:
                out.extend(self._plain(part))
        return b"".join(out)


_ENCODERS: dict[bytes, Encoder] = {}


def encoder(vocabulary: bytes) -> Encoder:
    """One encoder per vocabulary and worker process."""
    key = hashlib.sha256(vocabulary).digest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary)
    return _ENCODERS[key]


def bpe(docs: DataFrame, vocabulary: str, texts: bool = True, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Per document ``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``, and with ``texts`` the ``token_ids``
    and the ``decoded`` text.

    ``vocabulary`` is the path of a byte-level BPE vocabulary file that the driver can read.
    """
    with open(vocabulary, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    some = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    kind = some.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", token_ids array<int>, decoded string" if texts else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value)
        for batch in batches:
            _, offsets = buffer_of(batch.column(1))
            for at, to in row_slices(offsets):
                yield made(enc, batch.slice(at, to - at))

    def made(enc: Encoder, batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, id_sums, text_sums, all_ids, decoded = [], [], [], [], []
        for value in batch.column(1):
            ids = enc.encode(value.as_py() or "")
            back = enc.automaton.decode(np.frombuffer(ids, "<u4")).decode("utf-8", "replace")
            counts.append(len(ids) // 4)
            id_sums.append(hashlib.sha256(ids).hexdigest())
            text_sums.append(hashlib.sha256(back.encode()).hexdigest())
            if texts:
                all_ids.append(ids)
                decoded.append(back)
        columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_sums, pa.string()), pa.array(text_sums, pa.string())]
        if texts:
            flat = np.frombuffer(b"".join(all_ids), "<u4").astype(np.int32)
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            columns += [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(decoded, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "token_ids", "decoded"][: len(columns)])

    return some.mapInArrow(run, schema)
