"""Chat formatting by assembling tokens: segments are encoded one by one, reserved ids are put between them.

A turn reads ``<|im_start|>role\\ntext<|im_end|>\\n``. The two markers are ids of their own behind the vocabulary, so no
text can produce them. Role header, text and the line end are encoded separately, so a turn's ids depend on nothing around
it. The loss mask comes from prefix sums: +1 where an assistant's text begins, -1 where it ends, at offsets that are
themselves prefix sums of the segments' lengths.

Control strings in a text are escaped so that they can't be read as markers in the text form either: each ``<``, any number
of backslashes and ``|`` gets one backslash more, and loses it when read back. In a role, line ends and backslashes are
escaped as well, as the role ends with its line.

Turns are range-partitioned over conversation and order, so a conversation of any length is spread over tasks; each task
formats the turns it has, in pieces of bounded size. A row of the result is one piece: nearly always a whole conversation.

Null roles and texts are empty. Rows with a null ``conv_id`` are one conversation. Equal turn numbers are ordered by a
digest of role and text; repeated rows are formatted each on its own. An empty table gives no rows. Texts of any length are
encoded whole. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from gleanery.llm.bpe import Encoder, encoder
from gleanery.llm.turns import turns_of

START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"
PIECE_TURNS, PIECE_TOKENS = 4096, 1 << 20  # a piece ends behind the turn that reaches one of them
BATCH_TOKENS = 1 << 21

_PLAIN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _PLAIN.sub(r"<\\\1|", text) if "|" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "|" in text else text


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Chat:
    """Ids and masks of turns for one vocabulary, and the way back."""

    def __init__(self, enc: Encoder):
        if any(not t.startswith("<|") for t in enc.automaton.added):
            raise ValueError("the vocabulary has control strings that the escape does not cover")
        self.enc, self.heads = enc, {}
        self.start = max(enc.automaton.labels) + 1
        self.end = self.start + 1
        self.tail = np.concatenate([[self.end], self._ids("\n")]).astype(np.int32)

    def _ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.enc.encode(text), "<u4").astype(np.int32)

    def _head(self, role: str) -> np.ndarray:
        known = self.heads.get(role)
        if known is None:
            known = np.concatenate([[self.start], self._ids(escape_role(role) + "\n")]).astype(np.int32)
            if len(self.heads) < 1000 and len(role) < 100:
                self.heads[role] = known
        return known

    def assemble(self, turns: list[tuple[str, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids and the loss mask of (role, ids of the text) one after the other."""
        segments = [x for role, body in turns for x in (self._head(role), body, self.tail)]
        ends = np.cumsum([len(x) for x in segments])
        begin, end = ends[0::3], ends[1::3]
        trained = np.array([role == TRAINED for role, _ in turns])
        change = np.zeros(ends[-1] + 1, np.int32)
        np.add.at(change, begin[trained], 1)
        np.add.at(change, end[trained], -1)
        return np.concatenate(segments), np.cumsum(change[:-1]) > 0

    def body(self, text: str) -> np.ndarray:
        return self._ids(escape(text))

    def text_of(self, ids: np.ndarray) -> str:
        return self.enc.automaton.decode(ids).decode()

    def read(self, ids: np.ndarray, mask: np.ndarray) -> tuple[list[tuple[str, str]], list[str], int]:
        """From ids and mask alone: (role, text) of each turn, each run of text under the mask, and the number of
        characters of the whole, markers included."""
        starts, ends = np.flatnonzero(ids == self.start), np.flatnonzero(ids == self.end)
        turns, chars = [], len(START) * len(starts) + len(END) * len(ends)
        for a, b, after in zip(starts, ends, [*starts[1:], len(ids)], strict=True):
            inner = self.text_of(ids[a + 1 : b])
            chars += len(inner) + len(self.text_of(ids[b + 1 : after]))
            role, _, text = inner.partition("\n")
            turns.append((unescape_role(role), unescape(text)))
        edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
        return turns, [unescape(self.text_of(ids[a:b])) for a, b in zip(edges[0::2], edges[1::2], strict=True)], chars


def _vocabulary(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


class _Pieces:
    """Finished pieces, given out as batches of a bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.tokens = schema, [], 0

    def add(self, conv, piece: int, whole: bool, n_turns: int, ids: np.ndarray, mask: np.ndarray) -> None:
        self.rows.append((conv, piece, whole, n_turns, ids, mask))
        self.tokens += len(ids)

    def batch(self) -> pa.RecordBatch:
        conv, piece, whole, n_turns, ids, masks = zip(*self.rows, strict=True)
        ends = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32))
        columns = [pa.array(x, self.schema.field(i).type) for i, x in enumerate((conv, piece, whole, n_turns))]
        columns += [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x))) for x in (ids, masks)]
        self.rows, self.tokens = [], 0
        return pa.RecordBatch.from_arrays(columns, self.schema.names)


def format_conversations(conversations: DataFrame, vocabulary: str) -> DataFrame:
    """``conv_id``, ``piece``, ``whole``, ``n_turns``, ``token_ids`` and ``loss_mask`` (one flag a token).

    ``conversations`` has ``conv_id``, ``turn``, ``role`` and ``text``; ``vocabulary`` is the path of a byte-level BPE
    vocabulary file that the driver can read. The pieces of a conversation follow each other by ``piece``; ``whole`` rows
    are known to be all of theirs.
    """
    shared = _vocabulary(conversations, vocabulary)
    turns = turns_of(conversations)
    order = ["conv_id", turns["turn"].asc_nulls_first(), "digest"]
    sorted_turns = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "role", "text")
    kind = sorted_turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chat, place = Chat(encoder(shared.value)), TaskContext.get().partitionId() << 32
        out = now = None
        turns: list[tuple[str, np.ndarray]] = []
        tokens, n_pieces, first, first_conv = 0, 0, True, True

        def close(whole: bool) -> None:
            nonlocal turns, tokens, n_pieces, place
            ids, mask = chat.assemble(turns)
            out.add(now, place, whole and n_pieces == 0, len(turns), ids, mask)
            turns, tokens, n_pieces, place = [], 0, n_pieces + 1, place + 1

        for batch in batches:
            if out is None:
                types = (batch.schema.field(0).type, pa.int64(), pa.bool_(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.bool_()))
                out = _Pieces(pa.schema(list(zip(("conv_id", "piece", "whole", "n_turns", "token_ids", "loss_mask"), types, strict=True))))
            for conv, role, text in zip(*batch.columns, strict=True):
                conv = conv.as_py()
                if first or conv != now:
                    if turns:
                        close(whole=not first_conv)
                    first_conv, first, now, n_pieces = first, False, conv, 0
                elif len(turns) >= PIECE_TURNS or tokens >= PIECE_TOKENS:
                    close(whole=False)
                body = chat.body(text.as_py())
                turns.append((role.as_py(), body))
                tokens += len(body)
                if out.tokens >= BATCH_TOKENS:
                    yield out.batch()
        if turns:
            close(whole=False)  # the next task may have more of it
        if out is not None and out.rows:
            yield out.batch()

    schema = f"conv_id {kind}, piece long, whole boolean, n_turns long, token_ids array<int>, loss_mask array<boolean>"
    return sorted_turns.mapInArrow(run, schema)


def digest(formatted: DataFrame, vocabulary: str) -> DataFrame:
    """What the formatted rows say, read back from ids and mask alone, one row per conversation.

    Whole conversations are read and hashed in place. The pieces of others go to one task each, in order, and are hashed as
    they come, since a digest is made from front to back.
    """
    shared = _vocabulary(formatted, vocabulary)
    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "piece", "n_turns", "turns", "loss_chars", "loss", "formatted_chars", "whole"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chat = Chat(encoder(shared.value))
        for batch in batches:
            rows = []
            for conv, piece, whole, _, ids, mask in zip(*batch.columns, strict=True):
                whole = whole.as_py()
                turns, loss, chars = chat.read(ids.values.to_numpy(), mask.values.to_numpy(zero_copy_only=False))
                said, trained = "".join(f"{r}\n{t}\n" for r, t in turns).encode(), "".join(loss)
                parts = [said, trained.encode()]
                if whole:
                    parts = [hashlib.sha256(x).digest() for x in parts]
                rows.append((conv.as_py(), piece.as_py(), len(turns), parts[0], len(trained), parts[1], chars, whole))
            if rows:
                types = (batch.schema.field(0).type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, sums, hashes, rows, schema = None, True, None, None, [], None

        def made() -> tuple:
            return (now, sums[0], hashes[0].hexdigest(), sums[1], hashes[1].hexdigest(), sums[2])

        for batch in batches:
            schema = schema or pa.schema([("conv_id", batch.schema.field(0).type), *_DIGEST])
            for row in batch.to_pylist():
                conv = row["conv_id"]
                if row["whole"]:
                    rows.append((conv, row["n_turns"], row["turns"].hex(), row["loss_chars"], row["loss"].hex(), row["formatted_chars"]))
                    continue
                if first or conv != now:
                    if not first:
                        rows.append(made())
                    now, first, sums, hashes = conv, False, [0, 0, 0], [hashlib.sha256(), hashlib.sha256()]
                sums = [a + row[k] for a, k in zip(sums, ("n_turns", "loss_chars", "formatted_chars"), strict=True)]
                hashes[0].update(row["turns"])
                hashes[1].update(row["loss"])
            if rows:
                yield _table(rows, schema)
                rows = []
        if not first:
            yield _table([made()], schema)

    schema = f"conv_id {kind}, piece long, n_turns long, turns binary, loss_chars long, loss binary, formatted_chars long, whole boolean"
    out = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    said = formatted.mapInArrow(read, schema)
    return said.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(join, out)


_DIGEST = [("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
