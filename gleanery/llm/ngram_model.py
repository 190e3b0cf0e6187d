"""Log-probabilities of texts by a weighted backoff automaton over smoothed n-grams of any order.

Tokens are the words of a text with A-Z lower-cased, then one end. Training counts come from the training documents only:
``c(w)``, ``c(h, w)`` for a token after the tokens h (the first of which may be the start), ``N`` tokens and ``V``
different ones. A state stands for a history h of up to ``order - 1`` tokens that was trained on, or for none. It has

* an arc for each w trained on after it, with p(w | h) = (c(h, w) + K p(w | h')) / (c(h) + K), to the state of the longest
  history that the tokens then end with; h' is h without its first token, and
* a failure arc with weight K / (c(h) + K) to the state of h'.

Without history p(w) = max(c(w) - D, 0) / N + D V / N / (V + 1): what discounting sets free is shared evenly by the V words
and one unknown word. So the probabilities after any history, with those of all V words and the unknown one, add up to one,
and a text of unknown words is improbable. Without training documents p is 1 / (V + 1) = 1.

A text is read once from left to right (``BackoffAutomaton.walk``): it carries a state; each token takes failure arcs until
a state has an arc for it, then that arc, and adds up the logarithms of their weights.

The automaton of the whole corpus is never in one place. Blocks of documents (``blocks``) send the n-grams they hold with
their training counts, once each; the owners add the counts over all blocks and answer; each block then builds exactly the
states and arcs that its own texts can reach. An n-gram of three tokens or more is sent only if the two n-grams of one token
less inside it occur in another block too: otherwise it can't either, and the block's own count is the count. All sums
are over the whole corpus; rows are sent only where there is something to send.

A null text is an empty text: one token, the end. Ids may be null or repeat; each row counts. A row whose training flag
is null is held out. Other columns are not looked at. N-grams are known by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm import blocks as K
from gleanery.llm import bytewords as B
from gleanery.llm.bytewords import row_slices

ORDER = 3
DISCOUNT = 0.75
WEIGHT = 8.0  # K above: how many tokens seen after a history weigh as much as the shorter history
START, END = np.uint64(0x1D872B41C5A9F3E7), np.uint64(0xB5297A4D3F84D5B9)
_FEW = 8  # texts still walked at once below which they are walked one by one


class _Grams:
    """The n-grams of a block's texts. Texts stand end to end, each as start, words, end.

    By order (from 1): ``keys``, sorted; ``own``, their training counts in this block; ``before`` and ``rest``, the numbers
    of the n-grams without the last and without the first token. ``word``: the number of each token.
    """

    def __init__(self, table: pa.Table, order: int):
        data, offsets = B.buffer_of(table.column("text"))
        found, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for a, b in row_slices(offsets):
            span = data[offsets[a] : offsets[b]]
            words = B.find_words(span, offsets[a : b + 1] - offsets[a])
            found.append(B.word_hashes(span, words, fold=True))
            counts.append(np.diff(words.first))
        self.size = np.concatenate(counts) + 1
        self.first = np.concatenate([[0], np.cumsum(self.size + 1)])
        token = np.zeros(self.first[-1], np.uint64)
        inner = np.ones(len(token), bool)
        inner[self.first[:-1]] = inner[self.first[1:] - 1] = False
        token[inner] = np.concatenate(found)
        token[self.first[:-1]], token[self.first[1:] - 1] = START, END
        train = np.array([bool(x) for x in table.column("train").to_pylist()], bool)
        self.train = train
        weight = np.repeat(train, self.size + 1)
        place = np.arange(len(token)) - np.repeat(self.first[:-1], self.size + 1)
        self.keys, self.own, self.before, self.rest = [], [], [None], [None]
        key, number = token, np.zeros(0, np.int64)
        for k in range(1, order + 1):
            ends = np.flatnonzero(place >= k - 1)
            if k > 1:
                longer = np.zeros_like(key)
                longer[ends] = B.mix(key[ends - 1] * np.uint64(0x9FB21C651E98DF25) + token[ends])
                key = longer
            keys, at, which = np.unique(key[ends], return_index=True, return_inverse=True)
            if k > 1:
                self.before.append(number[ends[at] - 1])
                self.rest.append(number[ends[at]])
            self.keys.append(keys)
            self.own.append(np.bincount(which, weight[ends], minlength=len(keys)).astype(np.int64))
            number = np.full(len(token), -1, np.int64)
            number[ends] = which
            if k == 1:
                self.word = which

    def sent(self, k: int, answer: np.ndarray | None) -> np.ndarray:
        """Which n-grams of order ``k`` are sent; ``answer``: what was answered for those of one token less."""
        if k <= 2:
            return np.ones(len(self.keys[k - 1]), bool)
        return (answer[self.before[k - 1]] > 0) & (answer[self.rest[k - 1]] > 0)


def _least(values: np.ndarray) -> np.ndarray:
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def _numbers(data: bytes, n: int) -> np.ndarray:
    return K.unpack(data, np.dtype(f"u{len(data) // n}")).astype(np.int64)


_SENT = "part int, block int, kind int, keys binary, count binary"
_REPLY = "block int, part int, kind int, counts binary, n long, v long"


def _letters(block: int, grams: _Grams, k: int, chosen: np.ndarray, parts: int) -> pa.Table:
    keys = grams.keys[k - 1][chosen]
    part = K.part_of(keys, parts)
    edges = np.flatnonzero(np.diff(part, prepend=-1))
    ends = np.append(edges, len(part))[1:]
    count = grams.own[k - 1][chosen]
    return pa.table(
        {
            "part": pa.array(part[edges].astype(np.int32)),
            "block": pa.array(np.full(len(edges), block, np.int32)),
            "kind": pa.array(np.full(len(edges), k, np.int32)),
            "keys": pa.array([K.pack(keys[a:b], True) for a, b in zip(edges, ends, strict=True)], pa.binary()),
            "count": pa.array([K.pack(_least(count[a:b])) for a, b in zip(edges, ends, strict=True)], pa.binary()),
        }
    )


def _sums(group: pa.Table) -> pa.Table:
    """For each n-gram sent to a part 0 if one block alone has it, else its count over all blocks and 1; with the
    part's tokens and different words."""
    own = [K.unpack(x, ordered=True) for x in group.column("keys").to_pylist()]
    count = np.concatenate([_numbers(x, len(k)) for x, k in zip(group.column("count").to_pylist(), own, strict=True)])
    keys, which, blocks = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
    total = np.bincount(which, count, minlength=len(keys)).astype(np.int64)
    answer = np.where(blocks > 1, total + 1, 0)[which]
    ends = np.cumsum([len(k) for k in own])[:-1]
    total[keys == START] = 0
    rows = len(group)
    return pa.table(
        {
            "block": group.column("block"),
            "part": group.column("part"),
            "kind": group.column("kind"),
            "counts": pa.array([K.pack(_least(x)) for x in np.split(answer, ends)], pa.binary()),
            "n": pa.array(np.full(rows, total.sum(), np.int64)),
            "v": pa.array(np.full(rows, (total > 0).sum(), np.int64)),
        }
    )


def _answers(replies: pa.Table, grams: _Grams, order: int, parts: int) -> list[np.ndarray]:
    """What was answered, for all n-grams up to ``order``; 0 for those not sent."""
    rows = sorted(zip(*(replies.column(c).to_pylist() for c in ("kind", "part", "counts")), strict=True))
    out: list[np.ndarray] = []
    for k in range(1, order + 1):
        chosen = np.flatnonzero(grams.sent(k, out[-1] if out else None))
        part = K.part_of(grams.keys[k - 1][chosen], parts)
        answer = np.zeros(len(grams.keys[k - 1]), np.int64)
        for kind, p, counts in rows:
            if kind == k:
                a, b = np.searchsorted(part, [p, p + 1])
                answer[chosen[a:b]] = _numbers(counts, b - a)
        out.append(answer)
    return out


class BackoffAutomaton:
    """States and arcs as arrays. State 0 has no history; the n-grams of each order below ``order`` follow it.

    ``count``: by order, the training counts of n-grams; ``before`` and ``rest`` as in ``_Grams``; ``n``, ``v``: all
    training tokens and the different ones. Words without training count have no arc but the one of state 0.
    """

    def __init__(self, count: list[np.ndarray], before: list, rest: list, n: int, v: int, weight: float):
        order = len(count)
        first = np.concatenate([[1], 1 + np.cumsum([len(c) for c in count])])  # first state of each order
        states = first[order - 1]
        self.words = len(count[0])
        self.failure, self.failure_log = np.zeros(states, np.int64), np.zeros(states)
        share = DISCOUNT * v / n / (v + 1) if n else 1.0 / (v + 1)
        p = np.maximum(count[0] - DISCOUNT, 0) / max(n, 1) + share
        trained = count[0] > 0
        self.root_log = np.log10(p)
        self.root_to = np.where(trained, np.arange(1, self.words + 1), 0) if order > 1 else np.zeros(self.words, np.int64)
        arcs, logs, targets = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)]
        last = np.arange(self.words)  # the last word of each n-gram
        for k in range(1, order):
            self.failure[first[k - 1] : first[k]] = 0 if k == 1 else first[k - 2] + rest[k - 1]
            self.failure_log[first[k - 1] : first[k]] = np.log10(weight / (count[k - 1] + weight))
            p = (count[k] + weight * p[rest[k]]) / (count[k - 1][before[k]] + weight)
            last = last[rest[k]]
            seen = np.flatnonzero(count[k] > 0)
            arcs.append((first[k - 1] + before[k][seen]) * self.words + last[seen])
            logs.append(np.log10(p[seen]))
            targets.append(first[k] + seen if k < order - 1 else first[k - 1] + rest[k][seen])
        arc = np.concatenate(arcs)
        rank = np.argsort(arc, kind="stable")
        self.arc, self.arc_log, self.arc_to = arc[rank], np.concatenate(logs)[rank], np.concatenate(targets)[rank]

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One token for each of some texts: states after it, log10 of the weights passed, failure arcs taken."""
        state, passed, failures = state.copy(), np.zeros(len(state)), np.zeros(len(state), np.int64)
        todo = np.arange(len(state))
        while len(todo):
            here = state[todo]
            root = here == 0
            at_root = todo[root]
            passed[at_root] += self.root_log[word[at_root]]
            state[at_root] = self.root_to[word[at_root]]
            todo, here = todo[~root], here[~root]
            if not len(todo):
                break
            wanted = here * self.words + word[todo]
            at = np.searchsorted(self.arc, wanted)
            hit = np.zeros(len(todo), bool)
            inside = at < len(self.arc)
            hit[inside] = self.arc[at[inside]] == wanted[inside]
            passed[todo[hit]] += self.arc_log[at[hit]]
            state[todo[hit]] = self.arc_to[at[hit]]
            todo, here = todo[~hit], here[~hit]
            passed[todo] += self.failure_log[here]
            state[todo] = self.failure[here]
            failures[todo] += 1
        return state, passed, failures

    def walk(self, word: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log10 of each text's probability and the failure arcs taken. All texts move on by one token at a time, from
        the state of the start; the longest ones, when few are left, each on its own."""
        size = np.diff(first) - 1
        by_size = np.argsort(-size, kind="stable")
        at, size = first[:-1][by_size], size[by_size]
        state = self.root_to[word[at]]
        total, failures = np.zeros(len(at)), np.zeros(len(at), np.int64)
        left, j = len(at), 0
        while left > _FEW or (left and j < size[left - 1]):
            j += 1
            left = int(np.searchsorted(-size, -j, side="right"))
            if left:
                state[:left], passed, failed = self.step(state[:left], word[at[:left] + j])
                total[:left] += passed
                failures[:left] += failed
        for i in range(left):
            total[i], failures[i] = self._alone(int(state[i]), word[at[i] + j + 1 : at[i] + size[i] + 1], total[i], failures[i])
        out, taken = np.empty_like(total), np.empty_like(failures)
        out[by_size], taken[by_size] = total, failures
        return out, taken

    def _alone(self, state: int, word: np.ndarray, total: float, failures: int) -> tuple[float, int]:
        for w in word.tolist():
            while state:
                wanted = state * self.words + w
                at = int(self.arc.searchsorted(wanted))
                if at < len(self.arc) and self.arc[at] == wanted:
                    total += self.arc_log[at]
                    state = int(self.arc_to[at])
                    break
                total += self.failure_log[state]
                state = int(self.failure[state])
                failures += 1
            else:
                total += self.root_log[w]
                state = int(self.root_to[w])
        return total, failures


def score_texts(
    docs: DataFrame,
    train: Column,
    text: str = "text",
    id: str = "doc_id",
    order: int = ORDER,
    weight: float = WEIGHT,
    block_bytes: int = 2 * K.BLOCK_BYTES,
) -> DataFrame:
    """Per document ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (add-one word
    counts), ``score`` and ``n_failures`` (failure arcs taken). ``train`` tells the documents to learn from, ``order`` the
    longest n-grams."""
    dealt, n_blocks = K.blocked(docs, text, id, block_bytes, train=F.coalesce(train, F.lit(False)))
    tasks = max(n_blocks // 4, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = max(1, n_blocks // 4)
    kind = dealt.schema["doc_id"].dataType.simpleString()
    by_block = dealt.groupBy("block")

    def begin(table: pa.Table) -> pa.Table:
        grams, block = _Grams(table, min(order, 2)), table.column("block")[0].as_py()
        every = [_letters(block, grams, k, grams.sent(k, None), parts) for k in range(1, min(order, 2) + 1)]
        return pa.concat_tables(every)

    def longer(k: int):
        def send(table: pa.Table, replies: pa.Table) -> pa.Table:
            grams = _Grams(table, k)
            known = _answers(replies, grams, k - 1, parts)
            return _letters(table.column("block")[0].as_py(), grams, k, grams.sent(k, known[-1]), parts)

        return send

    def scores(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(table):
            return pa.table({f.name: pa.array([], f.type) for f in to_arrow})
        of_all = {k: (n, v) for k, n, v in zip(*(replies.column(c).to_pylist() for c in ("kind", "n", "v")), strict=True) if k == 0}
        n, v = of_all[0]
        grams = _Grams(table, order)
        count = [np.where(x > 0, x - 1, own) for x, own in zip(_answers(replies, grams, order, parts), grams.own, strict=True)]
        score, failures = BackoffAutomaton(count, grams.before, grams.rest, n, v, weight).walk(grams.word, grams.first)
        mine = count[0][grams.word]
        mine[grams.first[:-1]] = 0
        base = np.log10((mine + 1) / (n + v + 1))
        base[grams.first[:-1]] = 0.0
        starts = grams.first[:-1]
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "held_out": pa.array(~grams.train),
                "n_tokens": pa.array(grams.size),
                "n_known": pa.array(np.add.reduceat((mine > 0).astype(np.int64), starts)),
                "train_tokens": pa.array(np.full(len(starts), n, np.int64)),
                "base_score": pa.array(np.add.reduceat(base, starts)),
                "score": pa.array(score),
                "n_failures": pa.array(failures),
            }
        )

    def answered(letters: DataFrame) -> DataFrame:
        return letters.groupBy("part", "kind").applyInArrow(_sums, _REPLY).repartition(tasks, "block")

    replies = answered(by_block.applyInArrow(begin, _SENT))
    of_parts = replies.filter("kind = 1").groupBy("part").agg(F.max("n").alias("n"), F.max("v").alias("v"))
    sums = of_parts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "v")])
    for k in range(3, order + 1):
        letters = by_block.cogroup(replies.groupBy("block")).applyInArrow(longer(k), _SENT)
        replies = replies.unionByName(answered(letters))
    told = sums.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"),
        F.lit(0).alias("part"), F.lit(0).alias("kind"), F.lit(b"").alias("counts"), "n", "v",
    ).repartition(tasks, "block")
    schema = (
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double,"
        " n_failures long"
    )
    to_arrow = _arrow(schema)
    return by_block.cogroup(replies.unionByName(told).groupBy("block")).applyInArrow(scores, schema)


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))
