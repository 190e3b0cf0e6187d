"""Each operator against a plain version of its contract, on whole tables with edge cases, and on an empty table."""

from __future__ import annotations

import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleanery.llm import bpe, bwt_dedup, line_dedup, minhash, ngram_model, pii, quality_rules, suffix_trees
from tests.llm import brute

QUALITY = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed"]
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _scored(docs, **more):
    train = F.expr("crc32(cast(doc_id AS string)) % 7 <> 2")
    scores = ngram_model.score_texts(docs, train, **more)
    return scores.withColumn("base_score", F.round("base_score", 4)).withColumn("score", F.round("score", 4))


CASES = {
    "pii": (lambda d: pii.digest(pii.find_pii(d)).drop("spans", "top_score"), brute.pii),
    "lines": (lambda d: line_dedup.drop_lines(d), brute.lines),
    "windows": (lambda d: suffix_trees.drop_repeats(d, digest=True, block_bytes=100_000), brute.windows),
    "windows in one block": (lambda d: suffix_trees.drop_repeats(d).drop("kept"), brute.windows),
    "ngrams": (lambda d: _scored(d, block_bytes=100_000), brute.ngrams),
    "ngrams in one block": (lambda d: _scored(d), brute.ngrams),
    "ngrams of one": (lambda d: _scored(d, order=1, block_bytes=100_000), lambda rows: brute.ngrams(rows, order=1)),
    "ngrams of five": (lambda d: _scored(d, order=5, block_bytes=100_000), lambda rows: brute.ngrams(rows, order=5)),
    "bpe": (lambda d: bpe.bpe(d, VOCABULARY, texts=False), brute.bpe),
    "strings": (lambda d: bwt_dedup.drop_repeats(d, digest=True, block_bytes=100_000), brute.strings),
    "strings in one block": (lambda d: bwt_dedup.drop_repeats(d).drop("kept"), brute.strings),
    "quality": (lambda d: quality_rules.quality_rules(d).select(QUALITY), brute.quality),
    "near": (lambda d: minhash.near_duplicates(d, width=4).select("doc_id", "n_shingles", "component_id", "kept"), brute.near),
}


@pytest.mark.parametrize("name", CASES)
def test_same_rows_as_the_plain_version(name, docs, corpus):
    operator, plain = CASES[name]
    got = sorted((tuple(r) for r in operator(docs).collect()), key=repr)
    assert got == sorted(plain(corpus), key=repr)


@pytest.mark.parametrize("name", CASES)
def test_an_empty_table_gives_no_rows(name, spark):
    empty = spark.createDataFrame([], "doc_id long, text string, kept string")
    assert CASES[name][0](empty).collect() == []


def test_whole_families_of_near_copies_meet_over_chains(spark):
    """Copies that each change some words of the one before: only neighbours are similar, all are one component."""
    words, rows = [f"w{i}" for i in range(200)], []
    for k in range(60):
        words[k * 3 : k * 3 + 2] = [f"x{k}", f"y{k}"]
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(docs, width=4).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == sorted(brute.near(rows))


def test_a_hot_group_of_copies_is_one_class(spark):
    base = " ".join(f"w{i * 7 % 101}" for i in range(120))
    rows = [(k, base if k % 3 else f"{base} only{k} here{k} more{k}") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(docs, width=4).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == sorted(brute.near(rows))


def test_a_crowded_prefix_is_dealt_by_longer_ones(spark, monkeypatch):
    monkeypatch.setattr(suffix_trees, "GROUP", 3)
    head = " ".join(f"h{i}" for i in range(15))
    rows = [(k, f"{head} " + " ".join(f"t{k % 20}_{i}" for i in range(30))) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_trees.drop_repeats(docs, digest=True, block_bytes=4000).collect()
    assert sorted(map(tuple, got)) == sorted(brute.windows(rows))


def test_probabilities_after_any_history_add_up_to_one():
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(list("abcde"), rng.integers(0, 9))) for _ in range(40)]
    table = pa.table({"text": pa.array(texts).cast(pa.binary()), "train": pa.array([True] * 39 + [False])})
    grams = ngram_model._Grams(table, 3)
    v = sum(grams.own[0][grams.keys[0] != ngram_model.START] > 0)
    n = grams.own[0][grams.keys[0] != ngram_model.START].sum()
    automaton = ngram_model.BackoffAutomaton(grams.own, grams.before, grams.rest, n, v, 2.0)
    words = np.flatnonzero(grams.keys[0] != ngram_model.START)
    unknown = ngram_model.DISCOUNT * v / n / (v + 1)
    reached = np.unique(np.concatenate([[0], automaton.arc_to, automaton.root_to]))
    for state in reached:
        if state and not len(automaton.arc[automaton.arc // automaton.words == state]):
            continue  # ends with the end
        known = automaton.step(np.full(len(words), state), words)[1]
        back, here = 0.0, state
        while here:
            back, here = back + automaton.failure_log[here], automaton.failure[here]
        assert abs((10**known).sum() + 10**back * unknown - 1) < 1e-9


def test_many_spans_in_one_text(spark):
    rows = [(n, " ".join(f"höst a{i}@b.org 10.0.{i % 300}.1" for i in range(n))) for n in (1, 2, 3, 7, 8, 9, 5000)]
    found = pii.digest(pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")))
    got = sorted(tuple(r) for r in found.drop("spans", "top_score").collect())
    assert got == sorted(brute.pii(rows))


def test_a_text_with_very_many_spans_takes_seconds(spark):
    rows = [(1, " ".join(f"a{i}@b.org" for i in range(80_000)))]
    began = time.monotonic()
    last = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).select(F.element_at("found", -1)["end"]).first()[0]
    assert last == len(rows[0][1]) and time.monotonic() - began < 60
