"""The classifier's parts against plain loops: word vectors over all documents, pooled features, slopes, ids."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest

from gleanery.llm import bytewords, quality_classifier as Q

TEXTS = ["the cat saw the dog", "", None, "one", "two two", " Cat\tDOG 12, the\n\ncat ", "é ü the " * 3, "a b c d e f g h " * 20]


def numbers(texts):
    """For each text the hash bucket and the shape of each word."""
    out = []
    for t in texts:
        _, bucket, shape, _ = Q._keys(*bytewords.buffer_of(pa.array([(t or "").encode()], pa.binary())))
        out.append((bucket.tolist(), shape.tolist()))
    return out


def plain_sums(texts):
    totals = np.zeros((Q.BUCKETS, Q.SIZE)), np.zeros((Q.SHAPES, Q.SIZE))
    for text in numbers(texts):
        for total, keys, seed in zip(totals, text, (Q.SEED, Q.SEED + 1), strict=True):
            index = Q.index_vectors(len(total), seed)
            for i, k in enumerate(keys):
                for j in range(max(0, i - 2), min(len(keys), i + 3)):
                    total[k] += index[keys[j]]
    return totals


def unit(total):
    return total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1)


@pytest.mark.parametrize("at_once", [1, 3, 1 << 17])
def test_sums_equal_plain_loops(monkeypatch, at_once):
    monkeypatch.setattr(Q, "WORDS", at_once)
    got = Q.context_sums(*bytewords.buffer_of(pa.array([(t or "").encode() for t in TEXTS], pa.binary())))
    for a, b in zip(got, plain_sums(TEXTS), strict=True):
        np.testing.assert_array_equal(a, b)


def test_word_vectors_come_from_all_documents(spark):
    docs = spark.createDataFrame([(t,) for t in TEXTS * 3], "text string").repartition(5)
    for a, b in zip(Q.word_vectors(docs), plain_sums(TEXTS * 3), strict=True):
        np.testing.assert_allclose(a, unit(b), atol=1e-6)
    assert not any(x.any() for x in Q.word_vectors(docs.limit(0)))


def test_pooled_features_equal_plain_ones():
    vectors = tuple(unit(x).astype(np.float32) for x in plain_sums(TEXTS))
    got = Q.pooled(*bytewords.buffer_of(pa.array([(t or "").encode() for t in TEXTS], pa.binary())), vectors)
    for row, text, (buckets, kinds) in zip(got, TEXTS, numbers(TEXTS), strict=True):
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        n = max(1, len(words))
        want = np.concatenate([sum((vectors[0][k] for k in buckets), np.zeros(Q.SIZE)) / n, sum((vectors[1][k] for k in kinds), np.zeros(Q.SIZE)) / n])
        rest = [sum(a == b for a, b in zip(words, words[1:])) / n, len(set(words)) / n, np.log1p(len(words)), sum(map(len, words)) / n]  # noqa: B905
        np.testing.assert_allclose(row, [*want, *rest], atol=1e-4)


def test_unlabelled_documents_change_the_vectors(spark):
    some = [(i, f"good calm words {i}" if i % 2 else f"junk $$ {i} !!") for i in range(60)]
    docs, labels = spark.createDataFrame(some, "doc_id long, text string"), spark.createDataFrame([(i, i % 2) for i, _ in some], "doc_id long, quality int")
    more = docs.unionByName(spark.createDataFrame([(None, "calm new words")] * 5, "doc_id long, text string"))
    a, b = Q.fit(docs, labels), Q.fit(more, labels)
    assert (a.vectors[0] != b.vectors[0]).any()


def test_an_id_that_many_documents_have_is_one_row_of_the_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(Q, "train", lambda vectors, x, y: seen.append(len(y)))
    docs = spark.createDataFrame([(2, f"text {i}") for i in range(500)] + [(i, "x") for i in range(3, 40)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "1 as quality")
    Q.fit(docs, labels)
    assert seen == [docs.where(Q.fold("doc_id") != 1).select("doc_id").distinct().count()]
