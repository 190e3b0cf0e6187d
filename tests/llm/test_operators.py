"""What the contracts leave open: method parts, stage forms, the classifier, decontamination and the pipeline."""

from __future__ import annotations

import random
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gleanery.llm import bwt_dedup, components, line_dedup, minhash, pii, quality_classifier, quality_rules, queries, tiling
from gleanery.llm.bpe import Encoder
from tests.llm import brute
from tests.llm.conftest import SMALL


def test_every_number_has_one_query():
    numbered = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op"))
    assert numbered == list(range(1, 14)) and "pipeline" in queries.QUERIES
    assert set(queries.SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", ["op1_pii", "op9_quality_rules"])
def test_native_operators_have_no_python(name, spark):
    plan = queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "Exchange"))


def test_spans_beyond_the_base_need_checksum_or_context(spark):
    good, bad = "DE89 3704 0044 0532 0130 00", "DE88 3704 0044 0532 0130 00"
    rows = [(1, f"IBAN {good} ok"), (2, f"IBAN {bad} ok"), (3, "ssn 123-45-6789"), (4, "code 123-45-6789"), (5, "ssn 000-45-6789")]
    got = pii.digest(pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"))).select("doc_id", "spans").collect()
    spans = {r[0]: r[1] for r in got}
    assert spans == {1: "iban:5:32", 2: "", 3: "ssn:4:15", 4: "", 5: ""}


def test_long_runs_do_not_slow_the_patterns(spark):
    rows = [(1, "a" * 300_000 + "@"), (2, "1." * 150_000), (3, "a@" + "b." * 100_000 + "c"), (4, "9 " * 150_000), (5, "+1" + "-" * 300_000)]
    got = pii.digest(pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"))).orderBy("doc_id").collect()
    assert [r.n_email for r in got] == [0, 0, 1, 0, 0]
    assert got[1].n_ip == 150_000 // 4


class TestLines:
    def docs(self, spark, ids):
        return spark.createDataFrame([(i, f"Top line \nown {i}\nshared {i % 2}") for i in ids], "doc_id long, text string")

    def test_documents_that_leave_take_their_counts_along(self, spark):
        first, second = self.docs(spark, range(8)), self.docs(spark, range(8, 13))
        counts = line_dedup.line_counts(first)
        grown = line_dedup.add_documents(counts, second)
        assert {tuple(r) for r in grown.collect()} == {tuple(r) for r in line_dedup.line_counts(first.union(second)).collect()}
        back = line_dedup.remove_documents(grown, second)
        assert {tuple(r) for r in back.collect()} == {tuple(r) for r in counts.collect()}

    def test_filters_follow_keys_in_and_out(self, spark):
        keys = [line_dedup.key_digest(str(i).encode()) for i in range(3000)]
        frame = lambda xs: spark.createDataFrame([(bytearray(x),) for x in xs], "key binary")
        made = line_dedup.filters(frame(keys[:2000]), 4)
        moved = line_dedup.move_filters(made, frame(keys[2000:2100]), frame(keys[:500]), 4)
        known = {r["shard"]: line_dedup.CuckooFilter.read(bytes(r["filter"])) for r in moved.collect()}
        shard = line_dedup._shards_of(keys, 4)
        hit = [bool(known[s].contains(np.frombuffer(k, np.uint64).reshape(1, 2))[0]) for s, k in zip(shard, keys, strict=True)]
        assert all(hit[500:2100]) and sum(hit[:500]) < 20 and sum(hit[2100:]) < 20

    @pytest.mark.parametrize("per_shard", [100_000, 3])
    def test_lines_dealt_to_their_filters_give_the_same_rows(self, docs, corpus, monkeypatch, per_shard):
        monkeypatch.setattr(line_dedup, "MAX_FILTER_BYTES", 0)
        monkeypatch.setattr(line_dedup, "KEYS_PER_SHARD", per_shard)
        assert sorted(map(tuple, line_dedup.drop_lines(docs).collect()), key=repr) == sorted(brute.lines(corpus), key=repr)

    def test_dealt_lines_that_no_filter_knows_go_no_further(self, spark):
        docs = spark.createDataFrame([(f"{i}", f"own {i}\nshared") for i in range(400)], "id string, text string")
        some = docs.select(line_dedup.text_key("text").alias("text_key"), F.col("text").cast("binary").alias("text"))
        hot = spark.createDataFrame([(bytearray(line_dedup.key_digest(b"shared")),)], "key binary")
        found = line_dedup._probed_by_shard(some, line_dedup.filters(hot, 3), 3)
        keys = [bytes(r["key"]) for r in found.collect()]
        assert keys.count(line_dedup.key_digest(b"shared")) == 400 and len(keys) < 410

    def test_copies_and_blank_texts_are_spread(self, spark, monkeypatch):
        monkeypatch.setattr(line_dedup, "HEAVY", 20)
        texts = [(i, t) for i, t in enumerate(["same\nlines"] * 300 + [None, "", " \n\t"] * 40 + ["same\nown"] * 5 + ["own"])]
        docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(8)
        got = {r["doc_id"]: tuple(r)[1:] for r in line_dedup.drop_lines(docs).collect()}
        assert got == {r[0]: tuple(r[1:]) for r in brute.lines(texts)}

    def test_other_columns_stay(self, docs):
        out = line_dedup.clean_texts(docs)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes and out.count() == docs.count()


def test_merged_shards_equal_one_sort():
    rng = np.random.default_rng(3)
    shards = [np.unique(rng.integers(0, 40, 60).astype(np.uint64) << np.uint64(32) | rng.integers(0, 3, 60).astype(np.uint64)) for _ in range(5)]
    got, more = shards[0], np.zeros(len(shards[0]), bool)
    for s in shards[1:]:
        got, more = bwt_dedup.merge((got, more), (s, np.zeros(len(s), bool)))
    keys, count = np.unique(np.concatenate(shards), return_counts=True)
    assert (got == keys).all() and (more == (count > 1)).all()


def test_pieces_of_long_texts_find_the_same_repeats(spark, monkeypatch):
    monkeypatch.setattr(bwt_dedup, "PIECE", 700)
    rng = random.Random(4)
    text = "".join(rng.choice("abcd ") for _ in range(4000))
    rows = [(1, text), (2, "x" + text[500:2300]), (3, "ab" * 900), (4, "unique " * 2)]
    got = bwt_dedup.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string"), digest=True, block_bytes=3000).collect()
    assert sorted(map(tuple, got)) == sorted(brute.strings(rows))


def test_encoder_equals_the_library_on_hard_texts():
    rng = random.Random(9)
    alphabets = ["ab 's\n\té1.,!<|>eotхд", "aaab ", " \n\t 　x'", [chr(c) for c in range(0x20, 0x2FF)], "0123456789 ²½", "\U0001f600é a"]
    rows = [(k, "".join(rng.choice(alphabets[k % len(alphabets)]) for _ in range(rng.randrange(90)))) for k in range(3000)]
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        encoder = Encoder(f.read())
    for (_, text), (_, n, ids, decoded) in zip(rows, brute.bpe(rows), strict=True):
        mine = encoder.encode(text)
        assert (len(mine) // 4, brute.sha(mine)) == (n, ids)
        assert brute.sha(encoder.automaton.decode(np.frombuffer(mine, "<u4"))) == decoded


class TestTiling:
    def hashes(self, text):
        return tiling.tokens(pa.array([text]))[0]

    def test_covers_what_the_plain_rule_covers(self):
        rng = random.Random(2)
        for _ in range(200):
            doc = [rng.choice("abcd") for _ in range(rng.randrange(40))]
            item = [rng.choice("abcd") for _ in range(rng.randrange(1, 14))]
            got = tiling.tile(self.hashes(" ".join(doc)), self.hashes(" ".join(item)), 3)
            assert len(got) <= len(item) and all(doc[d : d + n] == item[i : i + n] for d, i, n in got)
            assert sum(t[2] for t in got) == brute.tiled(doc, item, 3)

    def test_moved_passages_count_whole(self, spark):
        item = [f"w{i}" for i in range(30)]
        moved = item[18:] + ["noise"] * 7 + item[:18]
        rows = [(1, " ".join(moved)), (2, " ".join(item[:20])), (3, " ".join(item).upper() + "."), (4, None), (5, ""), (None, " ".join(item))]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        items = spark.createDataFrame([(7, " ".join(item)), (8, None), (9, ""), (10, "w3 w4"), (None, "zz")], "item_id long, text string")
        got = {(r.doc_id, r.item_id) for r in tiling.contaminated(docs, items).collect()}
        assert got == {(1, 7), (3, 7), (None, 7), (1, 10), (2, 10), (3, 10), (None, 10)}
        assert {r.doc_id for r in tiling.keep_clean(docs, items).collect()} == {2, 4, 5}  # "w3 w4" is no leak
        short = spark.createDataFrame([(6, "W3, w4!"), (7, "w3 w4 w5")], "doc_id long, text string")
        assert {r.doc_id for r in tiling.keep_clean(short, items).collect()} == {7}

    @pytest.mark.parametrize("kind", ["int", "long", "string", "decimal(9,0)"])
    def test_rows_are_those_of_the_plain_rule(self, spark, kind):
        rng = random.Random(5)
        draw = lambda n: " ".join(rng.choice("abcdefg") for _ in range(n))
        items = [(k, draw(rng.randrange(3, 16))) for k in range(12)]
        parts = [" ".join(t.split()[a:b]) for _, t in items for a, b in ((0, 99), (2, 99), (6, 99), (0, 6))]
        rows = [(i, " zz ".join([draw(rng.randrange(9)), *rng.sample(parts, 3), draw(5)])) for i in range(150)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("item_id", F.col("item_id").cast(kind))
        got = tiling.contaminated(docs, benchmark)
        assert got.schema["item_id"].dataType == benchmark.schema["item_id"].dataType
        got = {(r.doc_id, int(r.item_id)): (r.covered, r.item_tokens, r.doc_tokens) for r in got.collect()}
        want = {}
        for i, d in rows:
            for k, t in items:
                covered = brute.tiled(d.split(), t.split(), 5)
                if covered >= 0.8 * len(t.split()):
                    want[i, k] = covered, len(t.split()), len(d.split())
        assert len(want) > 100 and got == want

    def test_a_document_of_very_many_items_takes_seconds(self, spark):
        rng = random.Random(6)
        items = [(k, " ".join(f"v{rng.randrange(5000)}" for _ in range(25))) for k in range(10_000)]
        docs = spark.createDataFrame([(1, " ".join(t for _, t in items))], "doc_id long, text string")
        began = time.monotonic()
        benchmark = spark.createDataFrame(items, "item_id long, text string")
        assert tiling.contaminated(docs, benchmark).count() == len(items) and time.monotonic() - began < 120

    def test_slices_of_the_benchmark_give_the_same_rows(self, spark, monkeypatch):
        docs, items = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "benchmark"))
        whole = sorted(map(tuple, tiling.contaminated(docs, items).collect()))
        monkeypatch.setattr(tiling, "SLICE_TOKENS", 900)
        assert whole and sorted(map(tuple, tiling.contaminated(docs, items).collect())) == whole
        empty = docs.limit(0)
        assert tiling.contaminated(empty, items).collect() == [] and tiling.contaminated(docs, items.limit(0)).collect() == []


class TestClassifier:
    def test_held_out_documents_are_told_apart(self, spark):
        folder = "/root/testdata/sf0.01"
        got = queries.QUERIES["op5_quality_classifier"](spark, folder)
        rows = got.where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
        assert len(rows) > 50 and np.mean([r.predicted == r.quality for r in rows]) > 0.97

    def test_nulls_empty_tables_and_repeated_rows(self, spark, docs):
        labels = spark.createDataFrame([(0, 1, "a"), (0, 0, "b"), (3, 1, None), (None, 1, "c"), (4, None, "d"), (9001, 0, "e")], "doc_id long, quality int, text string")
        model = quality_classifier.fit(docs, labels)
        out = quality_classifier.score(docs, model).collect()
        assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
        nothing = quality_classifier.fit(docs, labels.limit(0))
        assert {r.score for r in quality_classifier.score(docs, nothing).collect()} == {0.5}
        assert quality_classifier.score(docs.limit(0), model).collect() == []


@pytest.mark.parametrize("small", [3, 100_000])
def test_components_of_chains_stars_and_rings(spark, monkeypatch, small):
    monkeypatch.setattr(components, "SMALL", small)
    links = [(i * 7 % 60, (i + 1) * 7 % 60) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(201, 200), (200, 200)]
    got = {tuple(r) for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    ring = {i * 7 % 60 for i in range(41)}
    assert got == {(x, min(ring)) for x in ring} | {(x, 100) for x in range(100, 130)} | {(200, 200), (201, 200)}


def test_stages_keep_all_columns_and_take_empty_tables(spark, docs):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    stages = [quality_rules.keep_good, line_dedup.clean_texts, minhash.keep_one, lambda d: tiling.keep_clean(d, items)]
    for stage in stages:
        out = stage(docs)
        assert out.columns == docs.columns and 0 < out.count() <= docs.count()
        assert stage(docs.limit(0)).count() == 0


def test_pipeline_equals_the_plain_stages(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    good = {r[0] for r in brute.quality(rows) if r[7]}
    rows = [(i, t) for i, _, _, t in brute.lines([r for r in rows if r[0] in good])]
    one = {r[0] for r in brute.near(rows, 5) if r[3]}
    rows = [r for r in rows if r[0] in one]
    leaks = {i for i, _ in brute.leaks(rows, items)}
    want = sorted(brute.bpe([r for r in rows if r[0] not in leaks]))
    got = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())) == want
    assert got.where(F.size("token_ids") != F.col("n_tokens")).count() == 0
