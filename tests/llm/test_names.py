"""Stage forms keep columns whose names the operators use themselves."""

from __future__ import annotations

import pytest

from gleanery.llm import line_dedup, minhash, quality_rules, tiling
from gleanery.llm.names import unused

CLASHING = "_text_key _found _ _id _KEY _n _row kept label doc_id_ n_chars block".split()


def test_unused_names_differ_in_more_than_case():
    assert unused(["_ID", "_id_", "x"], "_id", "_id", "y") == ["_id__", "_id___", "y"]


@pytest.mark.parametrize("stage", ["rules", "lines", "near", "leaks"])
def test_clashing_columns_come_through(spark, stage):
    words = " ".join(f"The word{i} of" for i in range(40))
    rows = [(1, f"{words}.\nand more\nown", *[f"{c}1" for c in CLASHING]), (1, f"{words}.\nand more\nown", *[f"{c}2" for c in CLASHING])]
    rows += [(k, f"and that is other{k} " * 30, *[None] * len(CLASHING)) for k in range(2, 15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHING))
    benchmark = spark.createDataFrame([(7, " ".join(f"and that is other{k}" for k in [5] * 9))], "item_id long, text string")
    run = {
        "rules": quality_rules.keep_good, "lines": lambda d: line_dedup.clean_texts(d, length="none"), "near": minhash.keep_one,
        "leaks": lambda d: tiling.keep_clean(d, benchmark),
    }[stage]
    out = run(docs)
    assert out.columns == docs.columns
    whole = {r[0]: r for r in map(tuple, docs.collect())} | {1: None}
    for r in map(tuple, out.collect()):
        assert r[0] == 1 or stage == "lines" or r == whole[r[0]]
    ones = sorted(tuple(r)[2:] for r in out.where("doc_id = 1").collect())
    given = [tuple(f"{c}{k}" for c in CLASHING) for k in (1, 2)]
    assert ones == given[:1] if stage == "near" else ones == given or stage == "rules"
    assert out.where("doc_id = 5").count() == (0 if stage == "leaks" else 1) or stage in ("rules", "near")
