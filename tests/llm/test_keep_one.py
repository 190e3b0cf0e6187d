"""Near-dedup as a stage leaves one row of each group, whatever its ids."""

from __future__ import annotations

from gleanery.llm import minhash


def test_one_row_of_each_group_stays(spark):
    text, other, alone = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near = text + " end"
    rows = [
        (7, text, "y"), (7, text, "x"), (7, text, "x"), (7, near, "z"), (9, text, "w"), (None, text, "v"),
        (None, other, "b"), (None, other, "a"), (None, other, "c"), (3, alone, "k"), (4, "", "e"), (4, "", "f"), (None, None, "g"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, note string").repartition(3)
    got = [tuple(r) for r in minhash.keep_one(docs).collect()]
    words = [r for r in got if r[1]]
    group = [r for r in words if r[0] == 7]
    assert len(words) == 3 and (None, other, "a") in words and (3, alone, "k") in words
    assert group in ([(7, text, "x")], [(7, near, "z")])
    assert sorted(r[2] for r in got if not r[1]) == ["e", "f", "g"]
