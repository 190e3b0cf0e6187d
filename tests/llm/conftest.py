from __future__ import annotations

import pytest
from pyspark.sql import DataFrame, SparkSession

SMALL = "/root/testdata/sf0.001"


def edge_rows(rows: list[tuple]) -> list[tuple]:
    """Nulls, empty and very long texts, ties, repeated rows, and all kinds of blanks."""
    text = rows[3][1]
    long = " ".join(f"w{i % 977}x{i * i % 1013}" for i in range(60_000)) + "\n" + text
    return [
        (9001, None), (9002, ""), (9003, " \n\t\x0b\x0c\r "), (9004, "word"), (9005, "two words"), (None, text), (None, None),
        (9006, text), (9006, text), (9007, text + "\n"), (9008, text.upper()), (9009, long), (9010, "9" * 5000), (9011, long + " end"),
        (9012, "a@b.co,a@b.c_d@e.fg +1 (555) 010-9999 4111 1111 1111 1111 1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.004"),
        (9013, "<|endoftext|>a <|endoftext|>  b c \U0001f600 \x1c\x85"), (9014, ("same line here\n" * 40)),
    ]


@pytest.fixture(scope="session")
def corpus(spark: SparkSession) -> list[tuple]:
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    return rows + edge_rows(rows)


@pytest.fixture(scope="session")
def docs(spark: SparkSession, corpus: list[tuple]) -> DataFrame:
    """The rows with more columns, null in part, that are named as columns which operators make or use."""
    names = "block part kept keys text_key set_key n_words label row words found t w".split()
    rows = [(*r, *[None if (k + j) % 3 else str(k) for j in range(len(names))]) for k, r in enumerate(corpus)]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)).repartition(3)
