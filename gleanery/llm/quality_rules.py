"""Quality rules: a table of thresholds compiled into one projection of ratios, with built-in functions only.

Every document gives one row, in whatever order. A null text is an empty text (no words, no lines with a word);
its ratios are 0 and the base rule on the number of words rejects it. Repeated rows are judged each on its own;
other columns of the input are not looked at, so their names can't clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# Frequent function words of four languages.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which "
    "der die und das von zu mit sich des auf für ist im dem nicht ein eine als auch es an er so dass "
    "le la les de des et un une du que est pour dans qui par pas au sur ne se ce il sont avec en "
    "el los las del y que se por con para su al lo como más o pero sus ya no"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= 100 * numerator / denominator <= high``; a zero denominator gives 0. None leaves a side open."""

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("word_length", "word_chars", "n_words", low=200, high=2000),
    Rule("symbols", "n_symbols", "n_words", high=10),
    Rule("stop_words", "n_stop_words", "n_words", low=2),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=50),
    Rule("line_length", "n_chars", "n_lines", low=1000),
    Rule("letters", "n_letters", "word_chars", low=60),
)
MIN_WORDS = 50
MAX_REPEATED = 50


def _repeat_words(words: Column, hashes: Column, ordered: Column) -> tuple[Column, Column, Column, Column]:
    """The steps to the number of words that lie in a 3-word window which the text has twice or more.

    Windows are hashed; only texts where two windows share a hash go on: there the windows are ordered by hash,
    and neighbours with one hash are compared by their words.
    """
    at = lambda i: F.slice(words, i + 1, 3)
    all_hashes = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    whole = F.slice(all_hashes, 1, F.greatest(F.size(words) - 2, F.lit(0)))
    pairs = F.when(
        F.size(F.array_distinct(hashes)) < F.size(hashes),
        F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )

    def same(x: Column, other: Column) -> Column:
        return (x["h"] == other["h"]) & (at(x["i"]) == at(other["i"]))

    found = F.filter(ordered, lambda x, i: same(x, F.get(ordered, i - 1)) | same(x, F.get(ordered, i + 1)))
    places = F.sort_array(F.transform(found, lambda x: x["i"]))
    return whole, pairs, places, F.lit(3)


def features(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Per document: ``doc_id``, ``n_words`` and the counts that the rules divide."""
    c = F.col
    df = docs.select(c(id).alias("doc_id"), F.coalesce(c(text), F.lit("")).alias("t"))
    df = df.select("doc_id", "t", F.array_remove(F.split("t", r"[\x20\x09-\x0D]+"), "").alias("w"))
    hashes, ordered, places, width = _repeat_words(c("w"), c("h"), c("o"))
    lines = F.filter(F.split("t", "\n"), lambda x: F.translate(x, SPACES, "") != "")
    df = df.withColumn("h", hashes).withColumn("o", ordered).withColumn("p", places).withColumn("l", lines)
    covered = F.aggregate(
        F.transform("p", lambda x, i: F.least(width, F.coalesce(F.get("p", i + 1) - x, width))),
        F.lit(0).cast("long"),
        lambda acc, x: acc + x,
    )
    dense = F.translate("t", SPACES, "")
    return df.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(dense).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("l").cast("long").alias("n_lines"),
        F.length("t").cast("long").alias("n_chars"),
        F.size(F.filter("w", lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.length(F.regexp_replace("t", r"[\x00-@\[-`{-\x7f]+", "")).cast("long").alias("n_letters"),
    )


def failed_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules that the row's counts break, in the order of the table."""
    checks = []
    for r in rules:
        ratio = F.when(F.col(r.denominator) > 0, 100 * F.col(r.numerator) / F.col(r.denominator)).otherwise(0.0)
        out = F.lit(False)
        if r.low is not None:
            out = out | (ratio < r.low)
        if r.high is not None:
            out = out | (ratio > r.high)
        checks.append(F.when(out, F.lit(r.name)))
    return F.array_compact(F.array(*checks))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``features`` with ``base_failed``, ``failed`` (names, comma-joined) and ``kept``."""
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    df = features(docs, text, id).withColumn("base_failed", base).withColumn("failed", F.array_join(failed_rules(rules), ","))
    return df.withColumn("kept", ~F.col("base_failed") & (F.col("failed") == ""))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns: the row travels in one struct beside the counts.

    The row numbers keep the filter above the counts; below them, every step would be worked out again for the filter.
    """
    row = F.struct(*[F.col(f"`{x}`") for x in docs.columns])
    whole = docs.select(row.alias("doc_id"), F.col(f"`{text}`").alias("text"))
    judged = quality_rules(whole, rules).select("doc_id", "kept", F.monotonically_increasing_id().alias("at"))
    return judged.where(F.col("kept") & (F.col("at") >= 0)).select("doc_id.*")
