"""Ignore rules and manual overrides."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.columns import col
from gleanery.functions.ranking import first_per_key
from gleanery.profiles import COMMON_IGNORE_PATTERNS

EXACT_REASON = "Exact match in ignore list"
# Case-insensitive, also beyond ASCII.
ANY_CASE = "(?iu)"
# Patterns that are kept in one row of the index, about.
PATTERNS_PER_BLOCK = 50
# Characters of the piece of text by which a pattern is found.
GRAM = 3


# ---- rule tables -----------------------------------------------------------
def rules_add(rules: DataFrame, additions: DataFrame) -> DataFrame:
    """SET-3: append the (kind, value) pairs that are not there yet."""
    fresh = (
        additions.select("pos", "kind", "value")
        .join(rules.select("kind", "value"), ["kind", "value"], "left_anti")
        .groupBy("kind", "value")
        .agg(F.min("pos").alias("pos"))
    )
    return rules.select("pos", "kind", "value").unionByName(fresh)


def rules_remove(rules: DataFrame, values: DataFrame) -> DataFrame:
    """SET-4: drop equal values, exact and pattern alike."""
    return rules.join(values.select("value"), "value", "left_anti").select("pos", "kind", "value")


def pattern_error(pattern: str | Column) -> Column:
    """Why a pattern cannot be used, or null: the regex engine that ``rlike`` runs on compiles it."""
    compiled = F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), F.concat(F.lit(ANY_CASE), col(pattern)))
    return F.when(col(pattern).isNull(), F.lit("missing pattern")).when(compiled.isNull(), F.lit("not a valid regular expression"))


def split_patterns(rules: DataFrame, column: str = "value") -> DataFrame:
    """VAL-6: mark each pattern as valid, with the reason where it is not.  Matching reads patterns by the same rule."""
    return rules.withColumn("error", pattern_error(column)).withColumn("valid", F.col("error").isNull())


# ---- matching --------------------------------------------------------------
_GAP, _DOT = "\x01", "\x02"
_GROUP = r"\((?:\?[:>]|\?<[A-Za-z][A-Za-z0-9]*>|\?[a-zA-Z-]+:)?"
_AGAIN = r"(?:[*?][+?]?|\{[^}]*\}[+?]?)"
# What a pattern asks for beside plain text becomes a gap, step by step. What stays is text that each match holds.
_TO_GAPS = (
    (r"\\\\", _GAP),  # a backslash itself; from here on each one begins an escape
    (r"\\([-/_ ,@#~:;\"'<>=!&%])", "$1"),
    (r"\\\.", _DOT),
    (r"\\(?:x\{[^}]*\}|x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|[pPN]\{[^}]*\}|k<[^>]*>|c.|0[0-7]{1,3}|[0-9]+|[^Q])", _GAP),
    (r"\[\^?\]?[^\[\]]*(?:\[[^\[\]]*\][^\[\]]*)*\]", _GAP),
    *[
        step
        for _ in range(3)  # groups inside groups
        for step in (
            (r"\(\?(?:<?[=!])[^()]*\)" + f"{_AGAIN}?", _GAP),
            (r"\(\?[a-zA-Z-]*\)", _GAP),
            (_GROUP + r"[^()]*\)" + _AGAIN, _GAP),
            (_GROUP + r"[^()]*\|[^()]*\)[+]{0,2}", _GAP),
            (_GROUP + r"([^()]*)\)(?:\+[+?]?)?", f"{_GAP}$1{_GAP}"),
        )
    ],
    (r"(?s)." + _AGAIN, _GAP),
    (r"(?s)(.)\+[+?]?", f"$1{_GAP}"),
    (r"[\^$.]", _GAP),
)
# The four letters beyond ASCII that a search without case takes for ASCII letters. Fixed values.
_FOLDED_FROM, _FOLDED_TO = "\u017f\u212a\u0130\u0131", "skii"


def folded(text: Column) -> Column:
    """Text in the case in which required pieces are looked up."""
    return F.lower(F.translate(text, _FOLDED_FROM, _FOLDED_TO))


def grams(text: Column) -> Column:
    """The different runs of ``GRAM`` characters, none in shorter texts."""
    n = F.length(text) - GRAM + 1
    return F.array_distinct(F.transform(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), lambda i: F.substr(text, i, F.lit(GRAM))))


def required_grams(pattern: str | Column) -> Column:
    """Runs of characters that every text found by a pattern holds, whatever its case; none where no such run is sure.

    Left out are alternatives at the top, quoting, comments, and what else is not read here.
    """
    text = col(pattern)
    for found, put in _TO_GAPS:
        text = F.regexp_replace(text, found, put)
    unread = col(pattern).rlike(r"\(\?[a-zA-Z]*x") | text.rlike(r"[()|\[\]\\{}*+?]")
    pieces = F.split(folded(text), rf"[^a-z0-9{_DOT} /_,@#~:;\"'<>=!&%-]+")
    runs = F.flatten(F.transform(pieces, lambda p: grams(F.translate(p, _DOT, "."))))
    return F.when(unread, F.array().cast("array<string>")).otherwise(F.array_distinct(runs))


class Matcher(NamedTuple):
    """A rule table made ready: exact values and an index of patterns, both as tables.

    ``index``: rows ``(key, patterns)`` with about ``PATTERNS_PER_BLOCK`` patterns each, in rule order. The key of a pattern is
    the required gram that the fewest patterns share. Patterns without one are dealt to ``loose`` blocks that every text meets.
    """

    exact: DataFrame
    index: DataFrame
    loose: int

    def found_in(self, repos: DataFrame, repo: str) -> DataFrame:
        """``(_found_repo, _pattern)``: the first pattern in rule order for each of the different ``repos`` that one matches.

        Texts meet the patterns whose key they hold, by an equi join; these are confirmed by the regex engine.
        """
        loose = F.transform(F.sequence(F.lit(0), F.lit(self.loose - 1)), _loose_key) if self.loose else F.array().cast("array<string>")
        texts = repos.select(F.col(repo).alias("_found_repo")).where("_found_repo IS NOT NULL").distinct()
        keyed = texts.select("_found_repo", F.explode(F.concat(grams(folded(F.col("_found_repo"))), loose)).alias("key"))
        holds = F.filter("patterns", lambda p: F.rlike(F.col("_found_repo"), F.concat(F.lit(ANY_CASE), p["value"])))
        first = keyed.join(self.index, "key").select("_found_repo", F.get(holds, F.lit(0)).alias("first")).where("first IS NOT NULL")
        return first.groupBy("_found_repo").agg(F.min("first")["value"].alias("_pattern"))


def _loose_key(block: Column) -> Column:
    return F.concat(F.lit(_GAP), block.cast("string"))


def matcher(rules: DataFrame) -> Matcher:
    """Make the rules ready once; reuse the result where they are matched twice.

    All steps are joins and groups over the rule table; only the number of patterns without a key reaches the driver.
    """
    exact = rules.filter(F.col("kind") == "exact").select(F.col("value").alias("_exact")).distinct()
    patterns = rules.filter(F.col("kind") == "pattern").groupBy("value").agg(F.min("pos").alias("pos"))
    usable = split_patterns(patterns).filter("valid").select("pos", "value", required_grams("value").alias("grams"))
    loose = -(-usable.where(F.size("grams") == 0).count() // PATTERNS_PER_BLOCK)

    one_each = usable.select("pos", "value", F.explode("grams").alias("key"))
    shared = one_each.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    rarest = one_each.join(shared, "key").groupBy("value", "pos").agg(F.min(F.struct("n", "key")).alias("rarest"))
    by_gram = rarest.select("pos", "value", F.col("rarest.key").alias("key"), F.ceil(F.col("rarest.n") / PATTERNS_PER_BLOCK).alias("blocks"))
    dealt = by_gram.select("pos", "value", "key", F.pmod(F.xxhash64("value"), "blocks").alias("block"))
    if loose:
        block = F.pmod(F.xxhash64("value"), F.lit(loose))
        dealt = dealt.unionByName(usable.where(F.size("grams") == 0).select("pos", "value", _loose_key(block).alias("key"), block.alias("block")))
    index = dealt.groupBy("key", "block").agg(F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("patterns"))
    return Matcher(exact, index.drop("block"), loose)


def match_rules(df: DataFrame, rules: DataFrame | Matcher, repo: str = "repo") -> DataFrame:
    """FLT-4 / JN-3: add ``rule_kind`` and ``rule_value``, null where no rule holds.

    An exact rule wins; among patterns the first in rule order.  Both are found by equi joins
    of any size.  Invalid patterns are skipped.
    """
    ready = rules if isinstance(rules, Matcher) else matcher(rules)
    found = df.join(ready.exact, F.col(repo) == F.col("_exact"), "left")
    found = found.join(ready.found_in(df, repo), F.col(repo) == F.col("_found_repo"), "left")
    is_exact = F.col("_exact").isNotNull()
    return found.select(
        *df.columns,
        F.when(is_exact, F.lit("exact"))
        .when(F.col("_pattern").isNotNull(), F.lit("pattern"))
        .alias("rule_kind"),
        F.when(is_exact, F.col("_exact")).otherwise(F.col("_pattern")).alias("rule_value"),
    )


def ignore_reasons(df: DataFrame, rules: DataFrame, repo: str = "repo") -> DataFrame:
    """The ignored rows with the reason."""
    return (
        match_rules(df, rules, repo)
        .filter(F.col("rule_kind").isNotNull())
        .withColumn(
            "ignore_reason",
            F.when(F.col("rule_kind") == "exact", F.lit(EXACT_REASON)).otherwise(
                F.concat(F.lit("Matched pattern: "), F.col("rule_value"))
            ),
        )
        .drop("rule_kind", "rule_value")
    )


def ignore_allowed(df: DataFrame, rules: DataFrame, repo: str = "repo") -> DataFrame:
    """The rows no rule matches."""
    return match_rules(df, rules, repo).filter(F.col("rule_kind").isNull()).drop("rule_kind", "rule_value")


def common_ignore_reasons(df: DataFrame, repo: str = "repo") -> DataFrame:
    """FLT-10: every common reason that applies, and whether one does."""
    name = col(repo)
    either = "|".join(f"(?:{p})" for p, _ in COMMON_IGNORE_PATTERNS)
    reasons = F.array_compact(
        F.array(*[F.when(name.rlike("(?i)" + p), F.lit(why)) for p, why in COMMON_IGNORE_PATTERNS])
    )
    matches = F.coalesce(name.rlike("(?i)" + either), F.lit(False))
    return df.withColumn("matches", matches).withColumn(
        "reasons", F.when(F.col("matches"), reasons).otherwise(F.array().cast("array<string>"))
    )


# ---- overrides -------------------------------------------------------------
OVERRIDE_FIELDS = ("name", "category", "tags_add", "tags_remove", "notes", "hidden")


def latest_overrides(overrides: DataFrame) -> DataFrame:
    """JN-2: one override per repository, the last one listed, as a struct."""
    return first_per_key(overrides, ["repo"], [F.desc("pos")]).select(
        F.col("repo").alias("_ov_repo"), F.struct(*OVERRIDE_FIELDS).alias("_ov")
    )


def overridden(columns: list[str], patch: str = "_ov") -> list[Column]:
    """PRJ-4 as a select list over ``columns`` and a patch struct.

    A null in the patch means "not given"; without a patch nothing changes.
    """
    add, remove = F.col(f"{patch}.tags_add"), F.col(f"{patch}.tags_remove")
    tags = F.when(F.size(add) > 0, F.array_distinct(F.concat("tags", add))).otherwise(F.col("tags"))
    tags = F.when(
        F.size(remove) > 0, F.filter(tags, lambda t: ~F.array_contains(remove, t))
    ).otherwise(tags)
    changed = {c: F.coalesce(F.col(f"{patch}.{c}"), F.col(c)) for c in ("name", "category", "notes", "hidden")}
    changed["tags"] = tags
    return [changed[c].alias(c) if c in changed else F.col(c) for c in columns]


def apply_overrides(items: DataFrame, overrides: DataFrame) -> DataFrame:
    """JN-2 + PRJ-4."""
    found = items.join(latest_overrides(overrides), F.col("repo") == F.col("_ov_repo"), "left")
    return found.select(*overridden(items.columns))


