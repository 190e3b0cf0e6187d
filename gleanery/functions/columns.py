"""Column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHITESPACE = " \t\n\r\x0b\x0c\xa0\u2028\u2029\ufeff"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def moment(as_of: datetime | Column) -> Column:
    """``as_of`` as a column; a datetime becomes a zone-free literal."""
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp_ntz")


# ---- missing text ----------------------------------------------------------
def has_text(c: str | Column) -> Column:
    """Neither null nor the empty string."""
    return F.coalesce(col(c) != "", F.lit(False))


def text_or(c: str | Column, default: str | Column | None) -> Column:
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(col(c), F.lit("")), fallback)


def strip(c: str | Column) -> Column:
    return F.btrim(col(c), F.lit(_WHITESPACE))


def is_blank(c: str | Column) -> Column:
    """Null, empty or only white space."""
    return F.coalesce(strip(c) == "", F.lit(True))


# ---- word search -----------------------------------------------------------
# Over a named column a word list is one SQL expression: hundreds of words then
# cost one call to build instead of three each.
def sql_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def contains_any(c: str | Column, words: Iterable[str]) -> Column:
    words = tuple(words)
    if not words:
        return F.lit(False)
    if isinstance(c, str):
        return F.expr(" OR ".join(f"contains({c}, {sql_text(w)})" for w in words))
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])


def count_words(c: str, words: Iterable[str]) -> Column:
    """How many of ``words`` occur in the text at least once."""
    return F.expr(" + ".join(f"if(contains({c}, {sql_text(w)}), 1, 0)" for w in words) or "0")


def join_words(c: str, words: Iterable[str], sep: str = ", ") -> Column:
    """The words that occur, in list order, joined to one text."""
    found = "".join(f", if(contains({c}, {sql_text(w)}), {sql_text(w)}, NULL)" for w in words)
    return F.expr(f"concat_ws({sql_text(sep)}{found})")


def matching(values: str | Column, words: Iterable[str]) -> Column:
    """The lower-cased array values that contain any of ``words``."""
    words = tuple(words)
    lowered = F.transform(col(values), F.lower)
    return F.filter(lowered, lambda v: contains_any(v, words))


def has_any_topic(topics: str | Column, words: Iterable[str]) -> Column:
    """FLT-1: some topic contains some word; null and empty give false."""
    words = tuple(words)
    return F.coalesce(
        F.exists(col(topics), lambda t: contains_any(F.lower(t), words)), F.lit(False)
    )


# ---- numbers ---------------------------------------------------------------
def round_half_up(c: Column) -> Column:
    return F.floor(c + F.lit(0.5))


def round_1dp(c: Column) -> Column:
    """Half-up to one decimal, in double arithmetic."""
    return F.floor(c * F.lit(10.0) + F.lit(0.5)) / F.lit(10.0)


def clamp(c: Column, low: int, high: int) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def total(parts: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def points(condition: Column, value: int | Column) -> Column:
    """``value`` where the condition holds, else 0 (also when it is null)."""
    return F.when(condition, value).otherwise(0)


# ---- time ------------------------------------------------------------------
def parse_time(c: str | Column) -> Column:
    return F.try_to_timestamp(col(c))


def months_stale(pushed_at: str | Column, as_of: datetime | Column) -> Column:
    """ST-1: calendar month difference, never negative, null without a date."""
    then, now = col(pushed_at), moment(as_of)
    diff = (F.year(now) - F.year(then)) * 12 + F.month(now) - F.month(then)
    return F.when(then.isNotNull(), F.greatest(F.lit(0), diff))


def is_stale(pushed_at: str | Column, as_of: datetime | Column, threshold: int) -> Column:
    """FLT-8: strictly more months than the threshold; no date counts as active."""
    return F.coalesce(months_stale(pushed_at, as_of) > threshold, F.lit(False))


def two_years_before(as_of: datetime | Column) -> Column:
    now = moment(as_of)
    back = now - F.expr("INTERVAL 2 YEARS")
    leap_day = (F.month(now) == 2) & (F.dayofmonth(now) == 29)
    return F.when(leap_day, back + F.expr("INTERVAL 1 DAY")).otherwise(back)


def long_date(c: str | Column) -> Column:
    return F.date_format(col(c), "MMMM d, yyyy")


def long_date_time(c: str | Column) -> Column:
    return F.date_format(col(c), "MMMM d, yyyy 'at' HH:mm 'UTC'")


# ---- other -----------------------------------------------------------------
def owner_of(full_name: str | Column) -> Column:
    return F.split_part(col(full_name), F.lit("/"), F.lit(1))


def short_name_of(full_name: str | Column) -> Column:
    return F.split_part(col(full_name), F.lit("/"), F.lit(2))


def is_url(c: str | Column) -> Column:
    """Whether a browser would read the text as a URL: behind the authority any character may stand, as browsers
    encode it; Spark's parser is stricter there, so that part is replaced before the test."""
    whole = strip(c)
    start = F.regexp_extract(whole, r"^[^:/?#]*:(?://[^/?#\\]*)?", 0)
    rest = F.regexp_replace(F.substring(whole, F.length(start) + 1, F.length(whole)), "[^A-Za-z0-9/]", "_")
    return F.try_parse_url(F.concat(start, rest), F.lit("PROTOCOL")).isNotNull()


def utf8_text(binary: str | Column) -> Column:
    """Bytes as text; what is not UTF-8 becomes the replacement character."""
    return F.make_valid_utf8(col(binary).cast("string"))


def decode_base64(c: str | Column) -> Column:
    """The text behind base64, null if it is not base64."""
    return utf8_text(F.try_to_binary(F.regexp_replace(col(c), r"\s", ""), F.lit("base64")))


def _json_pair(c: str | Column) -> tuple[Column, Column]:
    """Spark's parser stops after the first value and accepts what follows it, so
    the text is read as the first of two elements, the second of them ours."""
    pair = F.try_parse_json(F.concat(F.lit("["), col(c), F.lit(',"$end"]')))
    ours = F.try_variant_get(pair, "$[1]", "string") == "$end"
    no_more = F.try_variant_get(pair, "$[2]", "variant").isNull()
    return pair, F.coalesce(ours & no_more, F.lit(False))


def is_json(c: str | Column) -> Column:
    """The whole text is one JSON value."""
    return _json_pair(c)[1]


def parsed_json(c: str | Column) -> Column:
    """The variant in a JSON text, null where the text is not one JSON value."""
    pair, whole = _json_pair(c)
    return F.when(whole, F.try_variant_get(pair, "$[0]", "variant"))


def json_array_text(c: str | Column) -> Column:
    return F.coalesce(F.to_json(col(c)), F.lit("[]"))
