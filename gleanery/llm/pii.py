"""Personal data: regular expressions propose spans, checksums confirm them, words nearby adjust the score.

Built-in functions only. Every document gives one row; a null text is an empty text and has no spans. Matches of
one kind are leftmost and never overlap; a match that fails its check is dropped and not tried again shorter.
Repeated rows are searched each on its own; other columns are not looked at, so their names can't clash.

The patterns are written so that no text makes them slow: quantifiers never give back where giving back can't help,
and a pattern starts only where a run of its characters starts (or where the last match ended).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEAR = 40  # code points before a span in which context words count
THRESHOLD = 0.5


@dataclass(frozen=True)
class Kind:
    """``base`` kinds keep every confirmed span; the others need a score of ``THRESHOLD``."""

    name: str
    pattern: str
    needs: str  # only texts that match this are searched
    score: float
    context: str
    base: bool = True


KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "@", 0.9, "mail|contact|write to"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.6, r"\bip\b|address|host|server|login"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "", 0.8, "card|visa|master|credit|payment|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.6, "phone|tel|call|mobile|fax|whatsapp"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
         "", 0.8, "iban|account|bank|konto|compte|cuenta", base=False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 0.2, r"\bssn\b|social security", base=False),
)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    turned = F.reverse(digits)

    def part(i: Column) -> Column:
        d = F.substring(turned, i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(F.transform(places, part), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an IBAN, without blanks, leaves 1: its first four characters go to the end, letters count 10 to 35."""
    turned = F.concat(F.substring(code, 5, 1000), F.substring(code, 1, 4))

    def step(acc: Column, i: Column) -> Column:
        a = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(a < 65, (acc * 10 + a - 48) % 97).otherwise((acc * 100 + a - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def confirmed(kind: str, m: Column) -> Column:
    if kind == "ip":
        small = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return m.rlike(rf"^(?:{small}\.){{3}}{small}$") | m.rlike(rf"^(?:(?:{small}|0+)\.){{3}}(?:{small}|0+)$")
    d = _digits(m)
    if kind == "card":
        return F.length(d).between(16, 19) & luhn(d)
    if kind == "phone":
        return F.length(d).between(8, 15)
    if kind == "iban":
        return mod97(F.translate(m, " ", ""))
    if kind == "ssn":
        return ~m.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _cumulated(matches: Column, gaps: Column) -> Column:
    """For each match, the place where the text after it begins: sums of the lengths so far, by adding to each sum the one
    1, 2, 4, ... places before, so that n matches take about n log n steps."""
    lengths = F.transform(matches, lambda x, i: F.length(x) + F.length(F.get(gaps, i)))
    steps = F.filter(F.array(*[F.lit(1 << k) for k in range(31)]), lambda k: k < F.size(matches))

    def added(sums: Column, k: Column) -> Column:
        return F.transform(sums, lambda x, i: x + F.when(i < k, 0).otherwise(F.get(sums, i - k)))

    return F.when(F.size(matches) > 0, F.aggregate(steps, lengths, added)).otherwise(F.array().cast("array<int>"))


def _spans(kind: Kind, matches: Column, gaps: Column, after: Column) -> Column:
    def span(x: Column, i: Column) -> Column:
        end = F.get(after, i)
        start = end - F.length(x)
        near = F.lower(F.right(F.get(gaps, i), F.lit(NEAR))).rlike(kind.context)
        score = F.least(F.lit(1.0), F.lit(kind.score) + F.when(near, 0.35).otherwise(0.0))
        good = confirmed(kind.name, x) if kind.base else confirmed(kind.name, x) & (score >= THRESHOLD)
        return F.when(
            good, F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), end.alias("end"), score.alias("score"))
        )

    none = F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>")
    return F.when(F.size(matches) > 0, F.array_compact(F.transform(matches, span))).otherwise(none)


def find_pii(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Per document: ``doc_id`` and ``found``, an array of (kind, start, end, score) by kind, then start.

    Places are code points, the end exclusive. Text between matches gives the places, so a text with many matches
    is not scanned again for each.
    """
    df = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    none = F.array().cast("array<string>")
    step = {}
    for k in KINDS:
        all_of = F.regexp_extract_all("t", F.lit(k.pattern), F.lit(0))
        step[f"m_{k.name}"] = F.when(F.contains("t", F.lit(k.needs)), all_of).otherwise(none) if k.needs else all_of
    df = df.select("*", *[c.alias(n) for n, c in step.items()])
    step = {f"g_{k.name}": F.when(F.size(f"m_{k.name}") > 0, F.split("t", k.pattern)).otherwise(none) for k in KINDS}
    df = df.select("doc_id", *[f"m_{k.name}" for k in KINDS], *[c.alias(n) for n, c in step.items()])
    df = df.withColumns({f"a_{k.name}": _cumulated(F.col(f"m_{k.name}"), F.col(f"g_{k.name}")) for k in KINDS})
    spans = [_spans(k, F.col(f"m_{k.name}"), F.col(f"g_{k.name}"), F.col(f"a_{k.name}")) for k in KINDS]
    return df.select("doc_id", F.concat(*spans).alias("found"))


def digest(found: DataFrame) -> DataFrame:
    """The spans of ``find_pii`` as counts and strings."""
    base = [k.name for k in KINDS if k.base]
    as_text = lambda xs: F.array_join(
        F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )
    count = lambda name: F.size(F.filter("found", lambda x: x["kind"] == name)).cast("long")
    return found.select(
        "doc_id",
        *[count(name).alias(f"n_{name}") for name in base],
        F.sha2(as_text(F.filter("found", lambda x: x["kind"].isin(*base))), 256).alias("base_sha256"),
        as_text(F.col("found")).alias("spans"),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["score"])), F.lit(0.0)).alias("top_score"),
    )
