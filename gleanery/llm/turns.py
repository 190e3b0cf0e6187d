"""Turns of conversations as every operator on conversations reads them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits of a SHA-256 of role and text; the role's length in front keeps the border between them."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole, 256), 1, 32))


def turns_of(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, digest, role, text)``, null roles and texts as empty ones.

    A conversation's order is turn (null first), then ``digest``: equal turn numbers have one order on every run.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.select("conv_id", "turn", turn_digest(role, text).alias("digest"), role.alias("role"), text.alias("text"))
