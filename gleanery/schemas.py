"""Fixed table schemas of the catalog."""

from __future__ import annotations

from pyspark.sql import types as T

_STR = T.StringType()
_STRS = T.ArrayType(T.StringType())
_BOOL = T.BooleanType()

ITEM = T.StructType(
    [
        T.StructField("id", _STR),
        T.StructField("name", _STR),
        T.StructField("repo", _STR),
        T.StructField("url", _STR),
        T.StructField("description", _STR),
        T.StructField("category", _STR),
        T.StructField("tags", _STRS),
        T.StructField("stars", T.LongType()),
        T.StructField("pushed_at", T.TimestampType()),
        T.StructField("archived", _BOOL),
        T.StructField("fork", _BOOL),
        T.StructField("license", _STR),
        T.StructField("topics", _STRS),
        T.StructField("score", T.IntegerType()),
        T.StructField("confidence", _STR),
        T.StructField("notes", _STR),
        T.StructField("hidden", _BOOL),
    ]
)

STALE_ITEM = T.StructType(
    ITEM.fields
    + [
        T.StructField("stale_detected_at", T.TimestampType()),
        T.StructField("months_stale", T.IntegerType()),
    ]
)

OVERRIDE = T.StructType(
    [
        T.StructField("pos", T.IntegerType()),
        T.StructField("repo", _STR),
        T.StructField("name", _STR),
        T.StructField("category", _STR),
        T.StructField("tags_add", _STRS),
        T.StructField("tags_remove", _STRS),
        T.StructField("notes", _STR),
        T.StructField("hidden", _BOOL),
    ]
)

RULE_FILE = T.StructType(
    [T.StructField("repos", _STRS), T.StructField("patterns", _STRS)]
)

RULE = T.StructType(
    [
        T.StructField("pos", T.IntegerType()),
        T.StructField("kind", _STR),
        T.StructField("value", _STR),
    ]
)

SEARCH_SPEC = T.StructType(
    [
        T.StructField("query_pos", T.IntegerType()),
        T.StructField("query", _STR),
        T.StructField("max_results", T.IntegerType()),
        T.StructField("min_stars", T.IntegerType()),
    ]
)

_LICENSE = T.StructType([T.StructField("key", _STR)])
_OWNER = T.StructType([T.StructField("login", _STR)])

HIT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", _STR),
        T.StructField("full_name", _STR),
        T.StructField("html_url", _STR),
        T.StructField("description", _STR),
        T.StructField("stargazers_count", T.LongType()),
        T.StructField("pushed_at", T.TimestampType()),
        T.StructField("archived", _BOOL),
        T.StructField("fork", _BOOL),
        T.StructField("license", _LICENSE),
        T.StructField("owner", _OWNER),
    ]
)

# One landed page of search results.
PAGE = T.StructType(
    [
        T.StructField("query_pos", T.IntegerType()),
        T.StructField("page", T.IntegerType()),
        T.StructField("total_count", T.LongType()),
        T.StructField("items", T.ArrayType(HIT)),
    ]
)

DETAIL = T.StructType(
    [T.StructField("full_name", _STR), T.StructField("topics", _STRS)]
)

REPOSITORY = T.StructType(
    [
        T.StructField("id", _STR),
        T.StructField("name", _STR),
        T.StructField("full_name", _STR),
        T.StructField("html_url", _STR),
        T.StructField("description", _STR),
        T.StructField("stargazers_count", T.LongType()),
        T.StructField("pushed_at", T.TimestampType()),
        T.StructField("archived", _BOOL),
        T.StructField("fork", _BOOL),
        T.StructField("license", _LICENSE),
        T.StructField("topics", _STRS),
        T.StructField("owner", _OWNER),
    ]
)

# A landed README response and a landed directory listing.
README = T.StructType(
    [T.StructField("full_name", _STR), T.StructField("content", _STR)]
)

LISTING = T.StructType(
    [
        T.StructField("full_name", _STR),
        T.StructField("path", _STR),
        T.StructField(
            "entries",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("name", _STR),
                        T.StructField("path", _STR),
                        T.StructField("type", _STR),
                    ]
                )
            ),
        ),
    ]
)

ITEM_COLUMNS = ITEM.fieldNames()
