"""Readers: every source becomes a typed DataFrame; nothing is inferred."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery import schemas as S
from gleanery.functions.columns import decode_base64, is_json, parsed_json, utf8_text


def _read(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str, missing_ok: bool
) -> DataFrame:
    try:
        df = spark.read.schema(schema).format(fmt).load(path)
        df.schema  # noqa: B018 - the path is checked here, not at the first action
        return df
    except AnalysisException as problem:
        if missing_ok and problem.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_items(spark: SparkSession, path: str, *, fmt: str = "parquet", missing_ok: bool = False) -> DataFrame:
    """SRC-1."""
    return _read(spark, path, S.ITEM, fmt, missing_ok)


def read_overrides(spark: SparkSession, path: str, *, fmt: str = "json", missing_ok: bool = False) -> DataFrame:
    """SRC-2: one override per line with its position in the list."""
    return _read(spark, path, S.OVERRIDE, fmt, missing_ok)


def read_rules(spark: SparkSession, path: str, *, missing_ok: bool = False) -> DataFrame:
    """SRC-3: ``{"repos": [...], "patterns": [...]}`` to the long rule table."""
    return rules_from_files(_read(spark, path, S.RULE_FILE, "json", missing_ok))


def rules_from_files(files: DataFrame) -> DataFrame:
    """SRC-3, the parsing: rows of ``repos`` and ``patterns`` lists to the long rule table."""

    def entries(column: str, kind: str) -> DataFrame:
        return files.select(F.posexplode(column).alias("pos", "value")).select(
            "pos", F.lit(kind).alias("kind"), "value"
        )

    return entries("repos", "exact").unionByName(entries("patterns", "pattern"))


def read_search_specs(spark: SparkSession, path: str) -> DataFrame:
    """SRC-4: ``[{"query": …, "maxResults": …, "minStars": …}, …]`` in one file."""
    entry = T.StructType(
        [
            T.StructField("query", T.StringType()),
            T.StructField("maxResults", T.IntegerType()),
            T.StructField("minStars", T.IntegerType()),
        ]
    )
    text = spark.read.text(path, wholetext=True)
    return text.select(
        F.posexplode(F.from_json("value", T.ArrayType(entry))).alias("query_pos", "s")
    ).select(
        "query_pos", "s.query", F.col("s.maxResults").alias("max_results"), F.col("s.minStars").alias("min_stars")
    )


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """SRC-5: landed result pages, one per line, to one row per hit."""
    return hits_from_pages(spark.read.schema(S.PAGE).json(path))


def hits_from_pages(pages: DataFrame) -> DataFrame:
    """SRC-5, the parsing."""
    return pages.select("query_pos", "page", F.posexplode("items").alias("hit_pos", "h")).select(
        "query_pos", "page", "hit_pos", "h.*"
    )


def read_details(spark: SparkSession, path: str) -> DataFrame:
    """SRC-6."""
    return spark.read.schema(S.DETAIL).json(path)


def read_readmes(spark: SparkSession, path: str) -> DataFrame:
    """SRC-7: base64 content to text; unreadable content is null."""
    return text_from_base64(spark.read.schema(S.README).json(path))


def text_from_base64(readmes: DataFrame) -> DataFrame:
    """SRC-7, the parsing."""
    return readmes.select("full_name", decode_base64("content").alias("text"))


def read_contents(spark: SparkSession, path: str) -> DataFrame:
    """SRC-8: landed directory listings to one row per entry."""
    return entries_from_listings(spark.read.schema(S.LISTING).json(path))


def entries_from_listings(listings: DataFrame) -> DataFrame:
    """SRC-8, the parsing."""
    entry = listings.select("full_name", F.explode("entries").alias("e"))
    return entry.select("full_name", "e.path", "e.name", "e.type")


def read_stale(spark: SparkSession, path: str, *, missing_ok: bool = True) -> DataFrame:
    """SRC-9: the stale state; order it with ``stale_order`` for output only."""
    return _read(spark, path, S.STALE_ITEM, "parquet", missing_ok)


def read_cache_entries(spark: SparkSession, path: str) -> DataFrame:
    """SRC-10: cache files with size and timestamp; broken JSON stays as invalid."""
    return entries_from_files(spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path))


def entries_from_files(files: DataFrame) -> DataFrame:
    """SRC-10, the parsing: ``path``, ``length`` and ``content`` of cache files to cache entries."""
    files = files.select("path", "length", utf8_text("content").alias("payload")).withColumn("_v", parsed_json("payload"))
    return files.select(
        F.regexp_extract("path", r"([^/]+)\.json$", 1).alias("key"),
        "path",
        "length",
        F.try_variant_get("_v", "$.timestamp", "bigint").alias("ts_ms"),
        "payload",
        is_json("payload").alias("valid"),
    )


def read_pages(spark: SparkSession, path: str, *, fmt: str = "parquet") -> DataFrame:
    """SRC-11: page_id and html; with ``fmt="html"`` one page per file."""
    if fmt == "html":
        return spark.read.text(path, wholetext=True).select(
            F.input_file_name().alias("page_id"), F.col("value").alias("html")
        )
    return spark.read.format(fmt).load(path)
