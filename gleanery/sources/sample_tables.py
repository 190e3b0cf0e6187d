"""The catalog's logical tables over the generated order/event/document tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions import html
from gleanery.functions.columns import is_json
from gleanery.schemas import ITEM_COLUMNS


# Given schemas spare a footer-reading job per table.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def reference_dates(spark: SparkSession, folder: str, months: int) -> tuple[datetime, datetime]:
    """The last order date and the date ``months`` before it: two scalars."""
    last = F.max("o_orderdate")
    return tuple(
        table(spark, folder, "orders").agg(last, last - F.expr(f"INTERVAL {months} MONTHS")).first()
    )


# ---- customers with their orders as a catalog ------------------------------
def catalog(spark: SparkSession, folder: str, as_of: datetime) -> DataFrame:
    """Customers with an order up to ``as_of``: stars are orders, the last order
    is the last push, the segment gives owner and category."""
    activity = (
        table(spark, folder, "orders")
        .filter(F.col("o_orderdate") <= F.lit(as_of).cast("timestamp_ntz"))
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("stars"), F.max("o_orderdate").alias("pushed_at"))
    )
    return customer_items(
        table(spark, folder, "customer").join(activity, F.col("c_custkey") == F.col("o_custkey")),
        table(spark, folder, "nation"),
    ).select(*ITEM_COLUMNS)


def customer_items(customers: DataFrame, nations: DataFrame) -> DataFrame:
    repo = F.concat("c_mktsegment", F.lit("/"), "c_name")
    labels = F.array(F.lower("c_mktsegment"), F.lower("n_name"))
    score = F.greatest(F.lit(0), F.least(F.lit(100), F.floor(F.col("c_acctbal") / 100))).cast("int")
    balance = F.col("c_acctbal")
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "*",
        repo.alias("id"),
        F.col("c_name").alias("name"),
        repo.alias("repo"),
        F.when(balance < -900, F.col("c_name"))
        .otherwise(F.concat(F.lit("https://x.example/"), F.col("c_custkey")))
        .alias("url"),
        F.when(balance >= 500, F.concat(F.lit("Account in "), "n_name", F.lit(". Segment "), F.lower("c_mktsegment")))
        .when(balance >= 0, F.lit(""))
        .alias("description"),
        _segment_category().alias("category"),
        labels.alias("tags"),
        (balance < 0).alias("archived"),
        (F.col("n_regionkey") == 2).alias("fork"),
        F.when(F.col("n_regionkey") > 1, F.lit("mit")).when(F.col("n_regionkey") == 1, F.lit("")).alias("license"),
        labels.alias("topics"),
        score.alias("score"),
        F.when(score >= 75, "high").when(score >= 50, "medium").otherwise("low").alias("confidence"),
        F.when(balance > 9000, F.concat(F.lit("Top account of "), "n_name")).alias("notes"),
        (balance > 9500).alias("hidden"),
    )


def _segment_category() -> Column:
    segment = F.col("c_mktsegment")
    return (
        F.when(segment == "AUTOMOBILE", "Official")
        .when(segment == "BUILDING", "Theme")
        .when(segment == "FURNITURE", "Tool")
        .when(segment == "MACHINERY", "Starter")
        .otherwise(segment)
    )


CUSTOMER_ITEMS_SQL = """
SELECT c_custkey, c_acctbal,
       c_mktsegment || '/' || c_name AS id, c_name AS name, c_mktsegment || '/' || c_name AS repo,
       CASE WHEN c_acctbal < -900 THEN c_name ELSE 'https://x.example/' || c_custkey END AS url,
       CASE WHEN c_acctbal >= 500 THEN 'Account in ' || n_name || '. Segment ' || lower(c_mktsegment)
            WHEN c_acctbal >= 0 THEN '' END AS description,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Official' WHEN 'BUILDING' THEN 'Theme'
            WHEN 'FURNITURE' THEN 'Tool' WHEN 'MACHINERY' THEN 'Starter' ELSE c_mktsegment END AS category,
       [lower(c_mktsegment), lower(n_name)] AS tags,
       c_acctbal < 0 AS archived, n_regionkey = 2 AS fork,
       CASE WHEN n_regionkey > 1 THEN 'mit' WHEN n_regionkey = 1 THEN '' END AS license,
       [lower(c_mktsegment), lower(n_name)] AS topics,
       CAST(greatest(0, least(100, floor(c_acctbal / 100))) AS INTEGER) AS score,
       CASE WHEN greatest(0, least(100, floor(c_acctbal / 100))) >= 75 THEN 'high'
            WHEN greatest(0, least(100, floor(c_acctbal / 100))) >= 50 THEN 'medium' ELSE 'low' END AS confidence,
       CASE WHEN c_acctbal > 9000 THEN 'Top account of ' || n_name END AS notes,
       c_acctbal > 9500 AS hidden
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""


def catalog_sql(months_before: int) -> str:
    """``catalog`` as a query; needs the CTE ``dates`` with column ``a``."""
    return f"""
SELECT i.*, o.stars, o.pushed_at FROM ({CUSTOMER_ITEMS_SQL}) i
JOIN (SELECT o_custkey, count(*) AS stars, max(o_orderdate) AS pushed_at FROM orders, dates
      WHERE o_orderdate <= a - INTERVAL {months_before} MONTH GROUP BY o_custkey) o ON o_custkey = c_custkey"""


ASOF_SQL = "dates AS (SELECT max(o_orderdate) AS a FROM orders)"


def raw_items(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as items with real violations, for the quality checks."""
    items = customer_items(table(spark, folder, "customer"), table(spark, folder, "nation"))
    return (
        items.withColumn("stars", F.floor(F.col("c_acctbal")).cast("long"))
        .withColumn("score", F.floor(F.col("c_acctbal") / 90).cast("int"))
        .withColumn("confidence", F.when(F.col("hidden"), F.lit("sure")).otherwise(F.col("confidence")))
        .withColumn("pushed_at", F.when(F.col("fork"), F.lit("soon")).otherwise(F.lit("2024-01-31T10:00:00Z")))
    )


RAW_ITEMS_SQL = f"""
SELECT * REPLACE (CAST(floor(c_acctbal / 90) AS INTEGER) AS score,
                  CASE WHEN hidden THEN 'sure' ELSE confidence END AS confidence),
       CAST(floor(c_acctbal) AS BIGINT) AS stars,
       CASE WHEN fork THEN 'soon' ELSE '2024-01-31T10:00:00Z' END AS pushed_at
FROM ({CUSTOMER_ITEMS_SQL})"""


# ---- rules and overrides from the customers --------------------------------
RULE_PATTERNS = ("^machinery/.*7$", "[oops", r"#0000000[12]\d", "household/.*3$")


def rules(spark: SparkSession, folder: str) -> DataFrame:
    """Exact rules for the accounts with little money, and a few patterns, one broken."""
    exact = (
        table(spark, folder, "customer")
        .filter(F.col("c_acctbal").between(0, 100))
        .select(
            F.col("c_custkey").cast("int").alias("pos"),
            F.lit("exact").alias("kind"),
            F.concat("c_mktsegment", F.lit("/"), "c_name").alias("value"),
        )
    )
    patterns = spark.createDataFrame(
        [(i, "pattern", p) for i, p in enumerate(RULE_PATTERNS)], "pos int, kind string, value string"
    )
    return exact.unionByName(patterns)


RULE_MATCH_SQL = r"""
CASE WHEN {r} IN (SELECT c_mktsegment || '/' || c_name FROM customer WHERE c_acctbal BETWEEN 0 AND 100)
          THEN 'Exact match in ignore list'
     WHEN regexp_matches({r}, '(?i)^machinery/.*7$') THEN 'Matched pattern: ^machinery/.*7$'
     WHEN regexp_matches({r}, '(?i)#0000000[12]\d') THEN 'Matched pattern: #0000000[12]\d'
     WHEN regexp_matches({r}, '(?i)household/.*3$') THEN 'Matched pattern: household/.*3$' END"""


def overrides(spark: SparkSession, folder: str) -> DataFrame:
    """Overrides for the accounts with much money; the richest have two."""
    base = customer_items(table(spark, folder, "customer"), table(spark, folder, "nation"))
    none = F.lit(None)
    first = base.filter("c_acctbal > 8000").select(
        F.col("c_custkey").cast("int").alias("pos"),
        "repo",
        F.concat(F.lit("Premier "), "c_name").alias("name"),
        F.when(F.col("c_nationkey") < 5, F.lit("Official")).alias("category"),
        F.array(F.lit("premier"), F.lower("c_mktsegment")).alias("tags_add"),
        F.when(F.col("c_nationkey") > 20, F.array(F.lower("n_name"))).alias("tags_remove"),
        F.when(F.col("c_nationkey") == 7, F.lit("Checked by hand")).alias("notes"),
        F.when(F.col("c_acctbal") < 8200, F.lit(True)).alias("hidden"),
    )
    second = base.filter("c_acctbal > 9000").select(
        (F.col("c_custkey") + 1_000_000_000).cast("int").alias("pos"),
        "repo",
        F.concat(F.lit("Elite "), "c_name").alias("name"),
        none.cast("string").alias("category"),
        none.cast("array<string>").alias("tags_add"),
        none.cast("array<string>").alias("tags_remove"),
        none.cast("string").alias("notes"),
        F.when(F.col("c_acctbal") > 9900, F.lit(True)).when(F.col("c_acctbal") > 9500, F.lit(False)).alias("hidden"),
    )
    return first.unionByName(second)


OVERRIDDEN_SQL = """
SELECT * REPLACE (
  CASE WHEN c_acctbal > 9000 THEN 'Elite ' || name WHEN c_acctbal > 8000 THEN 'Premier ' || name ELSE name END AS name,
  CASE WHEN c_acctbal > 8000 AND c_acctbal <= 9000 AND n < 5 THEN 'Official' ELSE category END AS category,
  CASE WHEN c_acctbal > 8000 AND c_acctbal <= 9000 AND n > 20 THEN [tags[1], 'premier']
       WHEN c_acctbal > 8000 AND c_acctbal <= 9000 THEN [tags[1], tags[2], 'premier'] ELSE tags END AS tags,
  CASE WHEN c_acctbal > 8000 AND c_acctbal <= 9000 AND n = 7 THEN 'Checked by hand' ELSE notes END AS notes,
  CASE WHEN c_acctbal > 9900 THEN true WHEN c_acctbal > 9500 THEN false
       WHEN c_acctbal > 8000 AND c_acctbal < 8200 THEN true ELSE hidden END AS hidden)
FROM (SELECT t.*, c.c_nationkey AS n FROM ({items}) t JOIN customer c USING (c_custkey))"""


# ---- events as search hits -------------------------------------------------
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def hits(spark: SparkSession, folder: str) -> DataFrame:
    """One hit per event: the type is the query, the day the page, the user the repository."""
    kind = F.col("event_type")
    query = F.array_position(F.array(*[F.lit(t) for t in EVENT_TYPES]), kind) - 1
    k = F.get_json_object("props", "$.k").try_cast("int")
    user = F.col("user_id").cast("string")
    return table(spark, folder, "events").select(
        query.cast("int").alias("query_pos"),
        (F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) + 1).alias("page"),
        F.col("event_id").alias("hit_pos"),
        F.col("user_id").alias("id"),
        F.concat(F.lit("user-"), user).alias("name"),
        F.concat(F.lit("u/user-"), user).alias("full_name"),
        F.concat(F.lit("https://x.example/"), user).alias("html_url"),
        F.concat(F.lit("Seen in "), kind).alias("description"),
        F.floor("value").cast("long").alias("stargazers_count"),
        F.col("ts").alias("pushed_at"),
        (k < 5).alias("archived"),
        (k > 95).alias("fork"),
        F.struct(kind.alias("key")).alias("license"),
        F.struct(F.lit("u").alias("login")).alias("owner"),
    )


def search_specs(spark: SparkSession, folder: str) -> DataFrame:
    rows = [(i, t, 60 + 10 * i, 5) for i, t in enumerate(EVENT_TYPES)]
    return spark.createDataFrame(rows, "query_pos int, query string, max_results int, min_stars int")


def details(spark: SparkSession, folder: str) -> DataFrame:
    """Topics of the users that are customers too."""
    return table(spark, folder, "customer").select(
        F.concat(F.lit("u/user-"), F.col("c_custkey").cast("string")).alias("full_name"),
        F.array(F.lower("c_mktsegment")).alias("topics"),
    )


HITS_SQL = """
SELECT CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2
            WHEN 'signup' THEN 3 WHEN 'view' THEN 4 END AS query_pos,
       date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS page, event_id AS hit_pos, user_id,
       'u/user-' || user_id AS full_name, CAST(floor(value) AS BIGINT) AS stars, ts, event_type,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events"""


# ---- parts as items with duplicates ----------------------------------------
def dup_items(spark: SparkSession, folder: str) -> DataFrame:
    """Few names and few brand/type pairs: many rows per repository and per URL."""
    size = F.col("p_size")
    score = F.least(F.lit(100), F.floor(F.col("p_retailprice") / 20)).cast("int")
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.concat(F.lit("Part "), F.col("p_partkey")).alias("name"),
        F.upper("p_name").alias("repo"),
        F.concat("p_brand", F.lit("/"), "p_type").alias("url"),
        F.when(size > 10, F.concat("p_type", F.lit(" "), "p_brand")).alias("description"),
        F.lit("Theme").alias("category"),
        F.array("p_brand", "p_type").alias("tags"),
        size.cast("long").alias("stars"),
        (F.lit(datetime(2000, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(days=F.col("p_partkey").cast("int")))
        .alias("pushed_at"),
        F.lit(False).alias("archived"),
        (size == 1).alias("fork"),
        F.when(size > 40, F.lit(None)).when(size > 20, F.lit("")).otherwise(F.col("p_type")).alias("license"),
        F.array("p_type", "p_name").alias("topics"),
        score.alias("score"),
        F.when(size > 25, F.lit("high")).otherwise(F.lit("low")).alias("confidence"),
        F.when(size > 48, F.concat(F.lit("n"), F.col("p_partkey"))).alias("notes"),
        F.lit(False).alias("hidden"),
    )


DUP_ITEMS_SQL = """
SELECT CAST(p_partkey AS VARCHAR) AS id, 'Part ' || p_partkey AS name, upper(p_name) AS repo,
       p_brand || '/' || p_type AS url, CASE WHEN p_size > 10 THEN p_type || ' ' || p_brand END AS description,
       'Theme' AS category, [p_brand, p_type] AS tags, CAST(p_size AS BIGINT) AS stars,
       TIMESTAMP '2000-01-01' + to_days(CAST(p_partkey AS INTEGER)) AS pushed_at, p_size = 1 AS fork,
       CASE WHEN p_size > 40 THEN NULL WHEN p_size > 20 THEN '' ELSE p_type END AS license,
       [p_type, p_name] AS topics, CAST(least(100, floor(p_retailprice / 20)) AS INTEGER) AS score,
       CASE WHEN p_size > 25 THEN 'high' ELSE 'low' END AS confidence,
       CASE WHEN p_size > 48 THEN 'n' || p_partkey END AS notes
FROM part"""


# ---- documents as repositories to score ------------------------------------
def document_repos(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("n_chars")
    return table(spark, folder, "documents").select(
        "doc_id",
        F.concat("source", F.lit("/doc-"), F.col("doc_id")).alias("full_name"),
        F.concat("source", F.lit("-app-"), "lang").alias("name"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("description"),
        (n % 50).alias("stargazers_count"),
        (F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz") - F.make_dt_interval(days=(n % 1500).cast("int")))
        .alias("pushed_at"),
        (F.col("source") == "src3").alias("archived"),
        (F.col("source") == "src7").alias("fork"),
        F.array("lang", "source").alias("topics"),
        F.col("text").alias("readme"),
    )


DOCUMENT_REPOS_SQL = """
SELECT doc_id, source || '/doc-' || doc_id AS full_name, source || '-app-' || lang AS name,
       split_part(text, chr(10), 1) AS description, n_chars % 50 AS stars,
       TIMESTAMP '2024-01-01' - to_days(CAST(n_chars % 1500 AS INTEGER)) AS pushed_at,
       source = 'src3' AS archived, source = 'src7' AS fork, lang, source, text, lower(text) AS t
FROM documents"""


# ---- order lines as file listings and as web tables ------------------------
def listing(spark: SparkSession, folder: str) -> DataFrame:
    """One directory entry per order line; the order is the repository."""
    line, flag = F.col("l_linenumber"), F.col("l_returnflag")

    def by_flag(a: str, n: str, r: str) -> Column:
        return F.when(flag == "A", a).when(flag == "N", n).otherwise(r)

    path = (
        F.when(line == 1, by_flag("Index.hbs", "default.hbs", "post.hbs"))
        .when(line == 2, by_flag("assets", "partials", "locales"))
        .when(line == 3, by_flag("package.json", "README.md", "webpack.config.js"))
        .when(line == 4, by_flag("assets/css/screen.css", "assets/main.js", "assets/logo.PNG"))
        .when(line == 5, by_flag("partials/card.hbs", "server.js", "Docs.md"))
        .when(line == 6, by_flag("ghost.json", "author.hbs", "angular.json"))
        .otherwise(by_flag("tag.hbs", "assets/deep/er/x.css", "main.py"))
    )
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("r/"), F.col("l_orderkey")).alias("full_name"),
        path.alias("path"),
        F.element_at(F.split(path, "/"), -1).alias("name"),
        F.when(line == 2, "dir").otherwise("file").alias("type"),
    )


LISTING_SQL = """
SELECT 'r/' || l_orderkey AS full_name, l_linenumber AS l, l_returnflag AS f FROM lineitem"""


def manifests(spark: SparkSession, folder: str) -> DataFrame:
    """A manifest per part; the small ones are broken JSON."""
    text = F.concat(
        F.lit('{"engines":{'),
        F.when(F.col("p_size") > 30, F.concat(F.lit('"ghost":">='), F.col("p_size"), F.lit('"'))).otherwise(F.lit("")),
        F.lit('},"keywords":["'), F.col("p_type"), F.lit('","'), F.col("p_brand"),
        F.lit('"],"dependencies":{"'), F.col("p_type"), F.lit('-lib":"1"},"peerDependencies":{'),
        F.when(F.col("p_size") < 20, F.lit('"express-hbs":"2"')).otherwise(F.lit("")),
        F.when(F.col("p_size") > 3, F.lit("}}")).otherwise(F.lit("}")),
    )
    return table(spark, folder, "part").select(
        F.concat(F.lit("r/"), F.col("p_partkey")).alias("full_name"), text.alias("json")
    )


def table_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Each page's links rewritten as an HTML table, inside its record.

    Targets with a length divisible by four become category rows. By other lengths, attribute values hold ``>`` or stand without
    quotes, blanks are character references, end tags are missing, and a table stands inside a cell.
    """
    pages = table(spark, folder, "pages")
    targets = F.transform(html.start_tags("html", "a"), lambda tag: html.attribute(tag, "href"))

    def row(target: Column) -> Column:
        size = F.length(target)
        header = F.concat(
            F.lit('<tr><td colspan="5"><strong>'),
            F.when(size % 8 == 0, F.lit("Official themes")).otherwise(F.lit("Tools &amp; Resources")),
            F.lit("</strong></td></tr>"),
        )
        host = F.when(F.contains(target, F.lit("t")), F.lit("https://github.com/nav")).otherwise(F.lit("https://x.example"))
        link = F.concat(host, target)
        notes = F.when(
            size > 6, F.concat(F.lit("A responsive magazine theme, "), size * 97, F.lit(" stars; well kept"))
        ).otherwise(F.concat(F.lit("Plain; "), size * 97, F.lit(" stars")))
        data = F.concat(
            F.when(size % 3 == 0, F.lit("<tr><td title=\"a > b, no <td>\"> Entry ")).otherwise(F.lit("<tr><td> Entry&#32;")),
            size,
            F.when(size % 2 == 0, F.lit("</td>\n<td>")).otherwise(F.lit("<td>")),
            F.when(size % 5 == 0, F.concat(F.lit("<a class=x href="), link, F.lit(">"))).otherwise(F.concat(F.lit("<a title='href=x' href=\""), link, F.lit('">'))),
            link,
            F.lit("</a></td><td>"),
            notes,
            F.when(size % 7 == 0, F.lit("</td><td><table><thead><tr><th>h</thead><tr><td>Starter&#x20;kits</table>")).otherwise(F.lit("</td>")),
            F.lit("</tr>\n"),
        )
        return F.when(size % 4 == 0, header).otherwise(data)

    return pages.select(
        "page_id",
        F.concat(
            F.lit("<html><body><!-- <table> --><table><thead><tr><th>Name</th></tr></thead><tbody>\n"),
            F.array_join(F.transform(targets, row), ""),
            F.lit("</tbody></table><table><tbody><tr><td>x</td></tr></tbody></table></body></html>"),
        ).alias("html"),
    )


LINKS_SQL = """
SELECT page_id, i - 1 AS link_pos, replace(v[i], '&amp;', '&') AS target
FROM (SELECT page_id, v, unnest(range(1, len(v) + 1)) AS i
      FROM (SELECT page_id, regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1) AS v FROM pages))"""

WEB_ROWS_SQL = f"""
SELECT l.page_id, link_pos + 2 * before + inner_row AS row_pos, target, size, size * 97 AS stars, nested, inner_row
FROM (SELECT *, coalesce(sum(nested::INT) OVER (PARTITION BY page_id ORDER BY link_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
      FROM (SELECT *, length(target) AS size, length(target) % 7 = 0 AND length(target) % 4 <> 0 AS nested FROM ({LINKS_SQL}))) l,
     (SELECT unnest([0, 1, 2]) AS inner_row) WHERE inner_row = 0 OR nested"""


# ---- events as cache entries -----------------------------------------------
CACHE_TTL_MS = 7 * 24 * 3600 * 1000


def cache_entries(spark: SparkSession, folder: str) -> DataFrame:
    """One entry per event; a small k breaks the payload."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    payload = F.when(k < 3, F.concat("props", F.lit("x"))).otherwise(F.col("props"))
    return table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("key"),
        F.length(payload).cast("long").alias("length"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
        "event_id",
        is_json(payload).alias("valid"),
    )


def last_event_ms(spark: SparkSession, folder: str) -> int:
    return table(spark, folder, "events").agg(
        F.max(F.unix_millis(F.col("ts").cast("timestamp")))
    ).first()[0]


CACHE_SQL = """
SELECT CAST(user_id AS VARCHAR) AS key, event_id, epoch_us(ts) // 1000 AS ts_ms,
       CAST(json_extract_string(props, '$.k') AS INTEGER) >= 3 AS valid,
       CAST(length(props) + CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 3 THEN 1 ELSE 0 END AS BIGINT) AS length,
       (SELECT epoch_us(max(ts)) // 1000 FROM events) AS now_ms
FROM events"""
