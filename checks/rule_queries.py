from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query
from gleanery.operators import rules as R
from gleanery.sources import sample_tables as S


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return S.customer_items(S.table(spark, folder, "customer"), S.table(spark, folder, "nation"))


MATCHED = f"""WITH m AS (SELECT id, {S.RULE_MATCH_SQL.format(r='repo')} AS ignore_reason FROM ({S.CUSTOMER_ITEMS_SQL}))"""


@query("ignore_reasons", f"{MATCHED} SELECT id, ignore_reason FROM m WHERE ignore_reason IS NOT NULL")
def _(spark: SparkSession, folder: str) -> DataFrame:
    items = _customers(spark, folder).select("id", "repo")
    return R.ignore_reasons(items, S.rules(spark, folder)).select("id", "ignore_reason")


@query("ignore_allowed", f"{MATCHED} SELECT id FROM m WHERE ignore_reason IS NULL")
def _(spark: SparkSession, folder: str) -> DataFrame:
    items = _customers(spark, folder).select("id", "repo")
    return R.ignore_allowed(items, S.rules(spark, folder)).select("id")


@query(
    "common_ignore_reasons",
    r"""WITH n AS (SELECT p_partkey, replace(p_name, ' ', '-') || CASE WHEN p_size < 10 THEN '-Test' WHEN p_size < 20 THEN '-copy'
                     WHEN p_size < 30 THEN '-backup' ELSE '' END AS x FROM part),
             v AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'demo-' || x ELSE 'own/' || x END AS repo FROM n)
        SELECT p_partkey, repo, regexp_matches(repo, '(?i)(.*-test$)|(^test-.*)|(.*-backup$)|(.*-fork$)|(^demo-.*)|(.*-example$)|(^tmp-.*)|(.*-deprecated$)|(^archive-.*)|(.*-mirror$)|(.*-clone$)|(.*-copy$)') AS matches,
          concat_ws('|', CASE WHEN regexp_matches(repo, '(?i).*-test$') THEN 'Test repository (ends with -test)' END,
            CASE WHEN regexp_matches(repo, '(?i).*-backup$') THEN 'Backup repository' END,
            CASE WHEN regexp_matches(repo, '(?i)^demo-.*') THEN 'Demo repository' END,
            CASE WHEN regexp_matches(repo, '(?i).*-copy$') THEN 'Copy repository' END) AS reasons FROM v""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size")
    name = F.concat(
        F.translate("p_name", " ", "-"),
        F.when(size < 10, "-Test").when(size < 20, "-copy").when(size < 30, "-backup").otherwise(""),
    )
    repo = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("demo-"), name)).otherwise(F.concat(F.lit("own/"), name))
    parts = S.table(spark, folder, "part").select("p_partkey", repo.alias("repo"))
    found = R.common_ignore_reasons(parts)
    return found.select("p_partkey", "repo", "matches", F.array_join("reasons", "|").alias("reasons"))


@query(
    "override_apply",
    f"""SELECT id, name, category, array_to_string(tags, ',') AS tags, notes, hidden
        FROM ({S.OVERRIDDEN_SQL.format(items=S.CUSTOMER_ITEMS_SQL)})""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    items = _customers(spark, folder).select("id", "repo", "name", "category", "tags", "notes", "hidden")
    found = R.apply_overrides(items, S.overrides(spark, folder))
    return found.select("id", "name", "category", F.array_join("tags", ",").alias("tags"), "notes", "hidden")


def _rule_values(low: int, high: int) -> str:
    return f"""SELECT 'exact' AS kind, c_mktsegment || '/' || c_name AS value FROM customer
               WHERE c_acctbal BETWEEN {low} AND {high}"""


def _additions(spark: SparkSession, folder: str) -> DataFrame:
    return S.table(spark, folder, "customer").filter(F.col("c_acctbal").between(50, 200)).select(
        (F.col("c_custkey") + 1_000_000).cast("int").alias("pos"),
        F.lit("exact").alias("kind"),
        F.concat("c_mktsegment", F.lit("/"), "c_name").alias("value"),
    )


_PATTERN_ROWS = "SELECT 'pattern' AS kind, unnest(['^machinery/.*7$', '[oops', '#0000000[12]\\d', 'household/.*3$']) AS value"


@query("rules_add", f"{_rule_values(0, 200)} UNION ALL {_PATTERN_ROWS}")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return R.rules_add(S.rules(spark, folder), _additions(spark, folder)).select("kind", "value")


@query(
    "rules_remove",
    f"""{_rule_values(0, 100)} EXCEPT {_rule_values(50, 200)} UNION ALL {_PATTERN_ROWS}""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return R.rules_remove(S.rules(spark, folder), _additions(spark, folder)).select("kind", "value")


@query(
    "split_patterns",
    """SELECT CASE WHEN p_size > 25 THEN '[' ELSE '' END || p_name AS value, count(*) AS uses,
              NOT starts_with(CASE WHEN p_size > 25 THEN '[' ELSE '' END || p_name, '[') AS valid
       FROM part GROUP BY value""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Every product name with an opening bracket in front, and without."""
    names = S.table(spark, folder, "part").select(
        F.when(F.col("p_size") > 25, F.concat(F.lit("["), "p_name")).otherwise(F.col("p_name")).alias("value")
    )
    return R.split_patterns(names.groupBy("value").agg(F.count(F.lit(1)).alias("uses"))).select("value", "uses", "valid")


_MANY = f"""
WITH i AS ({S.CUSTOMER_ITEMS_SQL}),
p AS (SELECT split_part(repo, '/', 1) AS segment, c_custkey % 1000 AS last, min(c_custkey) AS pos FROM i GROUP BY ALL)
SELECT i.id, 'Matched pattern: ^' || p.segment || '/.*' || lpad(CAST(p.last AS VARCHAR), 3, '0') || '$' AS ignore_reason
FROM i JOIN p ON p.segment = split_part(repo, '/', 1) AND p.last = c_custkey % 1000"""


@query("ignore_many_patterns", _MANY)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """A pattern for each segment and each end of a customer number: 5,000 of them where all occur."""
    items = _customers(spark, folder)
    last = F.col("c_custkey") % 1000
    patterns = (
        items.groupBy(F.split_part("repo", F.lit("/"), F.lit(1)).alias("segment"), last.alias("last"))
        .agg(F.min("c_custkey").cast("int").alias("pos"))
        .select(
            "pos",
            F.lit("pattern").alias("kind"),
            F.concat(F.lit("^"), "segment", F.lit("/.*"), F.lpad(F.col("last").cast("string"), 3, "0"), F.lit("$")).alias("value"),
        )
    )
    return R.ignore_reasons(items.select("id", "repo"), patterns).select("id", "ignore_reason")
