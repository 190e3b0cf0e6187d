from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gleanery.operators import rules as R
from tests.conftest import by, items, overrides, rules


def ignored(spark, rule_table, *repos):
    found = R.ignore_reasons(items(spark, *[{"id": r} for r in repos]), rule_table)
    return {r["repo"]: r["ignore_reason"] for r in found.collect()}


def test_exact_rule(spark):
    table = rules(spark, repos=["exact/match", "another/repo"])
    assert ignored(spark, table, "exact/match", "not/matched", "EXACT/match") == {
        "exact/match": "Exact match in ignore list"
    }


def test_patterns_search_without_case(spark):
    table = rules(spark, patterns=[".*-test$", "^demo-.*", ".*-backup$"])
    found = ignored(
        spark, table, "user/repo-TEST", "demo-project", "user/data-backup", "user/normal-repo", "user/demo-x"
    )
    assert found == {
        "user/repo-TEST": "Matched pattern: .*-test$",
        "demo-project": "Matched pattern: ^demo-.*",
        "user/data-backup": "Matched pattern: .*-backup$",
    }


def test_invalid_pattern_is_skipped(spark):
    table = rules(spark, patterns=["[invalid-regex", "valid-.*"])
    assert ignored(spark, table, "valid-test", "other-repo") == {"valid-test": "Matched pattern: valid-.*"}


def test_exact_wins_then_first_pattern(spark):
    table = rules(spark, repos=["a/one-test"], patterns=["never", "^a/", "test$"])
    assert ignored(spark, table, "a/one-test", "a/two-test", "b/two-test") == {
        "a/one-test": "Exact match in ignore list",
        "a/two-test": "Matched pattern: ^a/",
        "b/two-test": "Matched pattern: test$",
    }


def test_only_invalid_patterns(spark):
    assert ignored(spark, rules(spark, patterns=["(", "a{"]), "a/b") == {}


def test_backreference_is_not_combined(spark):
    table = rules(spark, patterns=["(x)y", r"(a)\1"])
    assert ignored(spark, table, "z/aa", "z/ab") == {"z/aa": r"Matched pattern: (a)\1"}


@pytest.mark.parametrize("n", [49, 50, 51, 499, 501, 2000])
def test_any_number_of_patterns_reads_them_alike(spark, n):
    special = ["(broken", r"own/(?<x>repo)", r"^\p{L}+/ä$", "repo[a-z&&[a]]", r"(a)\1", "(?x) q q # (", "Ä", "(?<=o+)wn"]
    table = rules(spark, repos=["a/x"], patterns=[f"^filler{i}/" for i in range(n - len(special))] + special)
    repos = ["a/x", "own/repo", "ß/ä", "c/repoa", "d/aa", "e/qq", "f/ä1", "filler7/z", "g/none"]
    assert ignored(spark, table, *repos) == {
        "a/x": "Exact match in ignore list",
        "own/repo": r"Matched pattern: own/(?<x>repo)",
        "ß/ä": r"Matched pattern: ^\p{L}+/ä$",
        "c/repoa": "Matched pattern: repo[a-z&&[a]]",
        "d/aa": r"Matched pattern: (a)\1",
        "e/qq": "Matched pattern: (?x) q q # (",
        "f/ä1": "Matched pattern: Ä",
        "filler7/z": "Matched pattern: ^filler7/",
    }
    plan = R.match_rules(items(spark, {"id": "a/x"}), table)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_allowed_is_the_rest(spark):
    table = rules(spark, repos=["a/x"], patterns=["^b/"])
    allowed = R.ignore_allowed(items(spark, {"id": "a/x"}, {"id": "b/x"}, {"id": "c/x"}), table)
    assert [r["id"] for r in allowed.collect()] == ["c/x"]


def test_split_patterns(spark):
    table = rules(spark, patterns=["valid-.*", "[invalid", "^also-valid$", "(unclosed"])
    found = by(R.split_patterns(table), "value")
    assert [found[p]["valid"] for p in ("valid-.*", "[invalid", "^also-valid$", "(unclosed")] == [
        True, False, True, False,
    ]
    assert found["[invalid"]["error"]


def test_validity_is_what_the_matching_engine_accepts(spark):
    good = ["a{2}", "a{2,}", "[{]", r"\{", "(?:x)", "x|y", "[^a-z]+", "(?<n>x)", "[[a]]", r"\p{L}", "(?<=a)b"]
    bad = ["(?P<n>x)", "(?(1)a|b)", "a{", "[[a]", "(", "*", r"\N{DIGIT ONE}x)", None]
    found = R.split_patterns(spark.createDataFrame([(p,) for p in good + bad], "value string")).collect()
    assert {r["value"] for r in found if r["valid"]} == set(good)
    assert all(r["error"] for r in found if not r["valid"])


def test_rules_add_and_remove(spark):
    table = rules(spark, repos=["a/x"], patterns=["p.*"])
    more = spark.createDataFrame(
        [(9, "exact", "a/x"), (9, "exact", "b/x"), (10, "exact", "b/x"), (9, "pattern", "a/x")],
        "pos int, kind string, value string",
    )
    added = {(r["kind"], r["value"]) for r in R.rules_add(table, more).collect()}
    assert added == {("exact", "a/x"), ("exact", "b/x"), ("pattern", "p.*"), ("pattern", "a/x")}
    assert R.rules_add(table, more).count() == 4
    gone = spark.createDataFrame([("a/x",)], "value string")
    assert {r["value"] for r in R.rules_remove(R.rules_add(table, more), gone).collect()} == {"b/x", "p.*"}


def test_common_reasons(spark):
    repos = ["user/theme-test", "demo-theme", "user/theme-backup", "user/normal-theme", "demo-a-copy"]
    found = by(R.common_ignore_reasons(items(spark, *[{"id": r} for r in repos])), "repo")
    assert found["user/theme-test"]["reasons"] == ["Test repository (ends with -test)"]
    assert found["demo-a-copy"]["reasons"] == ["Demo repository", "Copy repository"]
    assert found["user/normal-theme"]["reasons"] == [] and not found["user/normal-theme"]["matches"]


def test_override_replaces_given_fields_only(spark):
    base = items(spark, {"id": "a/x", "name": "Old", "tags": ["existing1", "remove-me"], "notes": "n"})
    patch = overrides(
        spark,
        {"repo": "a/x", "name": "New", "tags_add": ["new-tag", "existing1"], "tags_remove": ["remove-me"]},
    )
    row = R.apply_overrides(base, patch).first()
    assert (row["name"], row["tags"], row["notes"], row["category"]) == ("New", ["existing1", "new-tag"], "n", "Theme")


def test_last_override_wins_as_a_whole(spark):
    base = items(spark, {"id": "a/x", "name": "Old"}, {"id": "b/x", "name": "Same"})
    patch = overrides(
        spark, {"repo": "a/x", "name": "First", "hidden": True}, {"repo": "a/x", "category": "Tool"}
    )
    found = by(R.apply_overrides(base, patch), "id")
    assert (found["a/x"]["name"], found["a/x"]["category"], found["a/x"]["hidden"]) == ("Old", "Tool", False)
    assert found["b/x"]["name"] == "Same"


def test_tag_removal_keeps_repeats_of_other_tags(spark):
    base = items(spark, {"id": "a/x", "tags": ["k", "r", "k"]})
    row = R.apply_overrides(base, overrides(spark, {"repo": "a/x", "tags_remove": ["r"]})).first()
    assert row["tags"] == ["k", "k"]


def test_empty_rule_table(spark):
    base = items(spark, {"id": "a/x"})
    assert R.ignore_allowed(base, rules(spark)).count() == 1
    assert R.ignore_reasons(base, rules(spark)).select(F.col("ignore_reason")).count() == 0


PIECES = ["abc", "x.y", "demo", "-test", "Straße", "9", "qQ"]
AROUND = ["{0}", "^{0}", "{0}$", "({0})", "(?:{0})?z", "{0}+", "{0}*k", "[{0}]", "{0}|zz", r"\d{0}", r"{0}\.js", "(?i){0}", "(a|{0})b", "{0}{{2}}",
          r"\Q{0}\E", "(?={0})", "(?!{0})x", "((?:{0})+)", "(?x) {0} # no", r"{0}\w+{1}", "[^{0}]{1}", "({0}|{1})", "{0}.?{1}", r"\[{0}\]", r"\\{0}", "(?<n>{0}{1})"]


def test_patterns_are_found_as_by_trying_each(spark):
    patterns = [a.format(p, PIECES[(i + 3) % len(PIECES)]) for i, p in enumerate(PIECES) for a in AROUND]
    texts = [f"{a}/{b}{c}" for a in PIECES for b in ("", "demo", "[abc]", "ABCABC", "x.y.js") for c in ("-TEST", "9b", "\\demo", "zk", "ſtraK")]
    texts += [p.upper() for p in PIECES] + [f"{p}{p}" for p in PIECES] + ["", "ab", "zz", "İıii"]
    usable = spark.createDataFrame([(i, p) for i, p in enumerate(patterns)], "pos int, value string").where(R.pattern_error("value").isNull())
    names = spark.createDataFrame([(t,) for t in texts], "repo string").distinct()
    tried = names.join(usable, F.rlike("repo", F.concat(F.lit(R.ANY_CASE), F.col("value")))).groupBy("repo").agg(F.min_by("value", "pos"))
    found = R.match_rules(names, rules(spark, patterns=patterns)).where("rule_kind IS NOT NULL").select("repo", "rule_value")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, tried.collect()))


@pytest.mark.parametrize(
    ("pattern", "held"),
    [
        ("^Machinery/.*7$", "machinery/"), (r"a\.bc", "a.bc"), ("abc?d", "ab|d"), ("(abc)+", "abc"), ("(abc)?", ""), ("abc|def", ""), ("x(abc|d)y", "x|y"),
        ("[abc]def[^g]hij", "def|hij"), (r"\Qabc\E", ""), ("abc{2}d", "ab|d"), ("ab+cd", "ab|cd"), ("(?x)abc", ""), (r"abc\\def", "abc|def"), ("(?<!abc)def", "def"),
        (r"#0000000[12]\d", "#0000000"), ("((abc))", "abc"), ("((((abc))))", ""), (r"\[abc\]", "abc"),
    ],
)
def test_what_a_pattern_requires(spark, pattern, held):
    want = {p[i : i + R.GRAM] for p in held.split("|") for i in range(len(p) - R.GRAM + 1)}
    got = spark.createDataFrame([(pattern,)], "p string").select(R.required_grams("p")).first()[0]
    assert set(got) == want


def test_plans_do_not_grow_with_the_patterns(spark):
    def plan(n):
        table = spark.range(n).select(F.col("id").cast("int").alias("pos"), F.lit("pattern").alias("kind"), F.concat(F.lit("^own"), F.col("id"), F.lit("/")).alias("value"))
        return R.match_rules(items(spark, {"id": "own7/x"}), table)

    small, large = plan(10), plan(30_000)
    sizes = [len(p._jdf.queryExecution().optimizedPlan().toString()) for p in (small, large)]
    assert abs(sizes[1] - sizes[0]) < 50
    text = large._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert [r.rule_value for r in small.collect()] == ["^own7/"] == [r.rule_value for r in large.collect()]


def test_one_text_with_most_rows_is_matched_once(spark):
    many = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.lit("hot/repo")).otherwise(F.concat(F.lit("own/"), F.col("id"))).alias("repo"))
    found = R.match_rules(many, rules(spark, patterns=["^hot/", "own/.*0$", "^.$"]))
    assert {(r[0], r[1]) for r in found.groupBy("rule_value").count().collect()} == {("^hot/", 2000), ("own/.*0$", 100), (None, 900)}
