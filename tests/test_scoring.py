from __future__ import annotations

from datetime import datetime

import pytest

from gleanery.operators import scoring as C
from gleanery.operators import structure as X
from gleanery.profiles import LIBRARY_PROFILE, UPDATE_PROFILE, Thresholds, Weights
from tests.conftest import AS_OF, by

SCHEMA = (
    "name string, full_name string, description string, stargazers_count bigint, pushed_at timestamp, "
    "archived boolean, fork boolean, topics array<string>, readme string"
)
CONTENTS = "full_name string, path string, name string, type string"


def repo(full_name="user/theme", **given):
    base = dict(
        name=full_name.split("/")[-1], full_name=full_name, description="A description of some length",
        stargazers_count=100, pushed_at=datetime(2026, 1, 1), archived=False, fork=False, topics=[], readme=None,
    )
    base.update(given)
    return tuple(base[c.split(" ")[0]] for c in SCHEMA.split(", "))


def listing(spark, *paths, full_name="user/theme"):
    rows = [
        (full_name, p.rstrip("/"), p.rstrip("/").split("/")[-1], "dir" if p.endswith("/") else "file") for p in paths
    ]
    return spark.createDataFrame(rows, CONTENTS)


def classify(spark, *repos, contents=(), manifest=None, profile=LIBRARY_PROFILE):
    manifests = None
    if manifest is not None:
        table = spark.createDataFrame([("user/theme", manifest)], "full_name string, json string")
        manifests = X.manifest_features(table, domain_keywords=profile.domain_keywords)
    features = X.structure_features(listing(spark, *contents))
    joined = X.with_structure(spark.createDataFrame(list(repos), SCHEMA), features, manifests)
    return by(C.classify(joined, AS_OF, profile), "full_name")


def one(spark, contents=(), manifest=None, profile=LIBRARY_PROFILE, **given):
    return classify(spark, repo(**given), contents=contents, manifest=manifest, profile=profile)["user/theme"]


def test_topics(spark):
    assert one(spark, topics=["ghost-theme", "handlebars", "responsive"])["signals"]["topics"] == 100
    assert one(spark, topics=["Ghost"])["signals"]["topics"] == 60
    assert one(spark, topics=["blog", "css"])["signals"]["topics"] == 15
    row = one(spark, topics=["javascript", "nodejs", "api"], stargazers_count=5)
    assert row["score"] < 30 and row["confidence"] == "low" and row["signals"]["topics"] == 0
    assert "Topics: No GitHub topics found" in one(spark, topics=None)["reasoning"]


def test_readme(spark):
    text = "# A Ghost theme\n\nA modern, clean blog. Install it. Live demo. ![shot](x.png)"
    row = one(spark, readme=text)
    # 50 domain + min(4 * 8, 30) + 15 + 10 + 5, capped
    assert row["signals"]["readme"] == 100
    assert "README: README mentions Ghost: ghost" in row["reasoning"]
    assert "README: README contains theme keywords: theme, blog, clean, modern" in row["reasoning"]
    assert one(spark, readme="")["signals"]["readme"] == 0
    assert "README: No README found" in one(spark, readme=None)["reasoning"]


def test_only_five_keywords_are_named(spark):
    text = "theme template handlebars hbs blog cms publishing"
    reasons = one(spark, readme=text)["reasoning"]
    assert "README: README contains theme keywords: theme, template, handlebars, hbs, blog" in reasons


def test_full_structure(spark):
    manifest = (
        '{"engines": {"ghost": ">=5.0"}, "keywords": ["Ghost-Theme", "css"], '
        '"devDependencies": {"express-hbs": "1"}}'
    )
    row = one(
        spark,
        contents=[
            "index.hbs", "Post.hbs", "default.hbs", "author.hbs", "package.json", "ghost-config.json", "assets/", "partials/",
            "locales/", "assets/a.css", "assets/js/", "assets/js/b.ts", "assets/x/y/deep.css", "assets/logo.SVG",
            "partials/one.hbs", "partials/two.hbs", "README.md",
        ],
        manifest=manifest,
    )
    assert row["signals"]["structure"] == 100
    assert "Structure: Found essential Ghost theme files: index.hbs, post.hbs, default.hbs" in row["reasoning"]
    assert "Structure: Found 1 additional .hbs files" in row["reasoning"]
    assert "Structure: Found theme directories: partials, assets, locales" in row["reasoning"]
    assert "Structure: Specifies Ghost engine version: >=5.0" in row["reasoning"]
    assert "Structure: Package.json contains Ghost keywords: Ghost-Theme" in row["reasoning"]
    assert "Structure: Contains Ghost-related dependencies" in row["reasoning"]
    assert "Structure: Found 1 CSS/SCSS files" in row["reasoning"]
    assert "Structure: Found 2 partial templates" in row["reasoning"]
    assert "Structure: Contains Ghost configuration files" in row["reasoning"]


def test_structure_points_below_the_cap(spark):
    # 25 + 10 (partials) + 5 (one additional) + 3 (one partial) - 5 (no assets) - 15 (no css) - 10 (server file)
    row = one(spark, contents=["index.hbs", "tag.hbs", "partials/", "partials/a.hbs", "server.js"])
    assert row["signals"]["structure"] == 13
    assert "Structure: Structure penalty: Server-side files present: server.js" in row["reasoning"]
    assert "Structure: Structure penalty: Missing essential directories: assets" in row["reasoning"]


def test_no_template_files(spark):
    row = one(spark, contents=["README.md", "webpack.config.js", "next.config.js"])
    assert row["signals"]["structure"] == 0
    assert "Structure: Structure penalty: No Handlebars (.hbs) files found" in row["reasoning"]
    assert "Structure: Structure penalty: Build tools present: webpack.config.js" in row["reasoning"]


def test_many_documents(spark):
    features = X.structure_features(listing(spark, *[f"doc{i}.md" for i in range(6)])).first()
    assert features["suspicious"] == ["Many documentation files: 6"]
    assert X.structure_features(listing(spark, *[f"doc{i}.md" for i in range(5)])).first()["suspicious"] == []


@pytest.mark.parametrize("text", ["{broken", '{"engines":{"ghost":"5"}} trailing', "", "[1]", None])
def test_unreadable_manifest_gives_no_features(spark, text):
    table = spark.createDataFrame([("a/b", text)], "full_name string, json string")
    row = X.manifest_features(table, domain_keywords=("ghost",)).first()
    assert (row["engine_version"], row["manifest_keywords"], row["has_dependencies"]) == (None, [], False)


def test_penalties(spark):
    row = one(
        spark, name="My-App-Tool", description="  Test  ", stargazers_count=2, archived=True, fork=True,
        pushed_at=datetime(2024, 4, 15, 11, 59), readme="WIP. Deprecated learning copy",
    )
    # 60 archived, 25 old, 20 stars, 16 two words, 12 one word, 12 two words in the text, 15, 25, 10, 15 fork, 5 short
    assert row["signals"]["penalties"] == 60 + 25 + 20 + 16 + 12 + 12 + 15 + 25 + 10 + 15 + 5
    assert "Penalty: No activity since Mon Apr 15 2024" in row["reasoning"]
    assert "Penalty: Very low star count: 2" in row["reasoning"]
    assert "Penalty: Repository name suggests non-theme: app, tool" in row["reasoning"]
    assert "Penalty: README contains penalty keywords: copy, learning" in row["reasoning"]
    assert "Penalty: Repository is a fork" in row["reasoning"]


def test_description_penalties(spark):
    assert one(spark, description=None)["signals"]["penalties"] == 8
    assert one(spark, description="")["signals"]["penalties"] == 8
    assert one(spark, description=" \n ")["signals"]["penalties"] == 13
    assert one(spark, description="x" * 20)["signals"]["penalties"] == 0
    assert one(spark, stargazers_count=9)["signals"]["penalties"] == 10


@pytest.mark.parametrize(
    ("score", "bucket"), [(100, "high"), (75, "high"), (74, "medium"), (50, "medium"), (49, "low"), (0, "low")]
)
def test_buckets(spark, score, bucket):
    row = spark.createDataFrame([(score,)], "s int").select(C.confidence_bucket(_s()).alias("b")).first()
    assert row["b"] == bucket


def _s():
    from pyspark.sql import functions as F

    return F.col("s")


def test_rounding_is_half_up(spark):
    from pyspark.sql import functions as F

    # 0.4 * 60 + 0.3 * 55 = 40.5
    df = spark.createDataFrame([(60, 55, 0, 0), (100, 100, 100, 0), (0, 0, 0, 100)], "t int, r int, s int, p int")
    got = [r[0] for r in df.select(C.weighted_score(F.col("t"), F.col("r"), F.col("s"), F.col("p"))).collect()]
    assert got == [41, 95, 0]


def test_profiles_differ(spark):
    given = dict(topics=["ghost-theme"], readme="Ghost website")
    library = one(spark, **given)
    update = one(spark, profile=UPDATE_PROFILE, **given)
    assert library["signals"]["readme"] == 50 and update["signals"]["readme"] == 58


def test_argument_guards():
    with pytest.raises(ValueError, match="sum to 1"):
        Weights(0.5, 0.5, 0.5, 0.0)
    with pytest.raises(ValueError, match="between 0 and 1"):
        Weights(1.5, -0.5, 0.0, 0.0)
    with pytest.raises(ValueError, match="descending"):
        Thresholds(high=50, medium=50)


def test_batch_keeps_every_row(spark):
    found = classify(spark, repo("u/1"), repo("u/2", topics=None, readme=None, description=None))
    assert set(found) == {"u/1", "u/2"} and all(r["score"] is not None for r in found.values())
