from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query
from gleanery.functions.columns import has_any_topic
from gleanery.operators import scoring as C
from gleanery.operators import structure as X
from gleanery.profiles import NON_THEME_WORDS, ScoringProfile, Thresholds, Weights
from gleanery.sources import sample_tables as S

AS_OF = datetime(2024, 1, 1)
DOMAIN = ("en", "src1")
THEME = ("license", "test", "de", "src", "copyright", "email", "http", "src12")
PENALTY = ("test", "copy", "app", "error", "the")
PROFILE = ScoringProfile(
    weights=Weights(topics=0.4, readme=0.3, structure=0.25, penalties=0.05),
    thresholds=Thresholds(high=75, medium=50),
    domain_keywords=DOMAIN,
    theme_keywords=THEME,
    penalty_keywords=PENALTY,
)


def how_many(column: str, words: tuple[str, ...]) -> str:
    return "(" + " + ".join(f"CAST(contains({column}, '{w}') AS INTEGER)" for w in words) + ")"


def has_any(column: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


def _join(column: str, words: tuple[str, ...]) -> str:
    return "concat_ws(', ', " + ", ".join(f"CASE WHEN contains({column}, '{w}') THEN '{w}' END" for w in words) + ")"


def _topics(words: tuple[str, ...]) -> str:
    return f"list_filter([lang, source], lambda x: {has_any('x', words)})"


_BLANKS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12) || chr(160) || chr(8232) || chr(8233) || chr(65279)"

LISTED = f"""
WITH f AS ({S.LISTING_SQL}),
x AS (SELECT full_name,
  count(*) FILTER (l = 1 OR (l = 6 AND f = 'N') OR (l = 7 AND f = 'A')) AS template_files,
  concat_ws(',', CASE WHEN bool_or(l = 1 AND f = 'A') THEN 'index.hbs' END, CASE WHEN bool_or(l = 1 AND f = 'R') THEN 'post.hbs' END,
    CASE WHEN bool_or(l = 1 AND f = 'N') THEN 'default.hbs' END) AS essential_files,
  concat_ws(',', CASE WHEN bool_or(l = 2 AND f = 'N') THEN 'partials' END, CASE WHEN bool_or(l = 2 AND f = 'A') THEN 'assets' END,
    CASE WHEN bool_or(l = 2 AND f = 'R') THEN 'locales' END) AS theme_directories,
  bool_or(l = 3 AND f = 'A') AS has_package_json, bool_or(l = 6 AND f = 'A') AS has_config,
  bool_or(l = 2 AND f = 'A') AS ha, bool_or(l = 2 AND f = 'N') AS hp,
  count(*) FILTER (l = 4 AND f = 'A') AS css, count(*) FILTER (l = 4 AND f = 'N') AS js, count(*) FILTER (l = 4 AND f = 'R') AS img,
  count(*) FILTER (l = 5 AND f = 'A') AS par,
  count(*) FILTER ((l = 3 AND f = 'N') OR (l = 5 AND f = 'R')) AS doc_files,
  concat_ws(';', CASE WHEN bool_or(l = 3 AND f = 'R') THEN 'Build tools present: webpack.config.js' END,
    CASE WHEN bool_or(l = 6 AND f = 'R') THEN 'Framework files present: angular.json' END,
    CASE WHEN bool_or((l = 5 AND f = 'N') OR (l = 7 AND f = 'R')) THEN 'Server-side files present: ' ||
      concat_ws(', ', CASE WHEN bool_or(l = 5 AND f = 'N') THEN 'server.js' END, CASE WHEN bool_or(l = 7 AND f = 'R') THEN 'main.py' END) END,
    CASE WHEN count(*) FILTER ((l = 3 AND f = 'N') OR (l = 5 AND f = 'R')) > 5
      THEN 'Many documentation files: ' || count(*) FILTER ((l = 3 AND f = 'N') OR (l = 5 AND f = 'R')) END) AS suspicious
  FROM f GROUP BY full_name),
y AS (SELECT *, CASE WHEN ha THEN css ELSE 0 END AS css_files, CASE WHEN ha THEN js ELSE 0 END AS js_files,
             CASE WHEN ha THEN img ELSE 0 END AS image_files, CASE WHEN hp THEN par ELSE 0 END AS partial_files,
             CASE WHEN essential_files = '' THEN 0 ELSE len(string_split(essential_files, ',')) END AS ne,
             CASE WHEN theme_directories = '' THEN 0 ELSE len(string_split(theme_directories, ',')) END AS nd,
             CASE WHEN suspicious = '' THEN 0 ELSE len(string_split(suspicious, ';')) END AS ns FROM x)
"""


def manifest_sql(keywords: tuple[str, ...]) -> str:
    """What each manifest holds, by the rules of ``sample_tables.manifests``."""
    return f"""SELECT 'r/' || p_partkey AS full_name, p_size > 30 AS engine, '>=' || p_size AS version, p_size > 3 AND p_size < 20 AS deps,
      CASE WHEN p_size > 3 THEN concat_ws(', ', CASE WHEN {has_any('lower(p_type)', keywords)} THEN p_type END,
        CASE WHEN {has_any('lower(p_brand)', keywords)} THEN p_brand END) ELSE '' END AS words FROM part"""


#: Points of a manifest beside the listing that has it.
MANIFEST_POINTS = """CASE WHEN has_package_json AND engine THEN 20 ELSE 0 END + CASE WHEN has_package_json AND words <> '' THEN 10 ELSE 0 END
    + CASE WHEN has_package_json AND deps THEN 15 ELSE 0 END"""
_WORDS = ("small", "#1")


STRUCTURE = f"""
m AS ({manifest_sql(_WORDS)}),
points AS (SELECT *, template_files - ne AS extra, CASE WHEN template_files = 0 THEN 30 ELSE 0 END + ns * 10
  + CASE WHEN ha THEN 0 ELSE 5 END + CASE WHEN hp THEN 0 ELSE 5 END + CASE WHEN css_files = 0 THEN 15 ELSE 0 END AS lost,
  ne * 25 + CASE WHEN template_files - ne > 0 THEN least((template_files - ne) * 5, 20) ELSE 0 END + nd * 10
  + CASE WHEN has_package_json THEN 15 ELSE 0 END + least(css_files * 3, 15) + least(js_files * 2, 10)
  + CASE WHEN image_files > 0 THEN 5 ELSE 0 END + least(partial_files * 3, 15) + CASE WHEN has_config THEN 10 ELSE 0 END
  + {MANIFEST_POINTS} AS won FROM y LEFT JOIN m USING (full_name)),
st AS (SELECT full_name, CAST(lost AS BIGINT) AS penalty, CAST(greatest(0, least(100, won - lost)) AS BIGINT) AS signal, list_filter(list_concat([
      CASE WHEN ne > 0 THEN 'Found essential Ghost theme files: ' || replace(essential_files, ',', ', ') END,
      CASE WHEN extra > 0 THEN 'Found ' || extra || ' additional .hbs files' END,
      CASE WHEN theme_directories <> '' THEN 'Found theme directories: ' || replace(theme_directories, ',', ', ') END,
      CASE WHEN has_package_json THEN 'Contains package.json' END,
      CASE WHEN has_package_json AND engine THEN 'Specifies Ghost engine version: ' || version END,
      CASE WHEN has_package_json AND words <> '' THEN 'Package.json contains Ghost keywords: ' || words END,
      CASE WHEN has_package_json AND deps THEN 'Contains Ghost-related dependencies' END,
      CASE WHEN css_files > 0 THEN 'Found ' || css_files || ' CSS/SCSS files' END,
      CASE WHEN js_files > 0 THEN 'Found ' || js_files || ' JavaScript files' END,
      CASE WHEN image_files > 0 THEN 'Found ' || image_files || ' image files' END,
      CASE WHEN partial_files > 0 THEN 'Found ' || partial_files || ' partial templates' END,
      CASE WHEN has_config THEN 'Contains Ghost configuration files' END,
      CASE WHEN template_files = 0 THEN 'Structure penalty: No Handlebars (.hbs) files found' END],
    CASE WHEN suspicious <> '' THEN list_transform(string_split(suspicious, ';'), lambda x: 'Structure penalty: ' || x) ELSE [] END,
    [CASE WHEN NOT (ha AND hp) THEN 'Structure penalty: Missing essential directories: ' ||
        concat_ws(', ', CASE WHEN NOT ha THEN 'assets' END, CASE WHEN NOT hp THEN 'partials' END) END,
      CASE WHEN css_files = 0 THEN 'Structure penalty: No CSS/SCSS files found' END]), lambda x: x IS NOT NULL) AS lines FROM points)"""

#: The lines about a repository without a listing.
_BARE = """['Structure penalty: No Handlebars (.hbs) files found', 'Structure penalty: Missing essential directories: assets, partials',
  'Structure penalty: No CSS/SCSS files found']"""

CTE = f"""
WITH docs AS ({S.DOCUMENT_REPOS_SQL}),
d AS (SELECT *, {_topics(DOMAIN)} AS dom, {_topics(THEME)} AS thm, lower(name || ' ' || coalesce(description, '')) AS label,
             trim(description, {_BLANKS}) AS short FROM docs),
s AS (SELECT *,
  least(100, CASE WHEN len(dom) > 0 THEN 60 ELSE 0 END + least(len(thm) * 15, 40)
             + CASE WHEN len(dom) > 0 AND len(thm) > 0 THEN 10 ELSE 0 END) AS topic_signal,
  CASE WHEN t = '' THEN 0 ELSE least(100, CASE WHEN {has_any('t', DOMAIN)} THEN 50 ELSE 0 END
    + least({how_many('t', THEME)} * 8, 30) + CASE WHEN {has_any('t', ('install', 'setup', 'download'))} THEN 15 ELSE 0 END
    + CASE WHEN {has_any('t', ('demo', 'preview', 'live'))} THEN 10 ELSE 0 END
    + CASE WHEN {has_any('t', ('![', '<img'))} THEN 5 ELSE 0 END) END AS text_signal,
  CASE WHEN archived THEN 60 ELSE 0 END + CASE WHEN pushed_at < TIMESTAMP '2022-01-01' THEN 25 ELSE 0 END
    + CASE WHEN stars < 3 THEN 20 WHEN stars < 10 THEN 10 ELSE 0 END + {how_many('lower(name)', NON_THEME_WORDS)} * 8
    + {how_many('label', PENALTY)} * 12 + {how_many('t', PENALTY)} * 6
    + CASE WHEN {has_any('t', ('work in progress', 'wip'))} THEN 15 ELSE 0 END
    + CASE WHEN {has_any('t', ('not maintained', 'deprecated'))} THEN 25 ELSE 0 END
    + CASE WHEN {has_any('t', ('personal project', 'learning'))} THEN 10 ELSE 0 END
    + CASE WHEN fork THEN 15 ELSE 0 END + CASE WHEN short = '' THEN 8 ELSE 0 END
    + CASE WHEN description <> '' AND length(short) < 20 THEN 5 ELSE 0 END AS penalty_signal
  FROM d),
{LISTED.replace('WITH', '', 1)},
{STRUCTURE},
w AS (SELECT s.*, coalesce(lines, {_BARE}) AS lines, CAST(greatest(0, least(100, floor(topic_signal::DOUBLE * 0.4::DOUBLE + text_signal::DOUBLE * 0.3::DOUBLE
        + coalesce(signal, 0)::DOUBLE * 0.25::DOUBLE - penalty_signal::DOUBLE * 0.05::DOUBLE + 0.5::DOUBLE))) AS INTEGER) AS score FROM s LEFT JOIN st ON st.full_name = 'r/' || doc_id),
c AS (SELECT *, CASE WHEN score >= 75 THEN 'high' WHEN score >= 50 THEN 'medium' ELSE 'low' END AS confidence FROM w)
"""


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return S.document_repos(spark, folder)


@query("has_any_topic", f"{CTE} SELECT doc_id, len(dom) > 0 AS found FROM d")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select("doc_id", has_any_topic("topics", DOMAIN).alias("found"))


@query("topic_signal", f"{CTE} SELECT doc_id, CAST(topic_signal AS INTEGER) AS topic_signal FROM s")
def _(spark: SparkSession, folder: str) -> DataFrame:
    docs = C.with_search_text(_docs(spark, folder), PROFILE)
    return docs.select("doc_id", C.topic_signal().alias("topic_signal"))


@query("text_signal", f"{CTE} SELECT doc_id, CAST(text_signal AS INTEGER) AS text_signal FROM s")
def text_signal(spark: SparkSession, folder: str) -> DataFrame:
    docs = C.with_search_text(_docs(spark, folder), PROFILE)
    return docs.select("doc_id", C.text_signal(PROFILE).alias("text_signal"))


@query("penalty_signal", f"{CTE} SELECT doc_id, CAST(penalty_signal AS INTEGER) AS penalty_signal FROM s")
def _(spark: SparkSession, folder: str) -> DataFrame:
    docs = C.with_search_text(_docs(spark, folder), PROFILE)
    return docs.select("doc_id", C.penalty_signal(AS_OF, PROFILE).alias("penalty_signal"))


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    """Each document with the listing of the order and the manifest of the part that have its number."""
    docs = _docs(spark, folder)
    names = docs.select(F.col("full_name").alias("_name"), F.concat(F.lit("r/"), "doc_id").alias("_number"))

    def of_documents(table: DataFrame) -> DataFrame:
        return table.join(names, F.col("full_name") == F.col("_number")).withColumn("full_name", F.col("_name")).drop("_name", "_number")

    features = X.structure_features(of_documents(S.listing(spark, folder)))
    manifests = X.manifest_features(of_documents(S.manifests(spark, folder)), domain_keywords=_WORDS)
    return C.classify(X.with_structure(docs, features, manifests), AS_OF, PROFILE)


@query("weighted_score", f"{CTE} SELECT doc_id, score FROM c")
def weighted_score(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).select("doc_id", "score")


@query("confidence_bucket", f"{CTE} SELECT confidence, count(*) AS docs, CAST(sum(score) AS BIGINT) AS total FROM c GROUP BY confidence")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).groupBy("confidence").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("score").alias("total")
    )


@query("score_gate", f"{CTE} SELECT doc_id, score, confidence FROM c WHERE score >= 40")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return C.score_gate(_scored(spark, folder), 40).select("doc_id", "score", "confidence")


def _reason(prefix: str, text: str, where: str, more: str = "") -> str:
    return f"CASE WHEN {where} THEN '{prefix}: {text}'{' || ' + more if more else ''} END"


_FIVE = "array_to_string(list_slice(string_split(" + _join("t", THEME) + ", ', '), 1, 5), ', ')"
_REASONS = ", ".join(
    [
        _reason("Topics", "Found Ghost-specific topics: ", "len(dom) > 0", "array_to_string(dom, ', ')"),
        _reason("Topics", "Found theme-related topics: ", "len(thm) > 0", "array_to_string(thm, ', ')"),
        _reason("Topics", "Multiple relevant topic categories found", "len(dom) > 0 AND len(thm) > 0"),
        _reason("README", "No README found", "t = ''"),
        _reason("README", "README mentions Ghost: ", has_any("t", DOMAIN), _join("t", DOMAIN)),
        _reason("README", "README contains theme keywords: ", has_any("t", THEME), _FIVE),
        _reason("README", "Contains installation/setup instructions", has_any("t", ("install", "setup", "download"))),
        _reason("README", "Contains demo/preview links", has_any("t", ("demo", "preview", "live"))),
        _reason("README", "Contains images/screenshots", has_any("t", ("![", "<img"))),
        "array_to_string(list_transform(lines, lambda x: 'Structure: ' || x), '|')",
        _reason("Penalty", "Repository is archived (major penalty)", "archived"),
        _reason("Penalty", "No activity since ", "pushed_at < TIMESTAMP '2022-01-01'", "strftime(pushed_at, '%a %b %d %Y')"),
        "CASE WHEN stars < 3 THEN 'Penalty: Very low star count: ' || stars WHEN stars < 10 THEN 'Penalty: Low star count: ' || stars END",
        _reason("Penalty", "Repository name suggests non-theme: ", has_any("lower(name)", NON_THEME_WORDS), _join("lower(name)", NON_THEME_WORDS)),
        _reason("Penalty", "Contains penalty keywords: ", has_any("label", PENALTY), _join("label", PENALTY)),
        _reason("Penalty", "README contains penalty keywords: ", has_any("t", PENALTY), _join("t", PENALTY)),
        _reason("Penalty", "README indicates work in progress", has_any("t", ("work in progress", "wip"))),
        _reason("Penalty", "README indicates project is not maintained", has_any("t", ("not maintained", "deprecated"))),
        _reason("Penalty", "README indicates personal/learning project", has_any("t", ("personal project", "learning"))),
        _reason("Penalty", "Repository is a fork", "fork"),
        _reason("Penalty", "No repository description provided", "short = ''"),
        _reason("Penalty", "Very short repository description", "description <> '' AND length(short) < 20"),
    ]
)


@query("reasoning", f"{CTE} SELECT doc_id, concat_ws('|', {_REASONS}) AS reasoning FROM c")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).select("doc_id", F.array_join("reasoning", "|").alias("reasoning"))


# ---- structure -------------------------------------------------------------
@query(
    "structure_features",
    f"""{LISTED} SELECT full_name, template_files, essential_files, theme_directories, has_package_json, has_config,
          css_files, js_files, image_files, partial_files, suspicious FROM y""",
)
def structure_features(spark: SparkSession, folder: str) -> DataFrame:
    found = X.structure_features(S.listing(spark, folder))
    lists = {c: F.array_join(c, ",") for c in ("essential_files", "theme_directories")}
    return found.withColumns({**lists, "suspicious": F.array_join("suspicious", ";")})


def _listed_with_manifests(spark: SparkSession, folder: str) -> DataFrame:
    features = X.structure_features(S.listing(spark, folder))
    manifests = X.manifest_features(S.manifests(spark, folder), domain_keywords=_WORDS)
    return X.with_structure(features.select("full_name"), features, manifests)


@query("structure_reasons", f"{LISTED}, {STRUCTURE} SELECT full_name, array_to_string(lines, '; ') AS reasons FROM st")
def structure_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """All lines about listing and manifest, for listings of every kind."""
    return _listed_with_manifests(spark, folder).select("full_name", F.concat_ws("; ", *X.structure_reasons("Ghost")).alias("reasons"))


@query("structure_signal", f"{LISTED}, {STRUCTURE} SELECT full_name, penalty, signal FROM st")
def structure_signal(spark: SparkSession, folder: str) -> DataFrame:
    return _listed_with_manifests(spark, folder).select(
        "full_name",
        X.structure_penalty().cast("long").alias("penalty"),
        X.structure_signal().cast("long").alias("signal"),
    )


@query(
    "manifest_features",
    """SELECT 'r/' || p_partkey AS full_name, CASE WHEN p_size > 30 THEN '>=' || p_size END AS engine_version,
         CASE WHEN p_size > 3 THEN concat_ws(',', CASE WHEN contains(lower(p_type), 'small') THEN p_type END,
           CASE WHEN contains(lower(p_brand), '#1') THEN p_brand END) ELSE '' END AS manifest_keywords,
         p_size > 3 AND p_size < 20 AS has_dependencies FROM part""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = X.manifest_features(S.manifests(spark, folder), domain_keywords=("small", "#1"))
    return found.select(
        "full_name", "engine_version", F.array_join("manifest_keywords", ",").alias("manifest_keywords"), "has_dependencies"
    )
