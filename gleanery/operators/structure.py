"""Features of a repository's file listing and its manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.columns import contains_any, parsed_json, points, total
from gleanery.profiles import (
    BUILD_TOOLS,
    DEPENDENCY_WORDS,
    ESSENTIAL_FILES,
    FRAMEWORKS,
    REQUIRED_DIRECTORIES,
    SERVER_FILES,
    THEME_DIRECTORIES,
)

_WATCHED_FILES = (*BUILD_TOOLS, *FRAMEWORKS, *SERVER_FILES)
_SUSPICIOUS = (
    ("Build tools present: ", BUILD_TOOLS),
    ("Framework files present: ", FRAMEWORKS),
    ("Server-side files present: ", SERVER_FILES),
)
# Each name looked for has one bit: as a file, as a directory, or as either.
_BITS = {
    name: (bit, where)
    for bit, (name, where) in enumerate(
        [(n, "_is_file") for n in (*ESSENTIAL_FILES, "package.json")]
        + [(n, "_is_dir") for n in THEME_DIRECTORIES]
        + [(n, "(_is_file OR _is_dir)") for n in _WATCHED_FILES]
    )
}
_CONFIG_BIT = len(_BITS)


def structure_features(contents: DataFrame, *, config_word: str = "ghost") -> DataFrame:
    """FEA-1 / AGG-5..7 / CLS-5: one row of counters and flags per repository.

    ``contents`` has full_name, path (whole, from the root), name and type.  The
    names found are bits of one number and the rest are counters, so the hash
    aggregate has a small buffer of fixed size, combines before the one shuffle,
    and a repository with any number of files costs the same.
    """
    entries = contents.select(
        "full_name",
        "type",
        F.lower("name").alias("_name"),
        F.expr("left(path, length(path) - length(substring_index(path, '/', -1)) - 1)").alias("_parent"),
    ).select(
        "full_name",
        "_name",
        F.expr("_parent = '' AND type = 'dir'").alias("_is_dir"),
        F.expr("_parent = '' AND type <> 'dir'").alias("_is_file"),
        F.expr("_parent = 'partials'").alias("_is_partial"),
        F.expr("_parent = 'assets' OR (startswith(_parent, 'assets/') AND NOT contains(substr(_parent, 8), '/'))").alias("_in_assets"),
        F.expr("substring_index(_name, '.', -1)").alias("_ending"),
        F.expr("endswith(_name, '.hbs')").alias("_is_template"),
    )
    named = " ".join(f"WHEN '{n}' THEN if({where}, {1 << bit}, 0)" for n, (bit, where) in _BITS.items())
    config = F.col("_is_file") & F.contains("_name", F.lit(config_word)) & F.expr(
        "endswith(_name, '.json') OR endswith(_name, '.js')"
    )

    def assets(*endings: str) -> Column:
        dotted = ", ".join(f"'{e}'" for e in endings)
        return F.expr(f"count_if(_in_assets AND _ending IN ({dotted}) AND contains(_name, '.'))")

    return entries.groupBy("full_name").agg(
        F.bit_or(
            F.expr(f"CASE _name {named} ELSE 0 END") + F.when(config, 1 << _CONFIG_BIT).otherwise(0)
        ).alias("_found"),
        F.expr("count_if(_is_file AND _is_template)").alias("template_files"),
        assets("css", "scss", "sass").alias("_css"),
        assets("js", "ts").alias("_js"),
        assets("png", "jpg", "jpeg", "gif", "svg", "webp", "ico").alias("_images"),
        F.expr("count_if(_is_partial AND _is_template)").alias("_partials"),
        F.expr(
            "count_if((_is_file OR _is_dir) AND (contains(_name, 'doc') OR contains(_name, 'readme') OR endswith(_name, '.md')))"
        ).alias("doc_files"),
    ).select("full_name", *_named_features())


def _has(bit: int) -> Column:
    return F.getbit("_found", F.lit(bit)) == 1


def _names(names: tuple[str, ...]) -> Column:
    """The names found, in list order."""
    return F.array_compact(F.array(*[F.when(_has(_BITS[n][0]), F.lit(n)) for n in names]))


def _named_features() -> list[Column]:
    has_assets, has_partials = _has(_BITS["assets"][0]), _has(_BITS["partials"][0])
    suspicious = [
        F.when(F.size(_names(names)) > 0, F.concat(F.lit(text), F.array_join(_names(names), ", ")))
        for text, names in _SUSPICIOUS
    ] + [
        F.when(F.col("doc_files") > 5, F.concat(F.lit("Many documentation files: "), F.col("doc_files")))
    ]
    return [
        F.col("template_files"),
        _names(ESSENTIAL_FILES).alias("essential_files"),
        _names(THEME_DIRECTORIES).alias("theme_directories"),
        _has(_BITS["package.json"][0]).alias("has_package_json"),
        _has(_CONFIG_BIT).alias("has_config"),
        F.when(has_assets, F.col("_css")).otherwise(0).alias("css_files"),
        F.when(has_assets, F.col("_js")).otherwise(0).alias("js_files"),
        F.when(has_assets, F.col("_images")).otherwise(0).alias("image_files"),
        F.when(has_partials, F.col("_partials")).otherwise(0).alias("partial_files"),
        F.array_compact(F.array(*suspicious)).alias("suspicious"),
    ]


def manifest_features(
    manifests: DataFrame, *, domain_keywords: tuple[str, ...], engine: str = "ghost"
) -> DataFrame:
    """CLS-6: engine, matching keywords and matching dependencies of a manifest.

    ``manifests`` has full_name and json; unreadable JSON gives no features.
    """
    parsed = manifests.select("full_name", parsed_json("json").alias("_v"))

    def names(path: str) -> Column:
        deps = F.try_variant_get("_v", path, "map<string,variant>")
        return F.coalesce(F.map_keys(deps), F.array().cast("array<string>"))

    keywords = F.coalesce(
        F.try_variant_get("_v", "$.keywords", "array<string>"), F.array().cast("array<string>")
    )
    version = F.try_variant_get("_v", f"$.engines.{engine}", "string")
    depends = F.concat(names("$.dependencies"), names("$.devDependencies"), names("$.peerDependencies"))
    return parsed.select(
        "full_name",
        F.nullif(version, F.lit("")).alias("engine_version"),
        F.filter(keywords, lambda k: contains_any(F.lower(k), domain_keywords)).alias("manifest_keywords"),
        F.coalesce(
            F.exists(depends, lambda d: contains_any(F.lower(d), DEPENDENCY_WORDS)), F.lit(False)
        ).alias("has_dependencies"),
    )




def with_structure(
    repos: DataFrame, features: DataFrame, manifests: DataFrame | None = None
) -> DataFrame:
    """Attach listing and manifest features; a repository without a listing has none."""
    found = repos.join(features, "full_name", "left")
    empty = F.array().cast("array<string>")
    if manifests is None:
        found = (
            found.withColumn("engine_version", F.lit(None).cast("string"))
            .withColumn("manifest_keywords", empty)
            .withColumn("has_dependencies", F.lit(False))
        )
    else:
        found = found.join(manifests, "full_name", "left")
    defaults = {
        **{c: F.lit(0) for c in ("template_files", "css_files", "js_files", "image_files", "partial_files")},
        **{c: empty for c in ("essential_files", "theme_directories", "suspicious", "manifest_keywords")},
        **{c: F.lit(False) for c in ("has_package_json", "has_config", "has_dependencies")},
    }
    return found.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})


def missing_directories() -> Column:
    return F.array_compact(
        F.array(
            *[F.when(~F.array_contains("theme_directories", d), F.lit(d)) for d in REQUIRED_DIRECTORIES]
        )
    )


def structure_penalty() -> Column:
    """CLS-4."""
    return total(
        [
            points(F.col("template_files") == 0, 30),
            F.size("suspicious") * 10,
            F.size(missing_directories()) * 5,
            points(F.col("css_files") == 0, 15),
        ]
    )


def structure_points() -> Column:
    """CLS-3 before the penalties."""
    has_manifest = F.col("has_package_json")
    extra = F.col("template_files") - F.size("essential_files")
    return total(
        [
            F.size("essential_files") * 25,
            points(extra > 0, F.least(extra * 5, F.lit(20))),
            F.size("theme_directories") * 10,
            points(has_manifest, 15),
            points(has_manifest & F.col("engine_version").isNotNull(), 20),
            points(has_manifest & (F.size("manifest_keywords") > 0), 10),
            points(has_manifest & F.col("has_dependencies"), 15),
            F.least(F.col("css_files") * 3, F.lit(15)),
            F.least(F.col("js_files") * 2, F.lit(10)),
            points(F.col("image_files") > 0, 5),
            F.least(F.col("partial_files") * 3, F.lit(15)),
            points(F.col("has_config"), 10),
        ]
    )


def structure_signal() -> Column:
    """CLS-3."""
    return F.least(F.greatest(structure_points() - structure_penalty(), F.lit(0)), F.lit(100))


def structure_reasons(domain_label: str) -> list[Column]:
    """The explanations of CLS-3 and CLS-4 in order; null where one does not apply."""
    has_manifest = F.col("has_package_json")
    extra = F.col("template_files") - F.size("essential_files")

    def listed(text: str, names: str) -> Column:
        return F.when(F.size(names) > 0, F.concat(F.lit(text), F.array_join(names, ", ")))

    def counted(n: Column | str, text: str) -> Column:
        n = F.col(n) if isinstance(n, str) else n
        return F.when(n > 0, F.concat(F.lit("Found "), n, F.lit(text)))

    penalty = "Structure penalty: "
    missing = missing_directories()
    return [
        listed(f"Found essential {domain_label} theme files: ", "essential_files"),
        counted(extra, " additional .hbs files"),
        listed("Found theme directories: ", "theme_directories"),
        F.when(has_manifest, F.lit("Contains package.json")),
        F.when(
            has_manifest & F.col("engine_version").isNotNull(),
            F.concat(F.lit(f"Specifies {domain_label} engine version: "), F.col("engine_version")),
        ),
        F.when(has_manifest, listed(f"Package.json contains {domain_label} keywords: ", "manifest_keywords")),
        F.when(has_manifest & F.col("has_dependencies"), F.lit(f"Contains {domain_label}-related dependencies")),
        counted("css_files", " CSS/SCSS files"),
        counted("js_files", " JavaScript files"),
        counted("image_files", " image files"),
        counted("partial_files", " partial templates"),
        F.when(F.col("has_config"), F.lit(f"Contains {domain_label} configuration files")),
        F.when(F.col("template_files") == 0, F.lit(penalty + "No Handlebars (.hbs) files found")),
        *[F.concat(F.lit(penalty), F.get("suspicious", F.lit(i))) for i in range(len(_SUSPICIOUS) + 1)],
        F.when(
            F.size(missing) > 0,
            F.concat(F.lit(penalty + "Missing essential directories: "), F.array_join(missing, ", ")),
        ),
        F.when(F.col("css_files") == 0, F.lit(penalty + "No CSS/SCSS files found")),
    ]
