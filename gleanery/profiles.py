"""Named parameter sets: keywords, weights, thresholds, report labels.

The lists in this file are fixed values: they have to be exactly these words
and numbers for scores, labels and reports to come out right.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---- fixed values: enumerations -------------------------------------------
CATEGORIES = ("Theme", "Tool", "Starter", "Official")
CONFIDENCES = ("high", "medium", "low")

# ---- fixed values: domain topics of the catalog ---------------------------
DOMAIN_TOPICS = (
    "ghost-theme",
    "ghost-cms",
    "ghostcms",
    "ghost-blog",
    "ghost-template",
    "ghost",
)
OFFICIAL_OWNER = "tryghost"

# ---- fixed values: words in a repository name that hint at a non-theme ----
NON_THEME_WORDS = (
    "api", "backend", "server", "client", "app", "website", "site",
    "tool", "utility", "script", "bot", "crawler", "scraper",
    "generator", "builder", "framework", "library", "plugin",
    "extension", "addon", "module", "package", "sdk",
)

# ---- fixed values: file names looked for in a repository listing ----------
ESSENTIAL_FILES = ("index.hbs", "post.hbs", "default.hbs")
THEME_DIRECTORIES = ("partials", "assets", "locales")
REQUIRED_DIRECTORIES = ("assets", "partials")
BUILD_TOOLS = ("webpack.config.js", "rollup.config.js", "vite.config.js", "gulpfile.js")
FRAMEWORKS = ("next.config.js", "nuxt.config.js", "angular.json", "vue.config.js")
SERVER_FILES = ("server.js", "app.js", "index.js", "main.py", "requirements.txt")
DEPENDENCY_WORDS = ("ghost", "handlebars", "hbs")

# ---- fixed values: common ignore patterns and their reasons ---------------
COMMON_IGNORE_PATTERNS = (
    (".*-test$", "Test repository (ends with -test)"),
    ("^test-.*", "Test repository (starts with test-)"),
    (".*-backup$", "Backup repository"),
    (".*-fork$", "Fork repository"),
    ("^demo-.*", "Demo repository"),
    (".*-example$", "Example repository"),
    ("^tmp-.*", "Temporary repository"),
    (".*-deprecated$", "Deprecated repository"),
    ("^archive-.*", "Archived repository"),
    (".*-mirror$", "Mirror repository"),
    (".*-clone$", "Clone repository"),
    (".*-copy$", "Copy repository"),
)

# ---- fixed values: report category headings, in report order --------------
CATEGORY_HEADINGS = (
    ("Official", "OFFICIAL / TRYGHOST THEMES"),
    ("Theme", "HIGHLY POPULAR COMMUNITY THEMES"),
    ("Tool", "TOOLS & RESOURCES"),
    ("Starter", "STARTER & DEVELOPMENT THEMES"),
)


@dataclass(frozen=True)
class UseCase:
    """One labelled report list: who belongs in it and how many are shown."""

    label: str
    top: int
    tag_parts: tuple[str, ...] = ()
    tags: tuple[str, ...] = ()
    description_parts: tuple[str, ...] = ()
    names: tuple[str, ...] = ()


# ---- fixed values: use-case lists -----------------------------------------
USE_CASES = (
    UseCase(
        "Newsletter Themes", 5,
        tag_parts=("newsletter",),
        description_parts=("newsletter",),
        names=("Dawn", "Edition", "Journal", "Bulletin"),
    ),
    UseCase(
        "Magazine / Publication Themes", 7,
        tags=("magazine", "publication", "editorial"),
        description_parts=("magazine",),
        names=("London", "Massively", "Editorial", "Simply", "Mapache"),
    ),
    UseCase(
        "Minimalist / Clean Themes", 5,
        tags=("minimal", "clean", "simple"),
        description_parts=("minimal",),
        names=("Alto", "MNML", "Kaldorei", "Caffeine"),
    ),
    UseCase(
        "Portfolio / Creative Showcase", 4,
        tags=("portfolio", "creative", "showcase"),
        description_parts=("portfolio",),
        names=("Edge", "Prometheus"),
    ),
    UseCase(
        "Specialized", 5,
        tags=("podcast", "documentation", "course"),
        names=("Wave", "Ease", "X-Learn"),
    ),
)

# ---- fixed values: feature words of the web-table extraction --------------
WEB_BASE_TAG = "ghost-theme"
WEB_FEATURE_TAGS = (
    ("dark-mode", ("dark mode", "dark-mode")),
    ("responsive", ("responsive",)),
    ("minimal", ("minimal",)),
    ("magazine", ("magazine",)),
    ("newsletter", ("newsletter",)),
    ("podcast", ("podcast",)),
    ("portfolio", ("portfolio",)),
    ("handlebars", ("handlebars",)),
)

# ---- fixed values: page checks --------------------------------------------
PAGE_PATTERNS = (
    ("title", r"(?i)<title>.*Not Updated Recently.*</title>", 'Title with "Not Updated Recently"'),
    ("warning", r"(?i)These items have not been updated", "Warning message"),
    ("back_link", r'(?i)href="index\.html"', "Link back to main page"),
    ("headers", r"(?i)<h2>.*THEMES.*</h2>", "Category headers"),
)


@dataclass(frozen=True)
class Weights:
    topics: float
    readme: float
    structure: float
    penalties: float

    def __post_init__(self):
        parts = (self.topics, self.readme, self.structure, self.penalties)
        if any(not 0 <= p <= 1 for p in parts):
            raise ValueError("weights must be numbers between 0 and 1")
        if abs(sum(parts) - 1.0) > 0.001:
            raise ValueError(f"weights must sum to 1.0, got {sum(parts)}")


@dataclass(frozen=True)
class Thresholds:
    high: float
    medium: float

    def __post_init__(self):
        if any(not 0 <= t <= 100 for t in (self.high, self.medium)):
            raise ValueError("thresholds must be numbers between 0 and 100")
        if self.high <= self.medium:
            raise ValueError("thresholds must be in descending order: high > medium")


@dataclass(frozen=True)
class ScoringProfile:
    """Everything the scorer needs besides the data."""

    weights: Weights
    thresholds: Thresholds
    domain_keywords: tuple[str, ...]
    theme_keywords: tuple[str, ...]
    penalty_keywords: tuple[str, ...]
    domain_label: str = "Ghost"
    min_score: int = 50
    non_theme_words: tuple[str, ...] = field(default=NON_THEME_WORDS)


# ---- fixed values: the library's own scoring set --------------------------
LIBRARY_PROFILE = ScoringProfile(
    weights=Weights(topics=0.4, readme=0.3, structure=0.25, penalties=0.05),
    thresholds=Thresholds(high=75, medium=50),
    domain_keywords=(
        "ghost", "ghost-theme", "ghost-cms", "ghostcms", "ghost-blog", "ghost-template",
    ),
    theme_keywords=(
        "theme", "template", "handlebars", "hbs", "blog", "cms", "publishing",
        "responsive", "minimal", "clean", "modern",
    ),
    penalty_keywords=(
        "fork", "clone", "copy", "demo", "example", "test", "playground",
        "learning", "tutorial",
    ),
)

# ---- fixed values: the scoring set of the full update run -----------------
UPDATE_PROFILE = ScoringProfile(
    weights=Weights(topics=0.4, readme=0.3, structure=0.2, penalties=0.1),
    thresholds=Thresholds(high=80, medium=60),
    domain_keywords=(
        "ghost", "ghost-theme", "ghost-cms", "ghostcms", "ghost-blog", "ghost-template",
    ),
    theme_keywords=(
        "theme", "template", "handlebars", "hbs", "blog", "website", "cms",
    ),
    penalty_keywords=("fork", "archived", "deprecated", "unmaintained"),
)

STALE_THRESHOLD_MONTHS = 12


def check_stale_threshold(months: int) -> int:
    if not isinstance(months, int) or months <= 0:
        raise ValueError("threshold months must be a positive integer")
    return months
