"""Options of a run: a settings file, environment-like values and their types."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from quillsieve.functions.wordlists import OPT_IN_SOURCES, SOURCES

TRUE = {"1", "true", "yes", "y", "on"}


def parse_settings(content: str) -> dict[str, str]:
    """``KEY=value`` lines; blank lines, comments and lines without ``=`` are skipped, a quote at
    either end is dropped, and the first of equal keys counts."""
    found: dict[str, str] = {}
    for line in content.splitlines():
        line = line.strip()
        key, equals, value = line.partition("=")
        if equals and key and not line.startswith("#"):
            found.setdefault(key, re.sub(r"^[\"']|[\"']$", "", value.strip()))
    return found


def split_values(value: str) -> list[str]:
    """Parts between commas, semicolons and line ends, without blank ones."""
    return [x.strip() for x in re.split(r"[\n,;]+", value) if x.strip()]


def positive(value: str | None, default: int) -> int:
    """The integer that a value starts with, if it is positive; else the default."""
    m = re.match(r"\s*[+-]?\d+", value or "")
    return int(m[0]) if m and int(m[0]) > 0 else default


def boolean(value: str | None, default: bool = False) -> bool:
    value = (value or "").strip()
    return value.lower() in TRUE if value else default


def skip_titles(value: str) -> list[str]:
    """Normalised titles between line ends and double bars."""
    norm = lambda t: re.sub(r"[^a-z0-9]+", " ", t.lower().replace("&", " and ")).strip()
    return [t for t in map(norm, re.split(r"\r?\n|\|\|", value)) if t]


@dataclass(frozen=True)
class Options:
    sources: list[str] = field(default_factory=list)
    extra_urls: list[str] = field(default_factory=list)
    cities: list[str] = field(default_factory=list)
    max_per_source: int = 300
    max_pages: int = 15
    max_items: int = 30
    lookback_days: int = 20
    start: str | None = None
    end: str | None = None
    audit: bool = True
    skip_titles: list[str] = field(default_factory=list)
    api_url: str = ""
    api_key: str = ""
    resend: bool = False
    dry_run: bool = False
    opt_in: bool = False
    allow_opt_in_push: bool = False

    @staticmethod
    def read(env: Mapping[str, str]) -> Options:
        """Options from environment-like values. Sources: those given, else the built-in ones."""
        get = lambda k: (env.get(k) or "").strip()
        opt_in = boolean(get("ENABLE_NOIDA_CITY"))
        given = split_values(get("SOURCE_URLS"))
        return Options(
            sources=list(dict.fromkeys(given or SOURCES + (OPT_IN_SOURCES if opt_in else []))),
            extra_urls=split_values(get("EXTRA_ARTICLE_URLS")),
            cities=[c.lower() for c in split_values(get("TARGET_CITY_CODES"))],
            max_per_source=positive(get("MAX_ITEMS_PER_SOURCE"), 300),
            max_pages=positive(get("MAX_PAGES_PER_SOURCE"), 15),
            max_items=positive(get("MAX_ITEMS_PER_RUN"), 30),
            lookback_days=positive(get("DEFAULT_LOOKBACK_DAYS"), 20),
            start=get("BACKFILL_FROM") or None,
            end=get("BACKFILL_TO") or None,
            audit=boolean(get("MISSED_NEWS_AUDIT"), True),
            skip_titles=skip_titles(get("SKIP_TITLES")),
            api_url=get("APP_API_URL"),
            api_key=get("APP_API_KEY"),
            resend=boolean(get("RESEND_BACKFILL")),
            dry_run=boolean(get("DRY_RUN")),
            opt_in=opt_in,
            allow_opt_in_push=boolean(get("ALLOW_NOIDA_API")),
        )
