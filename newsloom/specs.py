"""What differs between sources, and the settings of a run."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field, replace

# The limits and sizes of ``limited``.
MAX_ITEMS_PER_RUN = 50
MAX_NEW_ROWS_PER_RUN = 20
MAX_SECTIONS_PER_RUN = 10
EXTRACT_MAX_CHARS = 2000
MIN_HTML_CHARS = 500
MIN_SNAPSHOT_BODY_CHARS = 80
MAX_SNAPSHOT_ATTEMPTS = 3

# Fixed value: first part of the text hashed into an entry key; stored keys depend on it.
ENTRY_KEY_PREFIX = "agritech.news"

PRIORITIES = ("high", "medium", "low")


@dataclass(frozen=True)
class Section:
    """A listing page of a source."""

    section_id: str
    url: str
    priority: str = "medium"
    fetch_mode: str = "http"


@dataclass(frozen=True)
class ArticleRule:
    """Which paths are articles: a pattern over the whole path, or prefixes plus depth."""

    excluded_paths: tuple[str, ...] = ("/",)
    blocked_prefixes: tuple[str, ...] = ()
    path_pattern: str | None = None
    path_prefixes: tuple[str, ...] = ()
    min_segments: int = 2
    ignore_case: bool = False


@dataclass(frozen=True)
class Selectors:
    """Where title and body are. A selector is ``tag``, ``.class``, ``tag.class`` or
    ``meta[property="name"]``, descendants split by spaces. The first title
    selector with text and the first body selector with markup win."""

    titles: tuple[str, ...] = ("h1", "title", 'meta[property="og:title"]')
    bodies: tuple[str, ...] = ("article",)


@dataclass(frozen=True)
class PaywallMarkers:
    """Texts of a login wall: any one of ``any_of``, or all of ``all_of``."""

    any_of: tuple[str, ...] = ()
    all_of: tuple[str, ...] = ()


@dataclass(frozen=True)
class SourceSpec:
    """One source. ``host=None`` accepts every host."""

    source_id: str
    article_rule: ArticleRule
    host: str | None = None
    sections: tuple[Section, ...] = ()
    non_article_prefixes: tuple[str, ...] = ()
    selectors: Selectors = field(default_factory=Selectors)
    paywall: PaywallMarkers = field(default_factory=PaywallMarkers)
    kind: str = "html"  # "html" pages or "snapshot" texts
    # optional plug-ins: markup to link texts, and markup to (title, body markup)
    listing_parser: Callable[[str], list[str]] | None = None
    article_parser: Callable[[str], tuple[str, str]] | None = None
    min_body_chars: int = 1
    fresh_only: bool = False  # drop URLs that are already in the news table
    enabled: bool = True

    def __post_init__(self) -> None:
        if self.kind not in ("html", "snapshot"):
            raise ValueError(f"unknown source kind {self.kind!r}")
        for section in self.sections:
            if section.priority not in PRIORITIES:
                raise ValueError(f"unknown priority {section.priority!r}")


@dataclass(frozen=True)
class RunConfig:
    """Identity and limits of one run. Every time is passed in, so that a rerun
    gives the same rows."""

    run_id: str
    run_date: str
    started_at: str
    # limits; None is none. What a limit leaves out is carried over to the next run
    max_items: int | None = None
    max_new_rows: int | None = None
    max_sections: int | None = None
    max_attempts: int | None = None
    # characters of the body that the extractor is given; hashes are of the whole text
    extract_max_chars: int | None = None
    # seconds after which a batch of the extractor is given up
    extract_seconds: float | None = None
    min_html_chars: int = MIN_HTML_CHARS
    entry_key_prefix: str = ENTRY_KEY_PREFIX
    snapshot_fallback: bool = False
    status_mode: str = "index"  # "index": new or updated; "current": always new
    store_tables: bool = True
    store_flat: bool = False

    def __post_init__(self) -> None:
        if not (self.store_tables or self.store_flat):
            raise ValueError("at least one of store_tables and store_flat must be on")
        if self.status_mode not in ("index", "current"):
            raise ValueError(f"unknown status mode {self.status_mode!r}")
        for name in ("max_items", "max_new_rows", "max_sections", "max_attempts"):
            cap = getattr(self, name)
            if cap is not None and cap < 1:
                raise ValueError(f"{name} must be positive or None")

    def max_rows(self, specs: Sequence[SourceSpec]) -> int | None:
        """The most rows a run over these sources can scan; None without a limit."""
        return None if self.max_items is None else self.max_items * len(specs)


def limited(config: RunConfig) -> RunConfig:
    """The settings with the usual limits of a run over sites on the web."""
    return replace(
        config,
        max_items=MAX_ITEMS_PER_RUN,
        max_new_rows=MAX_NEW_ROWS_PER_RUN,
        max_sections=MAX_SECTIONS_PER_RUN,
        max_attempts=MAX_SNAPSHOT_ATTEMPTS,
        extract_max_chars=EXTRACT_MAX_CHARS,
    )


def enabled(specs: Iterable[SourceSpec]) -> list[SourceSpec]:
    """The sources that are switched on, in the given order."""
    return [s for s in specs if s.enabled]
