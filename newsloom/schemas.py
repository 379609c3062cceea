"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

PAGES = "url string, html string, fetched_at timestamp, fetch_error string"
SNAPSHOTS = "url string, attempt int, snapshot string"
SEEDS = (
    "source_id string, source_ord int, section_id string, section_ord int, "
    "section_url string, priority string, fetch_mode string"
)
NEWS = (
    "entry_key string, source_url string, source_id string, startup_name string, "
    "startup_website string, description string, news_summary string, "
    "entry_status string, discovered_at timestamp, content_hash string"
)
LOGS = (
    "run_id string, source_id string, event string, url string, reason string, "
    "entry_key string, meta string, logged_at timestamp"
)
SECTION_SNAPSHOT = "section_url string, content_hash string, checked_at timestamp"
URL_INDEX = (
    "url string, content_hash string, last_seen_at timestamp, last_run_id string, "
    "extraction_complete boolean"
)
EXTRACTION = (
    "struct<is_relevant boolean, startup_name string, startup_website string, "
    "description string, news_summary string, extraction_failed boolean>"
)

# Column order of the flat files.
NEWS_COLUMNS = (
    "entry_key", "source_url", "source_id", "startup_name", "startup_website",
    "description", "news_summary", "entry_status", "discovered_at",
)
LOG_COLUMNS = (
    "run_id", "source_id", "event", "url", "reason", "entry_key", "meta", "logged_at",
)

# What may be stored.
ENTRY_STATUSES = ("new", "updated")
LOG_EVENTS = ("new", "updated", "skipped", "not_relevant", "error", "run_complete")

# The counters of a source or a run, ours and as named in a summary.
STATS = (
    ("sections_checked", "sectionsChecked"),
    ("sections_skipped", "sectionsSkipped"),
    ("articles_scanned", "articlesScanned"),
    ("new", "new"),
    ("updated", "updated"),
    ("skipped", "skipped"),
    ("not_relevant", "notRelevant"),
    ("errors", "errors"),
    ("duration_ms", "durationMs"),
)


def struct_type(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
