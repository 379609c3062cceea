"""Hashes, keys, run ids and the extractor's input text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.sql import literal
from newsloom.functions.text import WS_CHARS, collapse_ws, js_trim
from newsloom.specs import ENTRY_KEY_PREFIX


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_content(title: Column | str, body: Column | str) -> Column:
    """Title and body as one lower-case text with single spaces."""
    joined = F.concat(js_trim(title), F.lit("\u0001"), js_trim(body))
    return F.lower(collapse_ws(joined))


def content_hash(title: Column | str, body: Column | str) -> Column:
    return F.md5(normalize_content(title, body))


def entry_key(
    canonical: Column | str, hash_: Column | str, prefix: str = ENTRY_KEY_PREFIX
) -> Column:
    """Identity of a news row: the URL together with what it says. Null if either is null."""
    return F.md5(F.concat(F.lit(prefix + ":"), _col(canonical), F.lit(":"), _col(hash_)))


def link_list_hash(links: str) -> Column:
    """Hash of a page's links that does not depend on their order; repeats count.

    The links of one page sit in one row, so no rows are brought together."""
    trimmed = f"transform({links}, one -> btrim(one, {literal(WS_CHARS)}))"
    return F.md5(F.array_join(F.array_sort(F.expr(trimmed)), "\n"))


def _utc(ts: Column | str, shape: str) -> Column:
    """A time in UTC, whatever the time zone of the session."""
    return F.date_format(F.to_utc_timestamp(_col(ts), F.current_timezone()), shape)


def run_id(ts: Column | str) -> Column:
    """Run id of a start time: its ISO text with ``:`` and ``.`` as ``-``."""
    return _utc(ts, "yyyy-MM-dd'T'HH-mm-ss-SSS'Z'")


def run_date(ts: Column | str) -> Column:
    return _utc(ts, "yyyy-MM-dd")


def iso_time(ts: Column | str) -> Column:
    return _utc(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def extract_payload(url: Column | str, title: Column | str, body: Column | str) -> Column:
    """JSON text handed to the extractor."""
    return F.to_json(
        F.struct(
            _col(url).alias("sourceUrl"),
            _col(title).alias("title"),
            _col(body).alias("bodyExcerpt"),
        ),
        {"ignoreNullFields": "false"},
    )
