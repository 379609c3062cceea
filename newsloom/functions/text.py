"""Text expressions: whitespace, HTML to text, cuts, word counts.

The stored hashes and keys depend on JavaScript's idea of white space, which is
wider than Java's ``\\s`` (ASCII only) and than ``trim`` (space only), so the
class is written out once here and used everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.sql import let, literal

# The white space characters of ECMAScript, as plain characters for
# `btrim` and as members of a regex class.
WS_CODES = (
    *range(0x09, 0x0E), 0x20, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF,
)
WS_CHARS = "".join(chr(code) for code in WS_CODES)
WS_MEMBERS = (
    r"\s\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"
)
# One white space character. The outer class, of few ranges, settles most characters
# before the long list is asked; four times as fast on long texts.
WS = rf"[\s\x{{a0}}\x{{1680}}-\x{{feff}}&&[{WS_MEMBERS}]]"

ELLIPSIS = "\u2026"

# The entities decoded after the tags are gone, in this order, so
# that a doubly escaped "&amp;lt;" ends up as "<".
TEXT_ENTITIES = (
    ("&nbsp;", " "),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&#039;", "'"),
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def js_trim(c: Column | str) -> Column:
    """Trim both ends of JavaScript white space."""
    return F.btrim(_col(c), F.lit(WS_CHARS))


def collapse_ws(c: Column | str) -> Column:
    """Replace each run of white space by one space."""
    return F.regexp_replace(_col(c), f"{WS}+", " ")


def is_blank(c: Column | str) -> Column:
    """True for null, empty or white-space-only text."""
    return F.coalesce(F.length(js_trim(c)) == 0, F.lit(True))


def or_null(c: Column | str) -> Column:
    """Trimmed text, or null when nothing is left."""
    return F.nullif(js_trim(c), F.lit(""))


def html_to_text(c: Column | str) -> Column:
    """Markup to plain text: drop script and style, tags become spaces, decode, collapse, trim."""
    text = _col(c)
    for block in ("script", "style"):
        text = F.regexp_replace(text, f"(?is)<{block}.*?</{block}>", " ")
    text = F.regexp_replace(text, "<[^>]+>", " ")
    for entity, char in TEXT_ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return js_trim(collapse_ws(text))


def truncate_text(c: Column | str, max_chars: int) -> Column:
    """At most ``max_chars`` characters; a cut text ends in an ellipsis."""
    c = _col(c)
    short = F.concat(F.substring(c, 1, max_chars - 1), F.lit(ELLIPSIS))
    return F.when(F.length(c) <= max_chars, c).otherwise(short)


def cut_text(c: Column | str, max_chars: int) -> Column:
    """Hard cut without an ellipsis."""
    return F.substring(_col(c), 1, max_chars)


def count_words(c: Column | str) -> Column:
    """Number of white-space separated words; 0 for blank text, null for null."""
    text = js_trim(c)
    return F.when(text == "", F.lit(0)).otherwise(F.regexp_count(text, F.lit(f"{WS}+")) + 1)


def fence_sql(c: str) -> str:
    ws = literal(WS_CHARS)
    opening = literal(f"(?i)\\A```(?:json)?{WS}*")
    inner = f"regexp_replace(regexp_replace(txt, {opening}, ''), {literal('```' + chr(92) + 'z')}, '')"
    return let(
        f"btrim({c}, {ws})",
        "txt",
        f"CASE WHEN startswith(txt, '```') THEN btrim({inner}, {ws}) ELSE txt END",
    )


def strip_json_fence(c: str) -> Column:
    """Drop a Markdown code fence around a JSON answer."""
    return F.expr(fence_sql(c))
