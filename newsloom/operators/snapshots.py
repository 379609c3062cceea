"""Accessibility snapshots: lines, texts, links, articles, attempts.

A snapshot is a text of indented ``- role "text" url=...`` lines. Reading it in line
order is the same as walking its tree, so no tree is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.functions.sql import all_of, any_of, let, literal
from newsloom.functions.text import WS, WS_CHARS, WS_MEMBERS, is_blank, js_trim
from newsloom.functions.urls import article_sql, canonical_of, parts_sql, snapshot_url_sql
from newsloom.operators.links import by_source
from newsloom.specs import (
    EXTRACT_MAX_CHARS,
    MAX_SNAPSHOT_ATTEMPTS,
    MIN_SNAPSHOT_BODY_CHARS,
    PaywallMarkers,
    SourceSpec,
)

_NODE = literal(rf"\A{WS}*-{WS}+")
_WHOLE_NODE = literal(rf"\A{WS}*-{WS}+[^\n\r\x{{2028}}\x{{2029}}]*\z")
_BREAKS = tuple(literal(chr(code)) for code in (0x0D, 0x2028, 0x2029))
# possessive, so that long texts and many escapes use no stack
_TEXT = literal(rf'StaticText{WS}+"((?:[^"\\]++|\\[^\n\r\x{{2028}}\x{{2029}}])*+)"')
_URL = literal(rf"(?i)\burl=(https?://[^,\]{WS_MEMBERS}]+)")


def lines_sql(snapshot: str) -> str:
    # the start of a line decides; only lines that hold another kind of line break, which
    # may not stand in a node, are looked at as a whole
    odd = any_of(f"contains(ln, {b})" for b in _BREAKS)
    node = f"ln RLIKE {_NODE} AND (NOT {odd} OR ln RLIKE {_WHOLE_NODE})"
    crlf, lf = literal(chr(13) + chr(10)), literal(chr(10))
    return f"filter(split(replace({snapshot}, {crlf}, {lf}), {lf}), ln -> {node})"


def snapshot_lines(snapshot: str = "snapshot") -> Column:
    """The lines that carry a node, in order."""
    return F.expr(lines_sql(snapshot))


def texts_sql(snapshot: str) -> str:
    plain = f"""replace(replace(txt, '\\\\"', '"'), '\\\\n', '\\n')"""
    found = f"transform(regexp_extract_all(ln, {_TEXT}, 1), txt -> {plain})"
    texts = f"flatten(transform({lines_sql(snapshot)}, ln -> {found}))"
    return f"filter({texts}, txt -> length(btrim(txt, {literal(WS_CHARS)})) > 0)"


def snapshot_texts(snapshot: str = "snapshot") -> Column:
    """The quoted static texts, in order, without blank ones."""
    return F.expr(texts_sql(snapshot))


def urls_sql(snapshot: str) -> str:
    raw = f"flatten(transform({lines_sql(snapshot)}, ln -> regexp_extract_all(ln, {_URL}, 1)))"
    return f"array_distinct(transform({raw}, raw_url -> {snapshot_url_sql('raw_url')}))"


def snapshot_urls(snapshot: str = "snapshot") -> Column:
    """The link targets, in order, each once."""
    return F.expr(urls_sql(snapshot))


def snapshot_article_links(snapshot: str, specs: Sequence[SourceSpec]) -> Column:
    """Canonical article URLs of a listing snapshot, first seen first."""
    parts = f"transform({urls_sql(snapshot)}, target -> {parts_sql('target')})"
    kept = f"filter({parts}, one -> {by_source(specs, lambda s: article_sql('one', s))})"
    return F.expr(f"array_distinct(transform({kept}, one -> {canonical_of('one')}))")


def snapshot_links(
    snapshots: DataFrame, specs: Sequence[SourceSpec], snapshot: str = "snapshot"
) -> DataFrame:
    """Add ``links`` to listing snapshots."""
    return snapshots.withColumn("links", snapshot_article_links(snapshot, specs))


def snapshot_article(
    snapshot: str = "snapshot", max_chars: int | None = EXTRACT_MAX_CHARS
) -> Column:
    """STRUCT<title, body_excerpt>: the first text as it is, the others joined, and cut if
    ``max_chars`` is given."""
    rest = "array_join(slice(texts, 2, greatest(size(texts), 1)), '\\n')"
    body = rest if max_chars is None else f"substring({rest}, 1, {max_chars})"
    article = (
        "named_struct('title', coalesce(try_element_at(texts, 1), ''), "
        f"'body_excerpt', {body})"
    )
    return F.expr(let(texts_sql(snapshot), "texts", article))


def is_article_complete(
    title: Column | str, body: Column | str, min_body: Column | int = MIN_SNAPSHOT_BODY_CHARS
) -> Column:
    """A title, and a trimmed body of at least ``min_body`` characters."""
    return ~is_blank(title) & F.coalesce(F.length(js_trim(body)) >= min_body, F.lit(False))


def paywall_sql(text: str, markers: PaywallMarkers) -> str:
    tests = [f"contains(small, {literal(m)})" for m in markers.any_of]
    if markers.all_of:
        tests.append(all_of(f"contains(small, {literal(m)})" for m in markers.all_of))
    if not tests:
        return "false"
    return f"coalesce({let(f'lower({text})', 'small', any_of(tests))}, false)"


def is_paywalled(text: str, markers: PaywallMarkers) -> Column:
    """Does the text show a login wall?"""
    return F.expr(paywall_sql(text, markers))


def read_attempts(
    snapshots: DataFrame, specs: Sequence[SourceSpec], max_chars: int | None = EXTRACT_MAX_CHARS
) -> DataFrame:
    """Add ``paywalled``, ``title``, ``body_excerpt`` and ``complete`` to snapshots."""
    return (
        snapshots.withColumn("_article", snapshot_article("snapshot", max_chars))
        .withColumn("title", F.col("_article.title"))
        .withColumn("body_excerpt", F.col("_article.body_excerpt"))
        .drop("_article")
        .withColumn(
            "paywalled", F.expr(by_source(specs, lambda s: paywall_sql("snapshot", s.paywall)))
        )
        .withColumn(
            "complete",
            is_article_complete(
                "title", "body_excerpt", F.expr(by_source(specs, lambda s: str(s.min_body_chars)))
            ),
        )
    )


def select_attempts(
    attempts: DataFrame,
    keys: Sequence[str] = ("url",),
    max_attempts: int | None = MAX_SNAPSHOT_ATTEMPTS,
) -> DataFrame:
    """One attempt per key: the first paywalled or complete one, else the last made.

    Only the small parsed columns travel, and each map task sends one row per key. Of
    several snapshots of one attempt a paywalled one counts first. ``max_attempts`` counts
    the attempts there are, whatever their numbers; None takes all."""
    stop = F.col("paywalled") | F.col("complete")
    rest = [c for c in attempts.columns if c not in keys and c != "snapshot"]
    row = F.struct(*rest)
    order = F.struct("attempt", ~F.col("paywalled"), "title", "body_excerpt")
    first_stop = F.min_by(row, F.when(stop, order))
    last = F.max_by(row, order)
    if max_attempts is not None:
        tried = Window.partitionBy(*keys).orderBy("attempt")
        attempts = attempts.withColumn("_try", F.dense_rank().over(tried)).where(
            F.col("_try") <= max_attempts
        ).drop("_try")
    best = (
        attempts.groupBy(*keys)
        .agg(F.coalesce(first_stop, last).alias("_row"))
    )
    return best.select(*keys, *(F.col(f"_row.{c}").alias(c) for c in rest))
