"""Listing pages to article links."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.dom import page_hrefs
from newsloom.functions.sql import let, literal
from newsloom.functions.urls import (
    article_sql,
    base_sql,
    canonical_of,
    included_sql,
    parts_sql,
    resolve_against,
)
from newsloom.specs import SourceSpec

#: Pages that a Python worker hands back at a time.
PAGES = 64

_BLOCKS = r"(?is)<!--.*?-->|<(script|style|textarea|title)\b.*?</\1\s*>"
_LINK_TAG = r"""(?i)<a\s(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
_HREF = r"""(?i)\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def by_source(specs: Sequence[SourceSpec], value: Callable[[SourceSpec], str]) -> str:
    """SQL text over all sources: each row takes the expression of its ``source_id``.
    Sources with the same expression share a branch."""
    branches: dict[Hashable, list[str]] = {}
    for spec in specs:
        branches.setdefault(value(spec), []).append(spec.source_id)
    if len(branches) == 1:
        return next(iter(branches))
    whens = (
        f"WHEN source_id IN ({', '.join(map(literal, ids))}) THEN {text}"
        for text, ids in branches.items()
    )
    return f"CASE {' '.join(whens)} END"


def native_hrefs_sql(markup: str = "html") -> str:
    """Link texts by regular expressions only, for markup known to be well formed."""
    tags = (
        f"regexp_extract_all(regexp_replace({markup}, {literal(_BLOCKS)}, ' '), "
        f"{literal(_LINK_TAG)}, 0)"
    )
    text = "concat({})".format(
        ", ".join(f"regexp_extract(tag, {literal(_HREF)}, {i})" for i in (1, 2, 3))
    )
    for entity, char in (("&quot;", '"'), ("&#39;", "'"), ("&#039;", "'"), ("&amp;", "&")):
        text = f"replace({text}, {literal(entity)}, {literal(char)})"
    return f"transform({tags}, tag -> {text})"


def native_hrefs(markup: str = "html") -> Column:
    return F.expr(native_hrefs_sql(markup))


def read_slices(
    batches: Iterator[tuple[pa.Array, pa.Array]], read: Callable[..., dict], kind: pa.DataType
) -> Iterator[pa.Array]:
    """``read`` of each page and its source. A batch may hold thousands of pages, which stay in
    Arrow; only ``PAGES`` of them and what is read of these are Python objects at a time."""
    for pages, sources in batches:
        for at in range(0, len(pages), PAGES):
            some = zip(pages.slice(at, PAGES), sources.slice(at, PAGES), strict=True)
            yield pa.array([read(page.as_py(), source.as_py()) for page, source in some], kind)


def parsed_hrefs(markup: str, specs: Sequence[SourceSpec]) -> Column:
    """STRUCT<hrefs, error>: link texts by the HTML tokenizer, or by the source's own
    listing parser, and why it failed."""
    parsers = {s.source_id: s.listing_parser or page_hrefs for s in specs}
    only = next(iter(parsers.values())) if len(specs) == 1 else None

    def read(page: str | None, source: str | None) -> dict:
        try:
            return {"hrefs": None if page is None else (only or parsers[source])(page)}
        except Exception as error:  # noqa: BLE001 - a page must not end the job
            return {"error": f"section_parse: {type(error).__name__}: {error}"}

    kind = pa.struct([("hrefs", pa.list_(pa.string())), ("error", pa.string())])

    @F.arrow_udf("struct<hrefs array<string>, error string>")
    def hrefs(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        return read_slices(batches, read, kind)

    source = F.lit("") if only else F.col("source_id")
    return hrefs(F.col(markup), source)


def article_links(hrefs: str, base: str, specs: Sequence[SourceSpec]) -> Column:
    """Canonical article URLs among link texts, first seen first, each once."""
    rule = by_source(
        specs, lambda s: f"({article_sql('one', s)} AND {included_sql('one', s)})"
    )
    resolved = let(resolve_against("href", "origin"), "whole", parts_sql("whole"))
    kept = f"filter(transform({hrefs}, href -> {resolved}), one -> {rule})"
    kept = let(base_sql(base), "origin", kept)
    return F.expr(f"array_distinct(transform({kept}, one -> {canonical_of('one')}))")


def listing_links(
    pages: DataFrame,
    specs: Sequence[SourceSpec],
    html: str = "html",
    base: str = "section_url",
    parser: str = "dom",
) -> DataFrame:
    """Add ``links``, the article links of each listing page in page order.

    The links of a page stay together in its row, so finding, filtering and
    deduplicating them moves no data. A page whose parser fails has no links and, where
    there is that column, the error as ``fetch_error``. ``parser="native"`` reads them by regular
    expressions alone."""
    if parser not in ("dom", "native"):
        raise ValueError(f"unknown parser {parser!r}")
    if parser == "native":
        found = pages.withColumn("_hrefs", native_hrefs(html))
    else:
        found = pages.withColumn("_read", parsed_hrefs(html, specs)).withColumn(
            "_hrefs", F.col("_read.hrefs")
        )
        if "fetch_error" in pages.columns:
            found = found.withColumn("fetch_error", F.coalesce("fetch_error", "_read.error"))
    links = article_links("_hrefs", base, specs)
    return found.withColumn("links", links).drop("_hrefs", "_read")


def explode_links(pages: DataFrame, links: str = "links") -> DataFrame:
    """One row per link with its position on the page."""
    rest = [c for c in pages.columns if c != links]
    # the outer form: for the plain one Spark would first filter on the size of the array
    # and compute the links twice for it
    rows = pages.select(*rest, F.posexplode_outer(links).alias("link_pos", "url"))
    return rows.where(F.col("link_pos").isNotNull())
