"""Article pages: look-up by URL, title and body, thin pages and their fallback."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.dom import page_article
from newsloom.functions.text import html_to_text, js_trim, truncate_text
from newsloom.functions.urls import canonical_url
from newsloom.operators.links import by_source, read_slices
from newsloom.operators.skew import is_small, keep_first, spread_join
from newsloom.operators.snapshots import snapshot_texts
from newsloom.specs import EXTRACT_MAX_CHARS, MIN_HTML_CHARS, SourceSpec

NOT_FETCHED = "page not fetched"


def is_thin_page(html: Column | str, min_chars: int = MIN_HTML_CHARS) -> Column:
    """True for markup too short to be a real page."""
    return F.length(html) < min_chars


def _parsed(markup: Column, specs: Sequence[SourceSpec]) -> Column:
    rules = {s.source_id: (s.article_parser, s.selectors) for s in specs}
    only = next(iter(rules.values())) if len(specs) == 1 else None

    def read(page: str | None, source: str | None) -> dict | None:
        if page is None:
            return {}
        try:
            own, selectors = only or rules[source]
            title, body = own(page) if own else page_article(page, selectors)
            return {"title": title, "body": body}
        except Exception as error:  # noqa: BLE001 - a page must not end the job
            return {"error": f"article_parse: {type(error).__name__}: {error}"}

    kind = pa.struct([("title", pa.string()), ("body", pa.string()), ("error", pa.string())])

    @F.arrow_udf("struct<title string, body string, error string>")
    def parse(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        return read_slices(batches, read, kind)

    return parse(markup, F.lit("") if only else F.col("source_id"))


def extract_articles(
    pages: DataFrame,
    specs: Sequence[SourceSpec],
    max_chars: int | None = EXTRACT_MAX_CHARS,
    html: str = "html",
) -> DataFrame:
    """Add ``title`` (trimmed) and ``body_excerpt`` (plain text, cut if ``max_chars`` is
    given) of each page. A page whose parser fails gets the error as ``fetch_error``.

    Selecting runs in Python workers on the markup alone; turning the body's markup
    into text stays in the JVM."""
    error = F.col("_parsed.error")
    if "fetch_error" in pages.columns:
        error = F.coalesce("fetch_error", error)
    return (
        pages.withColumn("_parsed", _parsed(F.col(html), specs))
        .withColumn("title", js_trim("_parsed.title"))
        .withColumn("_text", html_to_text("_parsed.body"))
        .withColumn(
            "body_excerpt",
            F.col("_text") if max_chars is None else truncate_text("_text", max_chars),
        )
        .withColumn("fetch_error", error)
        .drop("_parsed", "_text")
    )


def native_article(html: Column | str, title_tag: str = "h1", body_tag: str = "article") -> tuple:
    """Title and body text of well-formed pages by regular expressions: the first
    element of each tag name. Returns two columns."""
    html = F.col(html) if isinstance(html, str) else html

    def inner(tag: str) -> Column:
        return F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1)

    return html_to_text(inner(title_tag)), html_to_text(inner(body_tag))


def fetch_pages(keys: DataFrame, pages: DataFrame, max_keys: int | None = None) -> DataFrame:
    """The latest page of each wanted URL: ``keys`` columns plus ``html``, ``fetch_error``.

    ``keys`` holds distinct rows whose ``url`` is canonical; ``max_keys`` is a bound on
    them known beforehand. The page table is cut down to the wanted URLs before copies
    are compared: with few keys by a broadcast, so that no page is shuffled, else by a
    join that spreads URLs with very many copies. The last fetched copy wins."""
    wanted = keys.select(F.col("url").alias("_url")).distinct()
    found = pages.select(
        canonical_url("url").alias("_url"),
        F.col("url").alias("_raw"),
        "html",
        "fetch_error",
        "fetched_at",
    ).where(F.col("_url").isNotNull())
    if is_small(max_keys):
        hits = found.join(F.broadcast(wanted), "_url")
    else:
        hits = spread_join(found, wanted, ["_url"], "inner")
    latest = keep_first(hits, ["_url"], ["fetched_at", "_raw"], last=True)
    return keys.join(latest.withColumnRenamed("_url", "url"), "url").select(
        *keys.columns, "html", "fetch_error"
    )


def join_articles(
    links: DataFrame, articles: DataFrame, on: Sequence[str], max_rows: int | None = None
) -> DataFrame:
    """Left join of links with their articles (one row per key). A link without a page
    gets a ``fetch_error``; so does one whose page could not be fetched."""
    marked = articles.withColumn("_found", F.lit(True))
    joined = spread_join(links, marked, on, "left", max_rows=max_rows)
    missing = F.when(F.col("_found").isNull(), F.lit(NOT_FETCHED))
    return joined.withColumn("fetch_error", F.coalesce(missing, "fetch_error")).drop("_found")


def fallback_article(
    articles: DataFrame, specs: Sequence[SourceSpec], max_chars: int | None = EXTRACT_MAX_CHARS
) -> DataFrame:
    """Add ``_title`` and ``_body``, the article of a thin page by its ``_snapshot``: the
    first text is the title and the rest the body, read as if they stood in a small page
    with a ``title`` and one ``article``."""

    def has(choices: tuple[str, ...], wanted: set[str]) -> str:
        return "true" if wanted & set(choices) else "false"

    titled = F.expr(by_source(specs, lambda s: has(s.selectors.titles, {"title"})))
    bodied = F.expr(
        by_source(specs, lambda s: has(s.selectors.bodies, {"article", ".article-content"}))
    )
    body = F.expr("array_join(slice(_texts, 2, greatest(size(_texts), 1)), '\\n')")
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        body = F.replace(body, F.lit(char), F.lit(entity))
    first = js_trim(F.coalesce(F.try_element_at("_texts", F.lit(1)), F.lit("")))
    return (
        articles.withColumn("_texts", snapshot_texts("_snapshot"))
        .withColumn("_text", html_to_text(body))
        .withColumn("_title", F.when(titled, first).otherwise(F.lit("")))
        .withColumn("_body", F.when(bodied, F.col("_text") if max_chars is None else truncate_text("_text", max_chars)).otherwise(F.lit("")))
        .drop("_texts", "_text")
    )


def apply_fallback(
    articles: DataFrame,
    snapshots: DataFrame,
    specs: Sequence[SourceSpec],
    max_chars: int | None = EXTRACT_MAX_CHARS,
    min_chars: int = MIN_HTML_CHARS,
    max_rows: int | None = None,
) -> DataFrame:
    """Thin pages take title and body from their snapshot, where there is one.

    ``articles`` has ``url``, ``html``, ``title``, ``body_excerpt``; ``snapshots`` one
    row per canonical ``url``."""
    snaps = snapshots.select("url", F.col("snapshot").alias("_snapshot"))
    joined = spread_join(articles, snaps, ["url"], "left", max_rows=max_rows)
    thin = is_thin_page("html", min_chars) & F.col("_snapshot").isNotNull()
    joined = joined.withColumn("_snapshot", F.when(thin, F.col("_snapshot")))
    thin = F.col("_snapshot").isNotNull()
    return (
        fallback_article(joined, specs, max_chars)
        .withColumn("title", F.when(thin, F.col("_title")).otherwise(F.col("title")))
        .withColumn(
            "body_excerpt", F.when(thin, F.col("_body")).otherwise(F.col("body_excerpt"))
        )
        .select(*articles.columns)
    )
