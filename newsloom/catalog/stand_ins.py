"""The test tables seen as the engine's inputs.

``documents`` are articles: the first line is the title, the rest the body, ``lang``
the source and ``doc_id`` the scan position. The URL holds a hash of the text, so that
copies share an entry key. ``labels`` are the extractor's answers: quality 1 is
relevant, toxic 1 lacks the summary, no label is a failed call. ``pages`` are fetched
pages, ``events`` crawl events.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.extract import KeywordExtractor
from newsloom.specs import (
    ArticleRule,
    PaywallMarkers,
    RunConfig,
    Selectors,
    SourceSpec,
)

LANGS = ("de", "en", "es", "fr")
DOMAINS = ("com", "net", "org")
NO_CUT = 1_000_000_000

CONFIG = RunConfig(
    run_id="2024-02-01T00-00-00-000Z",
    run_date="2024-02-01",
    started_at="2024-02-01T00:00:00Z",
)
COMPLETED_AT = "2024-02-01T00:10:00Z"

EXTRACTOR = KeywordExtractor(("the", "nicht", "elle", "worthless", "license"))


@dataclass(frozen=True)
class SignedExtractor:
    """The keyword extractor, whose answers say which one gave them."""

    name: str

    def __call__(self, payloads: list[str]) -> list[str]:
        return [
            json.dumps(json.loads(answer) | {"isRelevant": True, "description": self.name})
            for answer in EXTRACTOR(payloads)
        ]


SLUG_RULE = ArticleRule(
    excluded_paths=("/", "/and"),
    blocked_prefixes=("/tion",),
    path_pattern=r"(?i)\A/[a-z0-9-]+\z",
)
LANG_RULE = ArticleRule(
    excluded_paths=("/",),
    path_prefixes=tuple(f"/{lang}/" for lang in LANGS),
    min_segments=2,
    ignore_case=True,
)
PAGE_SELECTORS = Selectors(titles=("h1", "title"), bodies=(".article-body", "article"))

SLUG_PAGES = SourceSpec(
    "pages",
    SLUG_RULE,
    non_article_prefixes=("/the", "/De"),
    selectors=PAGE_SELECTORS,
)
LANG_PAGES = SourceSpec("pages", LANG_RULE, selectors=PAGE_SELECTORS)

DOMAIN_SOURCES = tuple(SourceSpec(d, LANG_RULE, selectors=PAGE_SELECTORS) for d in DOMAINS)
LANG_SOURCES = tuple(SourceSpec(lang, LANG_RULE) for lang in LANGS)

WALL = PaywallMarkers(any_of=("sign in to continue",), all_of=("sign in", "join us"))
LANG_FEEDS = tuple(
    SourceSpec(
        lang, LANG_RULE, kind="snapshot", paywall=WALL, min_body_chars=80, fresh_only=True
    )
    for lang in LANGS
)


SCHEMAS = {
    "pages": "page_id bigint, url string, html string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
        "value double, props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")
    if name == "events":  # times without a zone are UTC
        local = F.col("ts").cast("timestamp")
        df = df.withColumn("ts", F.from_utc_timestamp(local, F.current_timezone()))
    return df


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched pages; a higher page id was fetched later."""
    return table(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        "html",
        F.timestamp_seconds("page_id").alias("fetched_at"),
        F.lit(None).cast("string").alias("fetch_error"),
    )


def domain() -> F.Column:
    """Last label of a page's host name."""
    return F.regexp_extract("url", r"\Ahttps?://[^/]*\.([a-z]+)/", 1)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as scanned articles of one section per language."""
    text = F.col("text")
    brk = F.instr(text, "\n")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        "text",
        F.lit(CONFIG.run_id).alias("run_id"),
        F.col("lang").alias("source_id"),
        F.array_position(F.array(*map(F.lit, LANGS)), F.col("lang")).cast("int").alias(
            "source_ord"
        ),
        F.lit(0).alias("section_ord"),
        F.col("doc_id").alias("link_pos"),
        F.concat(
            F.lit("https://docs.example.com/"), "lang", F.lit("/"), F.md5(text)
        ).alias("url"),
        F.lit(None).cast("string").alias("fetch_error"),
        F.lit(False).alias("paywalled"),
        F.when(brk > 0, F.substring(text, F.lit(1), brk - 1)).otherwise(text).alias("title"),
        F.when(brk > 0, F.substr(text, brk + 1)).otherwise(F.lit("")).alias("body_excerpt"),
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with ``raw``: a fenced JSON answer made from the labels, or null."""
    labels = table(spark, sf_dir, "labels")
    answer = F.to_json(
        F.struct(
            (F.col("quality") == 1).alias("isRelevant"),
            F.split_part("title", F.lit(" "), F.lit(1)).alias("startupName"),
            F.lit(None).cast("string").alias("startupWebsite"),
            F.col("source_id").alias("description"),
            F.when(F.col("toxic") == 0, F.col("title")).alias("newsSummary"),
        ),
        {"ignoreNullFields": "false"},
    )
    fenced = F.concat(F.lit("```json\n"), answer, F.lit("\n```"))
    return (
        documents(spark, sf_dir)
        .join(labels, "doc_id", "left")
        .withColumn("raw", F.when(F.col("quality").isNotNull(), fenced))
        .drop("quality", "toxic")
    )


def quoted(text: F.Column) -> F.Column:
    """A static text line of a snapshot."""
    return F.concat(
        F.lit('- StaticText "'), F.replace(text, F.lit('"'), F.lit('\\"')), F.lit('"')
    )


def text_lines(text: F.Column) -> F.Column:
    """Each line of a text as a snapshot line below a heading."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.concat(F.lit("  "), quoted(x)))
    return F.concat(F.lit('- main "page" [level=1]\n'), F.array_join(lines, "\n"))
