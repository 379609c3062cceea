"""Queries over several runs, batches or stored states."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.catalog import stand_ins as si
from newsloom.catalog.queries import _RESOLVED, Query, _folder, _page_links, listing_pages
from newsloom.functions.answers import parse_extraction
from newsloom.functions.identity import iso_time, run_date
from newsloom.functions.urls import canonical_sql, canonical_url
from newsloom.operators.articles import extract_articles
from newsloom.operators.extract import extract_with
from newsloom.operators.journal import AnswerJournal
from newsloom.operators.link_table import SCHEMA as LINK_TABLE
from newsloom.operators.link_table import found_links, merge_link_table
from newsloom.operators.links import explode_links, listing_links
from newsloom.operators.runs import run_summary, source_stats
from newsloom.operators.select import first_sections
from newsloom.plans.complete import run_cycle
from newsloom.session import stage
from newsloom.sources import tables
from newsloom.sources.store import Store
from newsloom.specs import ArticleRule, Section, Selectors, SourceSpec
from newsloom.streaming.incremental import read_page_stream, stream_cycles
from newsloom.streaming.seen import mark_seen


def stream_seen_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that arrive twice, with a restart in between: first those with a query or
    fragment, then all of them, the French ones with other markup."""
    folder = _folder(spark, "seen")
    pages = si.pages(spark, sf_dir).drop("page_id")
    french = F.regexp_extract("url", r"\Ahttps?://[^/]+/([a-z]+)/", 1) == "fr"
    changed = pages.withColumn(
        "html", F.when(french, F.concat("html", F.lit("x"))).otherwise(F.col("html"))
    )

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch", F.lit(batch_id))
        rows.write.mode("overwrite").parquet(f"{folder}/judged/{batch_id}")

    for part in (pages.where(F.col("url").rlike("[?#]")), changed):
        part.write.mode("append").parquet(f"{folder}/pages")
        arriving = read_page_stream(spark, f"{folder}/pages").select(
            canonical_url("url").alias("url"), "fetched_at", F.md5("html").alias("content_hash")
        )
        query = (
            mark_seen(arriving).writeStream.foreachBatch(each).outputMode("update")
            .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    judged = spark.read.parquet(f"{folder}/judged/0", f"{folder}/judged/1")
    return judged.select(
        "batch", "url", "content_hash", "change_status", "n_seen",
        *(iso_time(c).alias(c) for c in ("first_seen", "last_seen")),
    )


def answer_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents are asked about in a first run, all of them in a second one, by
    extractors that sign their answers: the second run asks for what is left."""
    journal = AnswerJournal(spark, _folder(spark, "journal"), buckets=8)
    rows = si.documents(spark, sf_dir).select("doc_id", "url", "title", "body_excerpt")
    known = rows.join(si.table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    for name, part in (("first", known), ("second", rows)):
        done = extract_with(
            part, si.SignedExtractor(name), max_chars=None, journal=journal, run_id=name
        )
        done = stage(done, "answered")
    return done.select(
        "doc_id", F.col("extraction.description").alias("asked_by"),
        F.col("extraction.startup_website").alias("startup_website"),
    )


def link_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all pages over three runs: all links of the pages with a query or fragment,
    then the article links of all pages in steps of two, the first one met again in a last
    step, then again all links of the pages with a query."""
    pages = si.pages(spark, sf_dir)
    every = F.expr(f"transform({_RESOLVED}, h -> {canonical_sql('h')})")
    whole = pages.select(F.col("url").alias("section_url"), F.posexplode(every).alias("link_pos", "url"))
    old = whole.where(F.col("section_url").rlike("[?#]")).withColumn("step", F.lit(0))
    found = explode_links(_page_links(spark, sf_dir, "native")).select(
        F.col("page_url").alias("section_url"), "url", "link_pos",
        F.floor(F.col("link_pos") / 2).cast("int").alias("step"),
    )
    again = found.where("link_pos = 0").withColumn("step", F.lit(99))
    last = whole.where(F.contains("section_url", F.lit("?"))).withColumn("step", F.lit(0))
    read = pages.select(F.col("url").alias("section_url")).distinct()
    table = spark.createDataFrame([], LINK_TABLE)
    runs = (
        ("run-1", old, read.where(F.col("section_url").rlike("[?#]"))),
        ("run-2", found.unionByName(again), read),
        ("run-3", last, read.where(F.contains("section_url", F.lit("?")))),
    )
    for run_id, steps, seen in runs:
        merged = stage(merge_link_table(table, found_links(steps), seen, run_id), "links")
        table = merged.drop("change")
    return merged


def dense_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries of one run per day over event types as sources. A source and a run without
    any event show with zeros."""
    events = si.table(spark, sf_dir, "events")
    activity = events.select(
        run_date("ts").alias("run_id"), F.col("event_type").alias("source_id"),
        F.lit("article").alias("kind"),
        F.when(F.col("value") < 10, F.lit("new")).otherwise(F.lit("skipped")).alias("action"),
    )
    sources = ("click", "error", "idle", "purchase", "signup", "view")
    idle = spark.createDataFrame([("2024-12-31",)], "run_id string")
    spine = activity.select("run_id").distinct().unionByName(idle).select(
        "run_id", F.explode(F.array(*map(F.lit, sources))).alias("source_id")
    )
    summary = run_summary(source_stats(activity, None, spine), si.CONFIG, si.COMPLETED_AT)
    return summary.select(
        F.col("runId").alias("run_id"),
        F.col("totals.articlesScanned").alias("total_scanned"),
        F.col("totals.new").alias("total_new"),
        F.posexplode("sources").alias("place", "s"),
    ).select(
        "run_id", "total_scanned", "total_new", "place", F.col("s.id").alias("id"),
        F.col("s.articlesScanned").alias("scanned"), F.col("s.new").alias("new"),
        F.col("s.skipped").alias("skipped"),
    )


def section_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs of at most 30 listing pages per domain: in which run each page is read."""
    listings = listing_pages(si.pages(spark, sf_dir)).select("source_id", "page_id", "section_url")
    seeds = stage(
        listings.select("source_id", F.col("page_id").cast("int").alias("section_ord"), "section_url"),
        "seeds",
    )
    store = Store(spark, _folder(spark, "sections"), buckets=8)
    for run in (1, 2, 3):
        chosen = first_sections(seeds, 30, store.read("section_snapshot"))
        rows = chosen.select(
            "section_url", F.md5("section_url").alias("content_hash"),
            F.timestamp_seconds(F.lit(run)).alias("checked_at"),
        )
        store.update_sections(stage(rows, "checked"), f"run-{run}")
    read = store.read("section_snapshot").select(
        "section_url", F.unix_seconds("checked_at").cast("int").alias("run")
    )
    return seeds.join(read, "section_url", "left").select("source_id", "section_url", "run")


def _cycle_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, list[SourceSpec]]:
    """Fetched pages with ten listing pages per domain, snapshots of documents with one feed
    per language, and the sources: one domain has a listing that was never fetched, one is
    switched off, and so is one feed."""
    pages = si.pages(spark, sf_dir)
    linked = pages.groupBy(si.domain().alias("d"), F.pmod("page_id", F.lit(10)).alias("k")).agg(
        F.array_sort(F.collect_list(F.struct("page_id", "url"))).alias("found")
    )
    listings = linked.select(
        F.concat(F.lit("https://list.example."), "d", F.lit("/"), "k").alias("url"),
        F.array_join(
            F.transform("found", lambda x: F.concat(F.lit('<a href="'), x.url, F.lit('">x</a>'))), ""
        ).alias("html"),
        F.timestamp_seconds(F.lit(0)).alias("fetched_at"),
        F.lit(None).cast("string").alias("fetch_error"),
    )
    html = [
        SourceSpec(
            d, si.LANG_RULE, selectors=si.PAGE_SELECTORS, enabled=d != "org",
            sections=tuple(
                Section(str(k), f"https://list.example.{d}/{k}")
                for k in range(11 if d == "net" else 10)
            ),
        )
        for d in si.DOMAINS
    ]
    docs = si.documents(spark, sf_dir)
    feed = docs.select(
        F.concat(F.lit("https://docs.example.com/feed/"), "source_id").alias("url"),
        (F.col("doc_id") + 1).cast("int").alias("attempt"),
        F.concat(F.lit('- link "x" url='), "url").alias("snapshot"),
    )
    texts = docs.select("url", F.lit(1).alias("attempt"), si.text_lines(F.col("text")).alias("snapshot"))
    feeds = [
        SourceSpec(
            lang, si.LANG_RULE, kind="snapshot", min_body_chars=80, enabled=lang != "es",
            sections=(Section("feed", f"https://docs.example.com/feed/{lang}"),),
        )
        for lang in si.LANGS
    ]
    return pages.drop("page_id").unionByName(listings), feed.unionByName(texts.distinct()), [*html, *feeds]


def cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cycle over HTML and snapshot sources together: the logged events."""
    pages, snapshots, specs = _cycle_inputs(spark, sf_dir)
    store = Store(spark, _folder(spark, "cycle"), buckets=8)
    run_cycle(
        spark, specs, si.CONFIG, si.COMPLETED_AT, store, pages=stage(pages, "pages"),
        snapshots=stage(snapshots, "snapshots"), extractor=si.EXTRACTOR,
    )
    logs = store.read_logs().where(F.col("event") != "run_complete")
    return logs.select("source_id", "event", "url", "reason", "entry_key")


def listing_then_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cycles over a stream: the listing pages arrive first, their articles, with the
    listings once more, in a second batch. What was missing is read then."""
    pages, _, specs = _cycle_inputs(spark, sf_dir)
    folder = _folder(spark, "cycles")
    store = Store(spark, f"{folder}/store", buckets=8)
    listings = F.col("url").startswith("https://list.example.")
    html = [s for s in specs if s.kind == "html"]
    for part in (pages.where(listings), pages):
        part.write.mode("append").parquet(f"{folder}/pages")
        stream_cycles(
            read_page_stream(spark, f"{folder}/pages"), html, si.CONFIG, store,
            f"{folder}/checkpoint", si.EXTRACTOR,
        ).awaitTermination()
    logs = store.read_logs().where(F.col("event") != "run_complete")
    return logs.groupBy("run_id", "source_id", "event", "reason").agg(F.count("*").alias("n"))


def _own_links(page: str) -> list[str]:
    """A listing parser of a source's own, for the query below."""
    if "worthless" in page:
        raise ValueError("worthless page")
    return [part.split('"')[0] for part in page.split('<a href="')[1:]]


def _own_article(page: str) -> tuple[str, str]:
    if "license" in page:
        raise KeyError("license")
    return page.split("<title>")[1].split("</title>")[0], page[:100].replace("<", " ")


def parser_plugins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source with parsers of its own, which fail on some pages."""
    spec = SourceSpec(
        "own", ArticleRule(path_pattern=r"(?s)\A/.+\z"), listing_parser=_own_links,
        article_parser=_own_article, selectors=Selectors(),
    )
    pages = si.pages(spark, sf_dir)
    listed = listing_links(pages, [spec], base="url").select(
        "page_id", F.size(F.coalesce("links", F.array())).alias("n_links"),
        F.col("fetch_error").alias("listing_error"),
    )
    read = extract_articles(pages, [spec], None).select(
        "page_id", "title", F.col("fetch_error").alias("article_error")
    )
    return listed.join(read, "page_id")


def truth_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers whose relevance is a boolean, text, number, null, list or missing."""
    values = ("true", "false", '"false"', '""', "0", "7.5", "null", "[]")
    cases = [
        F.concat(F.lit(f'{{"isRelevant": {v}, "startupName": "'), F.col("doc_id"), F.lit('"}'))
        for v in values
    ]
    cases += [F.lit('{"startupName": "x"}'), F.lit("null"), F.lit("[1]"), F.lit("{oops")]
    raw = F.element_at(
        F.array(*cases), (F.pmod("doc_id", F.lit(len(cases))) + 1).cast("int")
    )
    rows = si.table(spark, sf_dir, "documents").select("doc_id", raw.alias("raw"))
    return rows.withColumn("e", parse_extraction("raw")).select(
        "doc_id", "e.is_relevant", "e.startup_name", "e.extraction_failed"
    )


def recorded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in the layout of recorded runs, one per hundred documents, and snapshots as
    parquet, written and read back."""
    folder = _folder(spark, "recorded")
    docs = si.documents(spark, sf_dir).select("doc_id", "source_id", "url", "text")
    file = F.floor(F.col("doc_id") / 100).alias("file")
    entry = F.struct(
        F.md5("text").alias("contentHash"),
        iso_time(F.timestamp_seconds("doc_id")).alias("lastSeenAt"),
        F.lit("earlier").alias("lastRunId"),
        (F.col("source_id") != "es").alias("extractionComplete"),
    )
    own = F.concat(F.lit("https://docs.example.com/"), F.col("doc_id")).alias("own")
    index = docs.select(file, own, entry.alias("entry")).groupBy("file").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("own", "entry")))).alias("value")
    )
    index.write.partitionBy("file").text(f"{folder}/index")
    event = F.struct(
        F.col("source_id").alias("sourceId"), own.alias("url"), F.lit("new").alias("action"),
        iso_time(F.timestamp_seconds("doc_id")).alias("at"),
        F.lit(None).cast("string").alias("reason"), F.md5("url").alias("entryKey"),
    )
    events = docs.select(file, event.alias("event")).groupBy("file").agg(
        F.to_json(F.collect_list("event")).alias("value")
    )
    events.write.partitionBy("file").text(f"{folder}/events")
    docs.select(
        own.alias("url"), F.lit(1).alias("attempt"), si.text_lines(F.col("text")).alias("snapshot")
    ).write.parquet(f"{folder}/snapshots")
    read = tables.read_url_index(spark, f"{folder}/index").select(
        "url", "content_hash", iso_time("last_seen_at").alias("last_seen_at"), "last_run_id",
        "extraction_complete",
    )
    logged = tables.read_crawl_events(spark, f"{folder}/events/*").select(
        "url", "source_id", "action", iso_time("at").alias("at"), "entry_key"
    )
    shown = tables.read_snapshots(spark, f"{folder}/snapshots").select(
        "url", "attempt", F.length("snapshot").alias("snapshot_chars")
    )
    return read.join(logged, "url").join(shown, "url")


STATE_QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        stream_seen_state,
        answer_journal,
        link_changes,
        dense_summaries,
        section_limit,
        cycle,
        listing_then_articles,
        parser_plugins,
        truth_cases,
        recorded_files,
    )
}
