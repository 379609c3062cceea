"""Finishing a run: counters, summary, log append, news upsert, state for the next run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.answers import is_complete_extraction
from newsloom.operators.classify import stored
from newsloom.operators.extract import Extractor
from newsloom.operators.journal import AnswerJournal
from newsloom.operators.runs import (
    activity,
    article_events,
    run_spine,
    run_summary,
    section_events,
    source_stats,
    summary_event,
    union_events,
)
from newsloom.operators.select import SCAN_ORDER
from newsloom.plans.discover import State, discover, left_out
from newsloom.schemas import LOG_COLUMNS, NEWS_COLUMNS
from newsloom.session import stage
from newsloom.sources.store import Store, export_flat
from newsloom.specs import RunConfig, SourceSpec, enabled


SEQ = [("source_ord", "int"), ("section_ord", "int"), ("link_pos", "bigint")]


@dataclass(frozen=True)
class RunResult:
    outcomes: DataFrame
    stats: DataFrame
    summary: DataFrame
    events: DataFrame
    left: DataFrame | None = None


def left_counts(
    links: DataFrame | None, sections: DataFrame | None
) -> DataFrame | None:
    """Per run and source the links and listing pages that limits leave to later runs."""
    parts = [
        rows.select("run_id", "source_id", F.lit(kind).alias("kind"))
        for rows, kind in ((links, "link"), (sections, "section")) if rows is not None
    ]
    if not parts:
        return None
    return union_events(*parts).groupBy("run_id", "source_id").agg(
        F.count_if(F.col("kind") == "link").alias("links_left"),
        F.count_if(F.col("kind") == "section").alias("sections_left"),
    )


def news_rows(outcomes: DataFrame, discovered_at: str) -> DataFrame:
    """The accepted outcomes as news rows, with ``seq``, their scan order."""
    e = F.col("extraction")
    return outcomes.where(stored()).select(
        "entry_key",
        F.col("url").alias("source_url"),
        "source_id",
        *(
            e[name].alias(name)
            for name in ("startup_name", "startup_website", "description", "news_summary")
        ),
        F.col("action").alias("entry_status"),
        F.lit(discovered_at).cast("timestamp").alias("discovered_at"),
        "content_hash",
        F.struct("source_ord", *SCAN_ORDER).alias("seq"),
    )


def open_rows(outcomes: DataFrame, pending: DataFrame | None, seen_at: str) -> DataFrame:
    """URL index rows, without hash and not complete, of the URLs that a later run has to
    read: those that ended without a key, as their page was missing, walled or empty, and
    the ``pending`` ones that a limit left out."""
    failed = outcomes.where(
        F.col("entry_key").isNull() & F.col("url").isNotNull()
        & ~F.coalesce(F.col("reason") == "invalid_url", F.lit(False))
    ).select("run_id", "url")
    if pending is not None:
        failed = failed.unionByName(pending.select("run_id", "url"))
    none = F.lit(None)
    return failed.distinct().select(
        "url",
        none.cast("string").alias("content_hash"),
        F.lit(seen_at).cast("timestamp").alias("last_seen_at"),
        F.col("run_id").alias("last_run_id"),
        F.lit(False).alias("extraction_complete"),
        F.struct(*(none.cast(kind).alias(name) for name, kind in SEQ)).alias("seq"),
    )


def index_rows(outcomes: DataFrame, seen_at: str) -> DataFrame:
    """URL index rows of the articles that were read in this run.

    Complete means that nothing is left to do for this content; a failed or incomplete
    extraction is tried again next time. Repeats within the run, and articles that no
    extractor has seen, say nothing."""
    e = F.col("extraction")
    same = F.col("reason").eqNullSafe(F.lit("unchanged_content"))
    read = F.col("entry_key").isNotNull() & (same | (F.col("action") != "skipped"))
    complete = same | (
        ~F.coalesce(e["extraction_failed"], F.lit(True))
        & is_complete_extraction(e["is_relevant"], e["startup_name"], e["news_summary"])
    )
    return outcomes.where(read).select(
        "url",
        "content_hash",
        F.lit(seen_at).cast("timestamp").alias("last_seen_at"),
        F.col("run_id").alias("last_run_id"),
        complete.alias("extraction_complete"),
        F.struct(*(F.col(name).cast(kind).alias(name) for name, kind in SEQ)).alias("seq"),
    )


def section_rows(sections: DataFrame, checked_at: str, failed: bool = False) -> DataFrame:
    """Listing hashes of the pages that were read, and when. With ``failed`` also of those
    that could not be read, which leaves their hash as it was: where a limit rotates the
    pages, they must not come first each time."""
    read = F.col("link_hash").isNotNull() & (
        F.col("reason").isNull() | F.col("action").eqNullSafe("section_unchanged")
    )
    if failed:
        read |= F.col("action").eqNullSafe("error")
        sections = sections.withColumn(
            "link_hash", F.when(~F.col("action").eqNullSafe("error"), F.col("link_hash"))
        )
    return sections.where(read).select(
        "section_url",
        F.col("link_hash").alias("content_hash"),
        F.lit(checked_at).cast("timestamp").alias("checked_at"),
    )


def summarize(
    outcomes: DataFrame,
    sections: DataFrame | None,
    config: RunConfig,
    completed_at: str,
    durations: DataFrame | None = None,
    spine: DataFrame | None = None,
) -> RunResult:
    """Counters, summary and log events of classified rows, without writing anything. With a
    ``spine`` (run_id, source_id) runs and sources without activity count too."""
    stats = source_stats(activity(outcomes, sections), durations, spine)
    summary = run_summary(stats, config, completed_at)
    parts = [article_events(outcomes), summary_event(summary)]
    if sections is not None:
        parts.insert(0, section_events(sections))
    return RunResult(outcomes, stats, summary, union_events(*parts))


def complete_run(
    outcomes: DataFrame,
    sections: DataFrame | None,
    config: RunConfig,
    completed_at: str,
    store: Store,
    durations: DataFrame | None = None,
    version: str | None = None,
    exports: str | None = None,
    wanted: DataFrame | None = None,
    left_sections: DataFrame | None = None,
    spine: DataFrame | None = None,
) -> RunResult:
    """Write a run: logs, then the news, then the URL index and the section hashes. A run
    that fails in between leaves articles that the next one reads again, and none that the
    index calls done while the news lack them.

    The outcomes are staged once, so the extractor is not called again for each of the
    tables. All writes can be repeated for the same ``version``. ``wanted`` are the links
    before the limits; those without outcome are carried over in the index. Sections that a
    limit left out are the next run's first, as they were checked longest ago."""
    version = version or config.run_id
    staged = stage(outcomes, "outcomes")
    pending = None if wanted is None else left_out(wanted, staged)
    result = replace(
        summarize(staged, sections, config, completed_at, durations, spine),
        left=left_counts(pending, left_sections),
    )
    if config.store_tables:
        store.append_logs(result.events, config.run_date, version, completed_at)
        store.upsert_news(news_rows(staged, completed_at), version)
        index = index_rows(staged, completed_at).unionByName(
            open_rows(staged, pending, completed_at)
        )
        store.update_url_index(stage(index, "index-rows"), version)
        if sections is not None:
            store.update_sections(
                stage(
                    section_rows(sections, completed_at, config.max_sections is not None),
                    "section-rows",
                ),
                version,
            )
    if config.store_flat:
        if exports is None:
            raise ValueError("store_flat needs a folder for exports")
        export_flat(store.read("news"), NEWS_COLUMNS, f"{exports}/news")
        export_flat(store.read_logs(), LOG_COLUMNS, f"{exports}/logs")
    return result


def run_cycle(
    spark: SparkSession,
    specs: Sequence[SourceSpec],
    config: RunConfig,
    completed_at: str,
    store: Store,
    pages: DataFrame | None = None,
    snapshots: DataFrame | None = None,
    extractor: Extractor | None = None,
    parallelism: int | None = None,
    exports: str | None = None,
    version: str | None = None,
    durations: DataFrame | None = None,
    journal: AnswerJournal | None = None,
) -> RunResult:
    """One cycle: discover over all enabled sources from the stored state, then complete.

    ``durations`` (source_id, duration_ms) is what the caller measured, as fetching is not
    part of the job. A version below the newest one of the store is refused."""
    version = version or config.run_id
    store.check_version(version)
    found = discover(
        spark,
        specs,
        config,
        pages,
        snapshots,
        State.of(store, version),
        extractor,
        parallelism,
        journal,
    )
    spine = run_spine(spark, [config.run_id], [s.source_id for s in enabled(specs)])
    return complete_run(
        found.candidates,
        found.sections,
        config,
        completed_at,
        store,
        version=version,
        exports=exports,
        wanted=found.wanted,
        durations=durations,
        left_sections=found.left_sections,
        spine=spine,
    )
