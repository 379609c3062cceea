"""Counters, totals and the summary of a run."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.text import count_words
from newsloom.schemas import LOG_EVENTS, STATS
from newsloom.specs import RunConfig

SUMMARY_SOURCE = "orchestrator"
_COUNTED = (
    ("new", "new"),
    ("updated", "updated"),
    ("skipped", "skipped"),
    ("not_relevant", "not_relevant"),
    ("errors", "error"),
)


def run_spine(spark: SparkSession, runs: Sequence[str], sources: Sequence[str]) -> DataFrame:
    """``run_id, source_id`` of each run and source, whether they have activity or not."""
    return spark.createDataFrame(
        [(run, source) for run in runs for source in sources], "run_id string, source_id string"
    )


def source_stats(
    activity: DataFrame, durations: DataFrame | None = None, spine: DataFrame | None = None
) -> DataFrame:
    """The nine counters per run and source.

    ``activity`` has one row per processed listing page (``kind`` "section", action
    null, ``section_unchanged`` or ``error``) and per scanned article (``kind``
    "article"). ``durations`` (source_id, duration_ms) is handed in, one row per
    source. The sums are combined before the shuffle, so a large source is no burden.
    ``spine`` (run_id, source_id, each once) adds a row of zeros for each run and source
    without activity."""
    counts = activity.groupBy("run_id", "source_id").agg(
        F.count_if(F.col("kind") == "section").alias("sections_checked"),
        F.count_if(F.col("action") == "section_unchanged").alias("sections_skipped"),
        F.count_if(F.col("kind") == "article").alias("articles_scanned"),
        *(F.count_if(F.col("action") == action).alias(name) for name, action in _COUNTED),
    )
    if spine is not None:
        names = [c for c in counts.columns if c not in ("run_id", "source_id")]
        counts = spine.join(counts, ["run_id", "source_id"], "full").select(
            "run_id", "source_id", *(F.coalesce(n, F.lit(0)).alias(n) for n in names)
        )
    if durations is None:
        return counts.withColumn("duration_ms", F.lit(0).cast("long"))
    return counts.join(durations, "source_id", "left").select(
        *counts.columns, F.coalesce("duration_ms", F.lit(0)).cast("long").alias("duration_ms")
    )


def run_totals(stats: DataFrame) -> DataFrame:
    """Element-wise sum of the counters over the sources of a run, durations included."""
    return stats.groupBy("run_id").agg(*(F.sum(name).alias(name) for name, _ in STATS))


def run_summary(stats: DataFrame, config: RunConfig, completed_at: str) -> DataFrame:
    """One nested row per run: times, stores, totals and the list of sources.

    The list has one entry per configured source, so collecting it is bounded by the
    configuration and not by the data."""
    fields = [F.col(ours).alias(shown) for ours, shown in STATS]
    totals = F.struct(*(F.sum(ours).alias(shown) for ours, shown in STATS))
    entry = F.struct(F.col("source_id").alias("id"), *fields)
    return (
        stats.groupBy("run_id")
        .agg(totals.alias("totals"), F.array_sort(F.collect_list(entry)).alias("sources"))
        .select(
            F.col("run_id").alias("runId"),
            F.lit(config.run_date).alias("runDate"),
            F.lit(config.started_at).alias("startedAt"),
            F.lit(completed_at).alias("completedAt"),
            F.struct(
                F.lit(config.store_flat).alias("excel"),
                F.lit(config.store_tables).alias("postgres"),
            ).alias("storage"),
            F.lit(None).cast("struct<news:string,logs:string>").alias("excelPaths"),
            "totals",
            "sources",
        )
    )


def summary_event(summary: DataFrame) -> DataFrame:
    """The ``run_complete`` log row that carries the summary as JSON."""
    return summary.select(
        F.col("runId").alias("run_id"),
        F.lit(SUMMARY_SOURCE).alias("source_id"),
        F.lit("run_complete").alias("event"),
        F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("string").alias("reason"),
        F.lit(None).cast("string").alias("entry_key"),
        F.to_json(F.struct(*summary.columns), {"ignoreNullFields": "false"}).alias("meta"),
    )


def article_events(outcomes: DataFrame) -> DataFrame:
    """Log rows of classified articles. Only stored rows name their key."""
    keyed = F.col("action").isin("new", "updated")
    return outcomes.select(
        "run_id",
        "source_id",
        F.col("action").alias("event"),
        "url",
        "reason",
        F.when(keyed, F.col("entry_key")).alias("entry_key"),
        F.lit(None).cast("string").alias("meta"),
    )


def section_events(sections: DataFrame) -> DataFrame:
    """Log rows of listing pages that failed; an unchanged page is counted, not logged."""
    return sections.where(F.col("action") == "error").select(
        "run_id",
        "source_id",
        F.col("action").alias("event"),
        F.col("section_url").alias("url"),
        "reason",
        F.lit(None).cast("string").alias("entry_key"),
        F.lit(None).cast("string").alias("meta"),
    )


def union_events(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def valid_event(event: Column | str = "event") -> Column:
    """May this event be logged?"""
    event = F.col(event) if isinstance(event, str) else event
    return F.coalesce(event.isin(*LOG_EVENTS), F.lit(False))


def activity(outcomes: DataFrame, sections: DataFrame | None = None) -> DataFrame:
    """What ``source_stats`` counts, from classified articles and processed sections."""
    rows = outcomes.select("run_id", "source_id", F.lit("article").alias("kind"), "action")
    if sections is None:
        return rows
    return rows.unionByName(
        sections.select("run_id", "source_id", F.lit("section").alias("kind"), "action")
    )


def freshness_stats(marked: DataFrame, keys: Sequence[str] = ("source_id",)) -> DataFrame:
    """Collected, fresh and already known links, from ``mark_known``."""
    return marked.groupBy(*keys).agg(
        F.count("*").alias("collected"),
        F.count_if(~F.col("is_known")).alias("fresh"),
        F.count_if(F.col("is_known")).alias("already_known"),
    )


def size_profile(rows: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Characters and words of text columns (null counts 0), summed per ``keys`` if given."""
    sizes = {}
    for name in columns:
        sizes[f"{name}_chars"] = F.coalesce(F.length(name), F.lit(0))
        sizes[f"{name}_words"] = F.coalesce(count_words(name), F.lit(0))
    if not keys:
        rest = [F.col(c) for c in rows.columns if c not in columns]
        return rows.select(*rest, *(size.alias(name) for name, size in sizes.items()))
    return rows.groupBy(*keys).agg(
        F.count("*").alias("rows"),
        *(F.sum(size).alias(name) for name, size in sizes.items()),
    )


def check_sum(stats: DataFrame) -> DataFrame:
    """Adds ``events``: how many events the counters stand for."""
    parts = ("new", "updated", "skipped", "not_relevant", "errors", "sections_skipped")
    return stats.withColumn("events", reduce(add, (F.col(p) for p in parts)))
