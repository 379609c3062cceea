"""Cycles over a stream of arriving page files.

Each micro-batch is one run over the pages that are new since the last; the store's
tables are the state between runs. A batch that is repeated after a failure replaces
its own log partition and table versions, so nothing is counted twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newsloom import schemas
from newsloom.functions.identity import content_hash
from newsloom.functions.urls import canonical_url
from newsloom.operators.articles import extract_articles
from newsloom.operators.extract import Extractor
from newsloom.operators.journal import AnswerJournal
from newsloom.plans.complete import complete_run, run_cycle
from newsloom.plans.discover import State, page_candidates, settle, with_run
from newsloom.sources.store import Store
from newsloom.specs import RunConfig, SourceSpec
from newsloom.streaming.seen import mark_seen


def read_page_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None, schema: str | None = None
) -> DataFrame:
    """Page files of a folder as a stream."""
    reader = spark.readStream.schema(schema or schemas.PAGES)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def batch_config(config: RunConfig, batch_id: int) -> RunConfig:
    """Settings of a micro-batch: the run id carries the batch number and sorts by it."""
    return with_run(config, f"{config.run_id}-{batch_id:09d}")


def _start(
    pages: DataFrame,
    checkpoint: str,
    each: Callable[[DataFrame, int], None],
    mode: str = "append",
) -> StreamingQuery:
    return (
        pages.writeStream.foreachBatch(each)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_cycles(
    pages: DataFrame,
    specs: Sequence[SourceSpec],
    config: RunConfig,
    store: Store,
    checkpoint: str,
    extractor: Extractor | None = None,
    parallelism: int | None = None,
    journal: AnswerJournal | None = None,
) -> StreamingQuery:
    """Full cycles: each batch holds listing and article pages of one crawl."""

    def each(batch: DataFrame, batch_id: int) -> None:
        own = batch_config(config, batch_id)
        spark = batch.sparkSession  # the session the batch belongs to
        run_cycle(
            spark,
            specs,
            own,
            own.started_at,
            Store(spark, store.root),
            pages=batch,
            extractor=extractor,
            parallelism=parallelism,
            journal=journal and journal.of(spark),
        )

    return _start(pages, checkpoint, each)


def stream_articles(
    pages: DataFrame,
    spec: SourceSpec,
    config: RunConfig,
    store: Store,
    checkpoint: str,
    extractor: Extractor | None = None,
    parallelism: int | None = None,
) -> StreamingQuery:
    """Article pages without listings: each arriving page is scanned once and judged
    against the URLs and contents stored so far. The scan order is the fetch time, then
    the URL."""

    def each(batch: DataFrame, batch_id: int) -> None:
        own = batch_config(config, batch_id)
        placed = (
            batch.withColumn("source_id", F.lit(spec.source_id))
            .withColumn("source_ord", F.lit(0))
            .withColumn("section_ord", F.lit(0))
            .withColumn("link_pos", F.coalesce(F.unix_micros("fetched_at"), F.lit(0)))
        )
        target = Store(batch.sparkSession, store.root)
        state = State.of(target, own.run_id)
        outcomes = settle(
            page_candidates(placed, [spec], own), [spec], own, state, extractor, parallelism
        )
        complete_run(outcomes, None, own, own.started_at, target)

    return _start(pages, checkpoint, each)


def stream_seen_articles(
    pages: DataFrame,
    spec: SourceSpec,
    config: RunConfig,
    store: Store,
    checkpoint: str,
    extractor: Extractor | None = None,
    limit_ms: int | None = None,
    journal: AnswerJournal | None = None,
) -> StreamingQuery:
    """As ``stream_articles``, with what was seen kept as keyed state of the stream: of each
    URL of a batch the last copy is judged against the state, and no stored table is joined.
    An extraction that failed is not tried again before the content changes."""
    parsed = extract_articles(pages, [spec], None)
    keyed = (
        parsed.select(
            F.col("url").alias("raw_url"), canonical_url("url").alias("url"), "fetched_at",
            "fetch_error", "title", "body_excerpt",
            content_hash("title", "body_excerpt").alias("content_hash"),
        )
    )
    judged = mark_seen(keyed, limit_ms)

    def each(batch: DataFrame, batch_id: int) -> None:
        own = batch_config(config, batch_id)
        rows = batch.select(
            F.lit(own.run_id).alias("run_id"), F.lit(spec.source_id).alias("source_id"),
            F.lit(0).alias("source_ord"), F.lit(0).alias("section_ord"),
            F.coalesce(F.unix_micros("fetched_at"), F.lit(0)).alias("link_pos"), "url",
            "raw_url", "fetch_error", F.lit(False).alias("paywalled"), "title", "body_excerpt",
            "change_status",
        )
        spark = batch.sparkSession
        outcomes = settle(
            rows, [spec], own, extractor=extractor, journal=journal and journal.of(spark)
        )
        complete_run(outcomes, None, own, own.started_at, Store(spark, store.root))

    return _start(judged, checkpoint, each, "update")
