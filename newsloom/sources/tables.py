"""Reading: pages, snapshots, seeds, stored news, flat files, recorded run files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom import schemas
from newsloom.specs import SourceSpec, enabled


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Fetched pages: url, html, fetched_at, fetch_error."""
    return spark.read.schema(schemas.PAGES).parquet(path)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Page snapshots from parquet: url, attempt, snapshot."""
    return spark.read.schema(schemas.SNAPSHOTS).parquet(path)


def read_snapshot_files(spark: SparkSession, path: str) -> DataFrame:
    """Page snapshots from text files, one per attempt, in ``<url-encoded url>/<attempt>.txt``."""
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/(\d+)\.txt\z", 1)
    attempt = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/(\d+)\.txt\z", 2)
    # the file path shows a percent sign of the folder name encoded once more
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(
        F.url_decode(F.url_decode(name)).alias("url"),
        attempt.cast("int").alias("attempt"),
        F.col("value").alias("snapshot"),
    )


def seeds(spark: SparkSession, specs: Sequence[SourceSpec]) -> DataFrame:
    """Listing pages of the enabled sources, with source and section order."""
    rows = [
        (spec.source_id, source_ord, s.section_id, section_ord, s.url, s.priority, s.fetch_mode)
        for source_ord, spec in enumerate(enabled(specs))
        for section_ord, s in enumerate(spec.sections)
    ]
    return spark.createDataFrame(rows, schemas.SEEDS)


def by_header(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns by header name; a missing header falls back to the fixed position."""
    have = df.columns
    picked = []
    for place, name in enumerate(columns):
        if name in have:
            picked.append(F.col(f"`{name}`"))
        elif place < len(have):
            picked.append(F.col(f"`{have[place]}`").alias(name))
        else:
            picked.append(F.lit(None).cast("string").alias(name))
    return df.select(*picked)


_NULLABLE = ("startup_name", "startup_website", "description", "news_summary", "discovered_at")


def clean_news(df: DataFrame) -> DataFrame:
    """Stored news rows as read from flat cells: rows without key dropped; blank cells of
    the optional columns become null, blank status means ``new``."""
    return (
        df.where(F.coalesce("entry_key", F.lit("")) != "")
        .withColumns({c: F.nullif(c, F.lit("")) for c in _NULLABLE})
        .withColumns({c: F.coalesce(c, F.lit("")) for c in ("source_url", "source_id")})
        .withColumn(
            "entry_status", F.coalesce(F.nullif("entry_status", F.lit("")), F.lit("new"))
        )
    )


def _flat(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(
        path, header=True, multiLine=True, escape='"', nullValue="\x00", emptyValue=""
    )


def read_flat_news(spark: SparkSession, path: str) -> DataFrame:
    """News from a flat export, whatever the order of its columns."""
    return clean_news(by_header(_flat(spark, path), schemas.NEWS_COLUMNS)).withColumn(
        "discovered_at", F.try_to_timestamp("discovered_at")
    )


def read_flat_logs(spark: SparkSession, path: str) -> DataFrame:
    """Log rows from a flat export, all text, by position."""
    df = _flat(spark, path)
    return df.toDF(*schemas.LOG_COLUMNS)


def read_url_index(spark: SparkSession, path: str) -> DataFrame:
    """A recorded URL index: one JSON object from URL to its last content."""
    entry = (
        "struct<contentHash string, lastSeenAt timestamp, lastRunId string, "
        "extractionComplete boolean>"
    )
    text = spark.read.text(path, wholetext=True)
    entries = text.select(
        F.explode(F.from_json("value", f"map<string, {entry}>")).alias("url", "e")
    )
    return entries.select(
        "url",
        F.col("e.contentHash").alias("content_hash"),
        F.col("e.lastSeenAt").alias("last_seen_at"),
        F.col("e.lastRunId").alias("last_run_id"),
        F.col("e.extractionComplete").alias("extraction_complete"),
    )


def read_crawl_events(spark: SparkSession, path: str) -> DataFrame:
    """A recorded list of crawl events (JSON array)."""
    schema = (
        "sourceId string, url string, action string, at timestamp, reason string, "
        "entryKey string"
    )
    df = spark.read.schema(schema).json(path, multiLine=True)
    return df.toDF("source_id", "url", "action", "at", "reason", "entry_key")


def summary_schema() -> T.StructType:
    stats = ", ".join(f"{shown}: bigint" for _, shown in schemas.STATS)
    return schemas.struct_type(
        "runId string, runDate string, startedAt string, completedAt string, "
        "storage struct<excel: boolean, postgres: boolean>, "
        "excelPaths struct<news: string, logs: string>, "
        f"totals struct<{stats}>, sources array<struct<id: string, {stats}>>"
    )


def read_run_summary(spark: SparkSession, path: str) -> DataFrame:
    """A recorded run summary (one nested JSON object)."""
    return spark.read.schema(summary_schema()).json(path, multiLine=True)
