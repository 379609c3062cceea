"""Writing: the tables of a store and the flat export.

A store is a folder of parquet tables. Logs are appended. The keyed tables (news, section
snapshots, URL index) lie in buckets of their URL (``keyed``): a run rewrites only the buckets
its rows fall into, and a version becomes visible as a whole, so readers never see half of one
and a failed run leaves the last version in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.functions.identity import iso_time
from newsloom.operators.change import merge_section_snapshots, merge_url_index
from newsloom.operators.merge import merge_news
from newsloom.operators.runs import valid_event
from newsloom.session import stage
from newsloom.sources.keyed import BUCKETS, KeyedTable

#: Schema and URL column, which is canonical, of the keyed tables.
KEYED = {
    "news": (schemas.NEWS, "source_url"),
    "section_snapshot": (schemas.SECTION_SNAPSHOT, "section_url"),
    "url_index": (schemas.URL_INDEX, "url"),
}


class Store:
    """The tables of one folder on any file system Spark can reach. ``buckets`` is the number
    of buckets of keyed tables that are not there yet."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = {
            name: KeyedTable(spark, f"{self.root}/{name}", schema, cluster, buckets)
            for name, (schema, cluster) in KEYED.items()
        }

    def read(self, table: str, before: str | None = None) -> DataFrame:
        """The newest version of a keyed table; empty before the first. A run reads what
        was there ``before`` its own version, so that it can be repeated."""
        return self.tables[table].read(before)

    def look_up(
        self, table: str, keys: DataFrame, column: str = "url", before: str | None = None
    ) -> DataFrame:
        """The rows of a keyed table whose URL is among ``keys``, without moving the others."""
        return self.tables[table].look_up(keys, column, before)

    def check_version(self, version: str) -> None:
        """Refuse a run older than what is stored: its tables would never be read."""
        for name, table in self.tables.items():
            newest = table.versions()[-1:]
            if newest and version < newest[0]:
                raise ValueError(f"{name} already has version {newest[0]}, after {version}")

    def vacuum(self, keep: int = 2) -> None:
        """Drop old versions of the keyed tables."""
        for table in self.tables.values():
            table.vacuum(keep)

    def read_logs(self) -> DataFrame:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        folder = hadoop.Path(f"{self.root}/logs")
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return self.spark.createDataFrame([], schemas.LOGS)
        columns = schemas.struct_type(schemas.LOGS).fieldNames()
        kept = f"{schemas.LOGS}, run_date string, batch string"
        return self.spark.read.schema(kept).parquet(f"{self.root}/logs").select(*columns)

    def append_logs(self, events: DataFrame, run_date: str, batch: str, logged_at: str) -> None:
        """Add one batch of events, all with one time. Each batch has a partition of its
        own that a repeated write replaces, so a retry adds nothing twice. Events that
        may not be logged are kept apart under ``rejected_logs``."""
        rows = (
            events.withColumn("logged_at", F.lit(logged_at).cast("timestamp"))
            .select(*schemas.struct_type(schemas.LOGS).fieldNames())
            .withColumn("run_date", F.lit(run_date))
            .withColumn("batch", F.lit(batch))
        )
        for table, part in (
            ("logs", rows.where(valid_event())),
            ("rejected_logs", rows.where(~valid_event())),
        ):
            (
                part.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("run_date", "batch")
                .parquet(f"{self.root}/{table}")
            )

    def upsert_news(self, rows: DataFrame, version: str) -> int:
        """Put news rows (with ``seq``, their scan order) into the next news version; how
        many keys were put in or replaced."""
        valid = stage(
            rows.where(F.col("entry_status").isin(*schemas.ENTRY_STATUSES)), "news-rows"
        )
        self.tables["news"].upsert(
            valid, version, lambda old, batch, place: merge_news(old, batch, place=place)
        )
        return valid.select("entry_key").distinct().count()

    def update_sections(self, current: DataFrame, version: str) -> None:
        """Put in listing hashes. ``current`` is read several times: stage it."""
        self.tables["section_snapshot"].upsert(current, version, merge_section_snapshots)

    def update_url_index(self, run: DataFrame, version: str) -> None:
        """Put in URL index rows. ``run`` is read several times: stage it."""
        self.tables["url_index"].upsert(run, version, merge_url_index)


def flat_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All columns as text in a fixed order, null as empty text, times as ISO text."""
    types = dict(df.dtypes)
    cells = []
    for name in columns:
        cell = (
            iso_time(name)
            if types[name].startswith("timestamp")
            else F.col(name).cast("string")
        )
        cells.append(F.coalesce(cell, F.lit("")).alias(name))
    return df.select(*cells)


def export_flat(df: DataFrame, columns: Sequence[str], path: str) -> None:
    """Write a flat table with a header line."""
    flat_rows(df, columns).write.mode("overwrite").csv(
        path, header=True, escape='"', emptyValue=""
    )
