"""What a stream has seen, as keyed state: one small entry per URL, no look-up in stored tables.

Pages are dealt out by their URL. The state of a URL is the hash of its last content, when it
was first and last seen, and how often; it lies in the checkpoint of the stream, so a restart
goes on where the last batch ended. Of the copies of a URL in a batch the last fetched counts
(of equal times the greater hash); they are gone through one by one and only that one is held,
so a URL with very many copies needs no more memory than others. Rows go through as they are,
since a URL mostly has one or two copies and a frame for each would cost more than judging it. With a time limit, a URL
whose last copy was fetched so long before counts as new again. Its entry can also be dropped
from the state after a time (``drop_after_ms``); that runs on the clock, for streams that do not
end: with an available-now trigger Spark would start empty batches for it without end.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructType, TimestampType

#: Keyed state of Python processors needs this store; it is set when a stream is put together.
PROVIDER_SETTING = "spark.sql.streaming.stateStore.providerClass"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

STATE = (
    StructType()
    .add("content_hash", StringType())
    .add("first_seen", TimestampType())
    .add("last_seen", TimestampType())
    .add("n_seen", LongType())
)
#: Columns that are added to the last copy of each URL of a batch.
ADDED = (
    StructType()
    .add("change_status", StringType())
    .add("first_seen", TimestampType())
    .add("last_seen", TimestampType())
    .add("n_seen", LongType())
)


def _time(value: datetime | None) -> datetime | None:
    """Rows bring times with a zone, the state gives them back in that of the process."""
    return None if value is None else value.astimezone(timezone.utc)


class SeenUrls(StatefulProcessor):
    """Judges the last copy of a URL against what was seen before the batch."""

    def __init__(
        self, columns: Sequence[str], limit_ms: int | None, drop_after_ms: int | None
    ) -> None:
        self.columns = list(columns)
        self.limit = None if limit_ms is None else timedelta(milliseconds=limit_ms)
        self.drop_after_ms = drop_after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", STATE, self.drop_after_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues):  # noqa: N802, N803
        before = self.seen.get()  # None where there is no entry
        first = _time(before[1]) if before else None
        seen_at = last = _time(before[2]) if before else None
        count = before[3] if before else 0
        best, best_place = None, None
        for row in rows:
            count += 1
            at = _time(row["fetched_at"])
            place = (at is not None, at, row["content_hash"] or "")
            if best is None or place > best_place:
                best, best_place = row, place
            if at is not None:
                first = at if first is None else min(first, at)
                last = at if last is None else max(last, at)
        if best is None:
            return
        at = best_place[1]
        late = seen_at is not None and at is not None and self.limit is not None
        if before is None or (late and at - seen_at > self.limit):
            status = "new"
        else:
            status = "unchanged" if before[0] == best["content_hash"] else "updated"
        self.seen.update((best["content_hash"], first, last, count))
        added = {
            "change_status": status, "first_seen": first, "last_seen": last, "n_seen": count,
        }
        yield Row(**{name: best[name] for name in self.columns}, **added)

    def close(self) -> None:
        pass


def mark_seen(
    pages: DataFrame, limit_ms: int | None = None, drop_after_ms: int | None = None
) -> DataFrame:
    """The last copy of each URL of a batch with ``change_status`` (new, updated, unchanged),
    ``first_seen``, ``last_seen`` and ``n_seen``. ``pages`` is a stream with ``url``,
    ``fetched_at`` and ``content_hash`` among its columns; rows without URL are left out."""
    spark: SparkSession = pages.sparkSession
    spark.conf.set(PROVIDER_SETTING, PROVIDER)
    kept = [f for f in pages.schema.fields if f.name not in ADDED.fieldNames()]
    output = StructType([*kept, *ADDED.fields])
    return (
        pages.select(*(f.name for f in kept)).where(F.col("url").isNotNull())
        .groupBy("url")
        .transformWithState(
            SeenUrls([f.name for f in kept], limit_ms, drop_after_ms),
            outputStructType=output,
            outputMode="Update",
            timeMode="None" if drop_after_ms is None else "ProcessingTime",
        )
    )
