"""Order and limits: which rows of a source are scanned, and which end as duplicates.

The limits count in scan order: section order, then position on the page. Up to
``WINDOW_CAP`` rows per source a window does it, whose row number limit Spark applies
before the shuffle; larger or missing limits use the range-wise running sums of
``skew``, where no task holds a whole source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.operators.skew import flag_first, rows_before_limit, rows_before_limits

WINDOW_CAP = 200
RUN_SOURCE = ("run_id", "source_id")
SCAN_ORDER = ("section_ord", "link_pos")


def is_window_cap(max_items: int | None) -> bool:
    """Does the limit keep each source small enough for one window?"""
    return max_items is not None and max_items <= WINDOW_CAP


def first_sections(
    seeds: DataFrame, max_sections: int | None, previous: DataFrame | None = None
) -> DataFrame:
    """The first listing pages of each source, in seed order; all of them when None.

    With ``previous``, the stored section hashes, those that were never checked come first,
    then those checked longest ago, so that what the limit leaves out is read by the next
    runs. ``seeds`` is read twice then."""
    if max_sections is None:
        return seeds
    if previous is None:
        return seeds.where(F.col("section_ord") < max_sections)
    checked = previous.select("section_url", F.unix_micros("checked_at").alias("_checked"))
    aged = seeds.join(checked, "section_url", "left").withColumn(
        "_checked", F.coalesce("_checked", F.lit(-1))
    )
    chosen = cap_items(aged, max_sections, ["source_id"], ["_checked", "section_ord"])
    return chosen.select(*seeds.columns)


def cap_scan(
    rows: DataFrame,
    max_items: int | None,
    max_new: int | None,
    accepted: Column,
    keys: Sequence[str] = RUN_SOURCE,
    order: Sequence[str] = SCAN_ORDER,
) -> DataFrame:
    """``cap_items`` and ``cap_new_rows`` at once, for rows whose outcome is known: one
    ranged and staged pass gives the running counts of both."""
    limits = []
    if max_items is not None:
        limits.append((F.lit(1), max_items))
    if max_new is not None:
        limits.append((F.when(accepted, F.lit(1)).otherwise(F.lit(0)), max_new))
    return rows_before_limits(rows, keys, order, limits) if limits else rows


def cap_items(
    links: DataFrame,
    max_items: int | None,
    keys: Sequence[str] = RUN_SOURCE,
    order: Sequence[str] = SCAN_ORDER,
) -> DataFrame:
    """The first ``max_items`` rows per run and source; all rows when None.

    ``order`` gives each row of a key a place of its own."""
    if max_items is None:
        return links
    if is_window_cap(max_items):
        place = Window.partitionBy(*keys).orderBy(*order)
        return (
            links.withColumn("_place", F.row_number().over(place))
            .where(F.col("_place") <= max_items)
            .drop("_place")
        )
    return rows_before_limit(links, keys, order, F.lit(1), max_items)


def cap_new_rows(
    rows: DataFrame,
    max_new: int | None,
    accepted: Column,
    max_items: int | None,
    keys: Sequence[str] = RUN_SOURCE,
    order: Sequence[str] = SCAN_ORDER,
) -> DataFrame:
    """Rows up to the one that makes ``max_new`` accepted rows; later rows are dropped as
    never scanned. ``max_items`` is the limit ``cap_items`` has put on the rows."""
    if max_new is None:
        return rows
    value = F.when(accepted, F.lit(1)).otherwise(F.lit(0))
    if is_window_cap(max_items):
        earlier = (
            Window.partitionBy(*keys)
            .orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        counted = rows.withColumn("_before", F.coalesce(F.sum(value).over(earlier), F.lit(0)))
        return counted.where(F.col("_before") < max_new).drop("_before")
    return rows_before_limit(rows, keys, order, value, max_new)


def mark_duplicates(
    rows: DataFrame,
    max_items: int | None,
    keys: Sequence[str] = RUN_SOURCE,
    order: Sequence[str] = SCAN_ORDER,
) -> DataFrame:
    """Add ``is_duplicate``: has an earlier row of the run the same ``entry_key``? Rows
    without a key never are. Rows of one place follow their URL, if there is one."""
    order = [*order, *(c for c in ("url",) if c in rows.columns)]
    if is_window_cap(max_items):
        same = Window.partitionBy(*keys, "entry_key").orderBy(*order)
        flagged = rows.withColumn("_first", F.row_number().over(same) == 1)
    else:
        # rows without a key are spread by their URL and place
        own = F.concat(F.lit("row:"), F.xxhash64(*order).cast("string"))
        keyed = rows.withColumn("_key", F.coalesce(F.col("entry_key"), own))
        flagged = flag_first(keyed, [*keys, "_key"], order, "_first").drop("_key")
    return flagged.withColumn(
        "is_duplicate", F.col("entry_key").isNotNull() & ~F.col("_first")
    ).drop("_first")
