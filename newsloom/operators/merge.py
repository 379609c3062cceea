"""Keyed upsert of one table into another."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.operators.skew import keep_first


def merge_keyed(
    existing: DataFrame,
    incoming: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str],
    keep: Sequence[str] = (),
    drop: Sequence[str] = (),
    fill: Sequence[str] = (),
    place: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``existing`` (one row per key) with the rows of ``incoming`` put in.

    Among incoming rows of a key the last by ``order`` wins. A known key takes the
    incoming values except in the ``keep`` columns, and in the ``fill`` columns where the
    incoming value is null. The wide existing rows are only
    joined to the deduplicated batch, which Spark broadcasts when it measures it to
    be small; the second join shuffles keys alone. ``place`` deals out the deduplicated
    batch as ``existing`` lies, which then stays in place in a single join. ``incoming`` is
    read twice: stage it when it is costly."""
    columns = existing.columns
    keys = [key] if isinstance(key, str) else list(key)
    latest = keep_first(incoming, keys, list(order), last=True).drop(*drop)
    values = [c for c in columns if c not in keys]
    batch = latest.select(*keys, F.struct(*values).alias("_new"))
    if place is not None:
        known = existing.withColumn("_old", F.lit(True)).join(place(batch), keys, "full")
        return known.select(*(_value(c, keys, keep, fill, F.col("_old")) for c in columns))
    updated = existing.join(batch, keys, "left").select(
        *(_value(c, keys, keep, fill, F.lit(True)) for c in columns)
    )
    added = latest.join(existing.select(*keys), keys, "left_anti").select(*columns)
    return updated.unionByName(added)


def _value(
    name: str, keys: Sequence[str], keep: Sequence[str], fill: Sequence[str], old: Column
) -> Column:
    """A column of a merged row: ``old`` tells rows that were there, ``_new`` the batch's."""
    if name in keys:
        return F.col(name)
    new = F.col(f"_new.{name}")
    if name in keep:
        return F.when(old, F.col(name)).otherwise(new).alias(name)
    if name in fill:
        return F.coalesce(new, F.col(name)).alias(name)
    return F.when(F.col("_new").isNotNull(), new).otherwise(F.col(name)).alias(name)


def merge_news(
    existing: DataFrame,
    incoming: DataFrame,
    order: Sequence[str] = ("seq",),
    place: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Upsert of news rows by ``entry_key``; a stored row keeps its URL and source. Equal keys
    have equal URLs, as a key is a hash of URL and content; where the rows are placed by URL,
    both are matched."""
    return merge_keyed(
        existing,
        incoming,
        "entry_key" if place is None else ("source_url", "entry_key"),
        order,
        keep=("source_url", "source_id"),
        drop=[c for c in order if c not in existing.columns],
        place=place,
    )
