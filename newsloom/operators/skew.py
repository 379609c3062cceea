"""Building blocks that stay balanced when one key holds a large share of all rows.

* ``keep_first`` / ``flag_first``: first row per key,
* ``rows_before_limit(s)``: the start of an ordered group of any size, up to sums,
* ``spread_join``: join of a table with hot keys to a table with one row per key.

None of them brings a whole group into one task, and none drops rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.session import shuffle_partitions, stage

# Hot keys are found by frequent-items sketches, one for each shard of the keys' hashes. A key
# that is not among the first of its shard holds less than a thousandth of the shard.
SHARDS = 64
HOT_PER_SHARD = 1000
TRACKED_PER_SHARD = 10_000
#: Rows of a key that one task of a join takes.
HOT_KEY_ROWS = 100_000

# A table that the configuration bounds to this many rows may be broadcast, and joins as
# it is whatever its keys.
SMALL_ROWS = 20_000


def is_small(max_rows: int | None) -> bool:
    """Is a table small by a bound that does not depend on the data?"""
    return max_rows is not None and max_rows <= SMALL_ROWS


def _map_salt(parts: int) -> Column:
    """Salt of a row: its input partition. Fixed for a task, so a rerun gives the same."""
    return F.pmod(F.spark_partition_id(), F.lit(parts))


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool = False
) -> DataFrame:
    """The first (or last) row of each key, as an aggregate that combines before the shuffle."""
    rest = [c for c in df.columns if c not in set(keys) | set(order)]
    row = F.struct(*(F.col(c) for c in order), *(F.col(c) for c in rest))
    pick = F.max_by if last else F.min_by
    best = df.groupBy(*keys).agg(pick(row, F.struct(*order)).alias("_row"))
    return best.select(
        *(F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns)
    )


def flag_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: str = "is_first"
) -> DataFrame:
    """Add ``flag``: is this the first row of its key? All rows stay.

    Two rounds. First the rows of a key are numbered per input partition, so a hot
    key is spread over many groups. Only the winner of each group takes part in the
    second round; the other rows keep to groups of their own there."""
    parts = shuffle_partitions(df.sparkSession)
    salted = df.withColumn("_salt", _map_salt(parts))
    near = Window.partitionBy(*keys, "_salt").orderBy(*order)
    local = salted.withColumn("_near", F.row_number().over(near))
    # second-round group: -1 for the winners of the first round, else the salt
    local = local.withColumn(
        "_group", F.when(F.col("_near") == 1, F.lit(-1)).otherwise(F.col("_salt"))
    )
    far = Window.partitionBy(*keys, "_group").orderBy(*order)
    return (
        local.withColumn("_far", F.row_number().over(far))
        .withColumn(flag, (F.col("_near") == 1) & (F.col("_far") == 1))
        .drop("_salt", "_near", "_group", "_far")
    )


def rows_before_limit(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, limit: int
) -> DataFrame:
    """The rows of each key before which ``value`` (never negative) sums to less than
    ``limit``, in the given order; see ``rows_before_limits``."""
    return rows_before_limits(df, keys, order, [(value, limit)])


def rows_before_limits(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    limits: Sequence[tuple[Column, int]],
) -> DataFrame:
    """The rows of each key before which each value (never negative) sums to less than its
    limit, in the given order, which must tell the rows of a key apart. As each limit keeps
    a beginning of the key, it does not matter in which order they are applied.

    The rows are cut into ranges of keys and order, so a large key lies in many ranges,
    and staged with their range number, which a lost task can therefore not change. What
    came before a range is a running sum over at most one small row per key and range, for
    all limits at once. Ranges that start beyond a limit fall away; the others are sorted by
    themselves.

    ``df`` is read twice, as finding the ranges takes a sample of it. If it is costly,
    stage it first."""
    parts = shuffle_partitions(df.sparkSession)
    names = [f"_value{i}" for i in range(len(limits))]
    ranged = stage(
        df.withColumns({n: v for n, (v, _) in zip(names, limits, strict=True)})
        .repartitionByRange(parts, *keys, *order)
        .withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    outer = before.partitionBy(*keys).orderBy("_range")
    inner = before.partitionBy(*keys, "_range").orderBy(*order)
    open_ranges, open_rows = F.lit(True), F.lit(True)
    for name, (_, limit) in zip(names, limits, strict=True):
        open_ranges &= F.col(f"_base{name}") < limit
        open_rows &= F.col(f"_before{name}") < limit
    bases = (
        ranged.groupBy(*keys, "_range")
        .agg(*(F.sum(n).alias(f"_total{n}") for n in names))
        .select(
            *keys,
            "_range",
            *(
                F.coalesce(F.sum(f"_total{n}").over(outer), F.lit(0)).alias(f"_base{n}")
                for n in names
            ),
        )
        .where(open_ranges)
    )
    earlier = {
        f"_before{n}": F.col(f"_base{n}") + F.coalesce(F.sum(n).over(inner), F.lit(0))
        for n in names
    }
    return (
        ranged.join(bases, [*keys, "_range"])
        .withColumns(earlier)
        .where(open_rows)
        .select(*df.columns)
    )


def hot_keys(keys: DataFrame, on: Sequence[str], rows: int, most: int) -> DataFrame:
    """``_key_hash, _salts``: keys with at least ``rows`` rows and over how many salts, one
    for each ``rows`` and at most ``most``, they are to be spread. The counts are those of
    sketches that are merged before the shuffle; they are near enough to spread by."""
    counted = f"approx_top_k(_key_hash, {HOT_PER_SHARD}, {TRACKED_PER_SHARD})"
    return (
        keys.select(F.xxhash64(*on).alias("_key_hash"))
        .groupBy(F.pmod("_key_hash", F.lit(SHARDS)).alias("_shard"))
        .agg(F.expr(counted).alias("_items"))
        .select(F.inline("_items").alias("_key_hash", "_count"))
        .where(F.col("_count") >= rows)
        .select(
            "_key_hash",
            F.least(F.ceil(F.col("_count") / rows), F.lit(most)).cast("int").alias("_salts"),
        )
    )


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    hot_rows: int = HOT_KEY_ROWS,
    max_rows: int | None = None,
) -> DataFrame:
    """Join ``left``, where a key may be very frequent, to ``right`` with one row per key.

    The hot keys of ``left`` are estimated (key column only, in sketches). The rows of a hot
    key are dealt out over salts in proportion to their number, and its right row is copied
    as often; every other row joins as usual. The broadcast list holds at most ``SHARDS`` x
    ``HOT_PER_SHARD`` entries of 12 bytes, whatever the data. ``max_rows`` is a bound on
    ``left`` known beforehand; a small table needs none of this.

    ``left`` is read twice. If it is costly, stage it first."""
    if is_small(max_rows):
        return left.join(right, list(on), how)
    parts = shuffle_partitions(left.sparkSession)
    hashed = F.xxhash64(*on)
    hot = hot_keys(left, on, hot_rows, parts)
    wide = (
        left.withColumn("_map", _map_salt(parts))
        .withColumn("_key_hash", hashed)
        .join(F.broadcast(hot), "_key_hash", "left")
        .withColumn(
            "_salt",
            F.when(F.col("_salts").isNotNull(), F.pmod("_map", "_salts")).otherwise(F.lit(0)),
        )
        .drop("_key_hash", "_salts", "_map")
    )
    tall = (
        right.withColumn("_key_hash", hashed)
        .join(F.broadcast(hot), "_key_hash", "left")
        .withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
        )
        .drop("_key_hash", "_salts")
    )
    return wide.join(tall, [*on, "_salt"], how).drop("_salt")
