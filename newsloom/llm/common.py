"""Shared pieces: tables, staged results and running sums.

Staged tables lie in the folder that ``spark.checkpoint.dir`` names, which all executors
share, so a lost executor costs a re-read and no recomputation. ``release`` deletes what
this session staged; call it when the results have been written.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.session import shuffle_partitions, staging_root

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
}

#: White space of the text contracts: blank, tab, line feed, vertical tab, form feed, return.
WORD = "[^\\x20\\x09-\\x0D]+"

#: Spark's setting that deletes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_staged: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to a new shared folder and read it back; plans and retries start there.

    What was shuffled on the way is deleted as soon as the folder is written."""
    spark = df.sparkSession
    path = f"{staging_root(spark).rstrip('/')}/newsloom/llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    _staged.add(path)
    read = spark.read.schema(df.schema).parquet(path)
    read._staged_path = path
    return read


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    _staged.discard(path)


def drop(df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    _delete(df.sparkSession, df._staged_path)


def release(spark: SparkSession) -> None:
    """Delete all tables staged by this session."""
    for path in list(_staged):
        _delete(spark, path)


def uniform(*parts: Column | str, seed: str = "") -> Column:
    """A fixed number in (0, 1) for a row, from the MD5 of its parts (nulls count as text)."""
    named = [F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("null")) for p in parts]
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed), *named)), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint").cast("double") + 0.5) / float(1 << 52)


def running_sums(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str]
) -> DataFrame:
    """Add, per new column, the sum of a column over the earlier rows of the same keys.

    ``keys`` hold no nulls, and keys and order tell all rows apart. The rows are cut into
    ranges of keys and order, so a hot key lies in many ranges; what came before a range is
    a running sum over one small row per key and range. No task holds a whole key."""
    parts = shuffle_partitions(df.sparkSession)
    ranged = stage(
        df.repartitionByRange(parts, *keys, *order).withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    outer = earlier.partitionBy(*keys).orderBy("_range")
    inner = earlier.partitionBy(*keys, "_range").orderBy(*order)
    totals = ranged.groupBy(*keys, "_range").agg(
        *(F.sum(v).alias(f"_total_{n}") for n, v in values.items())
    )
    bases = totals.select(
        *keys,
        "_range",
        *(F.coalesce(F.sum(f"_total_{n}").over(outer), F.lit(0)).alias(f"_base_{n}")
          for n in values),
    )
    return (
        ranged.join(bases, [*keys, "_range"])
        .withColumns({
            n: F.col(f"_base_{n}") + F.coalesce(F.sum(v).over(inner), F.lit(0))
            for n, v in values.items()
        })
        .drop("_range", *(f"_base_{n}" for n in values))
    )
