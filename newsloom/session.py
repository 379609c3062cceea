"""Session settings and staging.

Cutting a plan means writing it to the shared folder that the cluster names in
``spark.checkpoint.dir``: a written table survives lost executors, and a stage
that is used twice (events and news) is computed once.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# Settings the jobs rely on. Answers may repeat a JSON key, and the last one counts.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # rows placed by one column may be joined on it and others without a shuffle
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app: str = "newsloom", master: str | None = None, extra: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings of this package; ``extra`` comes last."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def staging_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; a folder of our own only on a local master."""
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    root = tempfile.mkdtemp(prefix="newsloom-")
    spark.conf.set(CHECKPOINT_SETTING, root)
    return root


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder under the staging root and read it back."""
    spark = df.sparkSession
    path = f"{staging_root(spark).rstrip('/')}/newsloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
