"""Keyed tables in buckets: a write touches only the buckets of its keys.

A table lies in a fixed number of hash buckets of its cluster column (Spark's own bucketing).
An upsert reads, merges and writes the buckets its batch falls into, each as one new folder;
the others keep their files. A version is a small list that names the folder of each bucket.
It is written last, so a version is there as a whole or not at all: a run that fails between
two buckets leaves the last version in place, and what it wrote is never listed. ``vacuum``
deletes folders that no kept version names.

A version is read as a table of Spark's catalog over these folders, with its bucketing. Joins
and aggregates on the cluster column therefore leave the stored side where it is: only the
other side is shuffled (``look_up``). Of few keys only their buckets are read at all.

What the driver handles is the list of buckets, a setting of the table and not of the data.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.schemas import struct_type
from newsloom.session import stage

#: Buckets of a new table. About a gigabyte per bucket is a good size; see ``resize``.
BUCKETS = 32
#: Up to this share of the buckets, a look-up names them; beyond it the table is scanned.
PRUNED_SHARE = 0.5

#: Ending of the list of a version.
_LIST = ".json"

#: Deals rows out to the buckets of a table, so that a join leaves the stored side in place.
Place = Callable[[DataFrame], DataFrame]
#: The stored rows of the buckets that a batch falls into, the batch, and a way to place rows
#: made of it: to the new rows of these buckets.
Merge = Callable[[DataFrame, DataFrame, Place], DataFrame]


class KeyedTable:
    """One table below ``root`` with columns ``schema``, clustered by ``cluster``.

    Rows of one key have to agree in ``cluster``."""

    def __init__(
        self, spark: SparkSession, root: str, schema: str, cluster: str, buckets: int = BUCKETS
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.columns = struct_type(schema).fieldNames()
        self.cluster = cluster
        self.new_buckets = buckets

    # --- versions -------------------------------------------------------------------

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _children(self, path: str) -> list[str]:
        fs, where = self._fs(path)
        if not fs.exists(where):
            return []
        return [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()]

    def versions(self, before: str | None = None) -> list[str]:
        """Versions, oldest first; with ``before`` only those older than it."""
        fs, where = self._fs(f"{self.root}/versions")
        if not fs.exists(where):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(where) if s.isFile()]
        found = sorted(n.removesuffix(_LIST) for n in names if n.endswith(_LIST))
        return [n for n in found if before is None or n < before]

    def _listed(self, version: str) -> tuple[dict[int, str], int]:
        fs, where = self._fs(f"{self.root}/versions/{version}{_LIST}")
        stream = fs.open(where)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        found = json.loads(text)
        return {int(b): f for b, f in found["folders"].items()}, found["buckets"]

    def folders(self, before: str | None = None) -> tuple[dict[int, str], int]:
        """The folder of each bucket that has rows, in the newest version, and the number of
        buckets."""
        names = self.versions(before)
        return self._listed(names[-1]) if names else ({}, self.new_buckets)

    def _commit(self, version: str, folders: dict[int, str], buckets: int) -> None:
        """Make a version visible: its list is written aside, then renamed."""
        fs, aside = self._fs(f"{self.root}/versions/{version}-{uuid.uuid4().hex}.tmp")
        _, place = self._fs(f"{self.root}/versions/{version}{_LIST}")
        out = fs.create(aside, True)
        out.write(json.dumps({"buckets": buckets, "folders": folders}).encode())
        out.close()
        if fs.exists(place):  # a repeated version; the one before it stands in meanwhile
            fs.delete(place, False)
        if not fs.rename(aside, place):
            raise OSError(f"version {version} of {self.root} could not be made visible")

    # --- reading --------------------------------------------------------------------

    def bucket(self, buckets: int) -> Column:
        """Number of a row's bucket, as Spark's bucketing counts it."""
        return F.pmod(F.hash(self.cluster), F.lit(buckets)).cast("int")

    def _registered(self, folders: dict[int, str], buckets: int) -> str:
        """Name of a catalog table over the given folders."""
        shown = repr((self.root, self.schema, sorted(folders.items()), buckets))
        name = f"newsloom_{hashlib.md5(shown.encode()).hexdigest()}"
        if not self.spark.catalog.tableExists(name):
            self._create(name, f"{self.root}/data", buckets)
            places = " ".join(
                f"PARTITION (_bucket = {b}) LOCATION '{self.root}/data/{f}/_bucket={b}'"
                for b, f in sorted(folders.items())
            )
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {places}")
        return name

    def _create(self, name: str, path: str, buckets: int) -> None:
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({self.schema}, _bucket int) USING parquet "
            f"OPTIONS (path '{path}') PARTITIONED BY (_bucket) "
            f"CLUSTERED BY ({self.cluster}) SORTED BY ({self.cluster}) INTO {buckets} BUCKETS"
        )

    def read(self, before: str | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The newest version, bucketed by the cluster column; some buckets of it if named."""
        folders, count = self.folders(before)
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.table(self._registered(folders, count))
        if buckets is not None:
            rows = rows.where(F.col("_bucket").isin([int(b) for b in buckets]))
        return rows.select(*self.columns)

    def look_up(self, keys: DataFrame, column: str, before: str | None = None) -> DataFrame:
        """The stored rows whose cluster column is among ``keys[column]``.

        The stored rows stay in their buckets; the distinct keys, which combine before they
        are shuffled, are dealt out to them. ``keys`` is read twice: stage it."""
        folders, count = self.folders(before)
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        wanted = keys.select(F.col(column).alias(self.cluster)).where(F.col(self.cluster).isNotNull())
        hit = [r[0] for r in wanted.select(self.bucket(count)).distinct().collect()]
        some = hit if len(hit) <= PRUNED_SHARE * count else None
        placed = self.placed(count)(wanted.distinct())
        return self.read(before, some).join(placed, self.cluster, "left_semi").select(*self.columns)

    def placed(self, buckets: int) -> Place:
        return lambda rows: rows.repartition(buckets, self.cluster)

    # --- writing --------------------------------------------------------------------

    def _write(self, rows: DataFrame, version: str, buckets: int) -> str:
        """Write rows as a new folder with a subfolder per bucket; its name."""
        folder = f"{version}-{uuid.uuid4().hex[:8]}"
        name = f"newsloom_write_{uuid.uuid4().hex}"
        self._create(name, f"{self.root}/data/{folder}", buckets)
        try:
            placed = rows.select(*self.columns, self.bucket(buckets).alias("_bucket"))
            # a task per bucket, so each bucket is one file
            self.placed(buckets)(placed).write.insertInto(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # the folder stays
        return folder

    def replace(self, rows: DataFrame, version: str, buckets: int | None = None) -> None:
        """A version that holds just these rows."""
        count = buckets or self.folders(version)[1]
        folder = self._write(rows, version, count)
        made = self._children(f"{self.root}/data/{folder}")
        self._commit(version, {int(b.split("=")[1]): folder for b in made if "=" in b}, count)

    def upsert(self, batch: DataFrame, version: str, merge: Merge) -> list[int]:
        """The next version: ``merge(stored, batch, place)`` in the buckets of ``batch``,
        whose numbers are returned, the last version in all others. ``batch`` is read several
        times: stage it. Repeating a version starts from the one before it."""
        folders, count = self.folders(version)
        touched = sorted(r[0] for r in batch.select(self.bucket(count)).distinct().collect())
        if touched:
            folder = self._write(
                merge(self.read(version, touched), batch, self.placed(count)), version, count
            )
            folders = {**folders, **dict.fromkeys(touched, folder)}
        self._commit(version, folders, count)
        return touched

    def resize(self, version: str, buckets: int) -> None:
        """A version with the same rows in another number of buckets."""
        self.replace(stage(self.read(version), "resize"), version, buckets)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete all but the newest ``keep`` versions, and the bucket folders that none of
        these names; call it when no reader uses older ones. Returns what went."""
        names = self.versions()
        old, kept = names[:-keep], names[-keep:]
        used = {(f, b) for name in kept for b, f in self._listed(name)[0].items()}
        gone = [f"{self.root}/versions/{name}{_LIST}" for name in old]
        newest = kept[-1] if kept else ""
        for folder in self._children(f"{self.root}/data"):
            if folder.rsplit("-", 1)[0] > newest:
                continue  # of a run that has not ended
            for part in self._children(f"{self.root}/data/{folder}"):
                if "=" in part and (folder, int(part.split("=")[1])) not in used:
                    gone.append(f"{self.root}/data/{folder}/{part}")
        for path in gone:
            fs, where = self._fs(path)
            fs.delete(where, True)
        return gone
