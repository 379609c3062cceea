"""Group spelling variants: words one edit apart, found through pairs of trie nodes.

The nodes of a trie over the words (their beginnings) and of one over the reversed words
(their ends) are numbered. A word without its letter ``i`` is then a pair of integers: the
node of what comes before and that of what comes after. Two words that differ in one
replaced letter have one such pair in common; a word with a letter more has, where that is
left out, the pair of the place ``i`` at which the shorter word is parted without loss. So
a bucket of entries with equal pairs holds exactly the neighbours, no distance is computed,
and it has at most one entry per letter of the alphabet and one more. Where a letter is
doubled, leaving out either gives the same word; only the last of equal letters counts, so
no neighbour is met twice.

Numbering needs no strings of beginnings: the words are range-partitioned and sorted, and a
word shares with the one before it the nodes of their common beginning; all others are new.
Nodes that lie on both sides of a range's border are named after the first range that has
them. The first and last word of each range, which the driver needs for this, are bounded by
the number of shuffle partitions.

A word's form is its most frequent neighbour (of equals the first in code-point order), if
that is at least ``RATIO`` times as frequent; the root is where following forms ends.

Nulls: rows of texts or words that are null are left out. Repeated rows count each time. An
empty table gives an empty one. Words of any length take part; a word of length L makes
2L + 1 entries. Other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import drop, stage
from newsloom.llm.groups import roots
from newsloom.session import shuffle_partitions

RATIO = 2
LEAST_LETTERS = 5
LEAST_COUNT = 3
LETTERS = "a-zÀ-ÿ"
#: Entries: a word parted, a word without a letter, and one without the last of equal letters.
GAP, SKIP, SKIP_LAST = 0, 1, 2
#: Rows of the arrays handed to Arrow at a time.
ROWS = 100_000


def tokens(docs: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """``doc_id, run``: the runs of at least ``least`` letters, A-Z in lower case."""
    low = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    found = F.regexp_extract_all(low, F.lit(f"[{LETTERS}]{{{least},}}+"), F.lit(0))
    return docs.select("doc_id", F.explode(found).alias("run"))


def count(
    words: DataFrame, letters: int = LEAST_LETTERS, least: int = LEAST_COUNT
) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough."""
    return (
        words.where(F.length("word") >= letters).groupBy("word").agg(F.count("*").alias("n"))
        .where(F.col("n") >= least)
    )


def _common(one: str, two: str) -> int:
    """Letters that two words share at their beginning."""
    least = min(len(one), len(two))
    if one[:least] == two[:least]:
        return least
    return next(i for i in range(least) if one[i] != two[i])


def borders(ends: list[tuple[int, str, str]]) -> dict[int, tuple[list[int], str, int]]:
    """For ranges ``(part, first key, last key)`` in order: per part the owner (a part) of
    each node it shares with the part before it, by depth; its last key; and how many nodes
    of that the next part shares."""
    owners: list[int] = []
    found = {}
    for i, (part, first, last) in enumerate(ends):
        after = ends[i + 1] if i + 1 < len(ends) else None
        shared = _common(last, after[1]) if after else 0
        found[part] = (owners, last, shared)
        whole = min(_common(first, last), len(owners))
        owners = [owners[d] if d < whole else part for d in range(shared)]
    return found


class Numbers:
    """Trie nodes of the sorted keys of one range."""

    def __init__(self, part: int, owners: list[int], last: str, shared: int) -> None:
        self.part, self.owners, self.last, self.shared = part, owners, last, shared
        self.before, self.path, self.made = None, [0], 0

    def path_of(self, key: str) -> list[int]:
        """Numbers of the nodes on the way to ``key``, from the root (0)."""
        if self.before is None:
            path = [0, *(-((owner << 32) + d) for d, owner in enumerate(self.owners, 1))]
        else:
            path = self.path[: _common(self.before, key) + 1]
        onward = min(_common(key, self.last), self.shared) if self.shared else 0
        for depth in range(len(path), len(key) + 1):
            if depth <= onward:
                path.append(-((self.part << 32) + depth))
            else:
                self.made += 1
                path.append((self.part << 40) + self.made)
        self.before, self.path = key, path
        return path


def _each(batches: Iterator[pa.RecordBatch], found: dict):
    """The rows of batches sorted by part and key, with the node path of each key."""
    part, numbers = None, None
    for batch in batches:
        for row in batch.to_pylist():
            if row["_part"] != part:
                part = row["_part"]
                numbers = Numbers(part, *found[part])
                place = 0
            yield row, place, numbers.path_of(row["_key"])
            place += 1


def _arrays(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    def batch(taken: list[tuple]) -> pa.RecordBatch:
        columns = zip(*taken, strict=True)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    taken = []
    for row in rows:
        taken.append(row)
        if len(taken) == ROWS:
            yield batch(taken)
            taken = []
    if taken:
        yield batch(taken)


def _forward(found: dict):
    schema = pa.schema([
        ("id", pa.int64()), ("word", pa.string()), ("n", pa.int64()),
        ("path", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            ((row["_part"] << 40) + place, row["word"], row["n"], path)
            for row, place, path in _each(batches, found)
        )
        return _arrays(rows, schema)

    return run


def entries(word: str, path: list[int], back: list[int]) -> Iterator[tuple[int, int, int]]:
    """Pairs of a word's nodes with their kind. ``path`` leads to the word, ``back`` to the
    reversed word."""
    size = len(word)
    for i in range(size + 1):
        yield path[i], back[size - i], GAP
    for i in range(size):
        last = i + 1 == size or word[i] != word[i + 1]
        yield path[i], back[size - 1 - i], SKIP_LAST if last else SKIP


def _backward(found: dict):
    schema = pa.schema([
        ("before", pa.int64()), ("after", pa.int64()), ("kind", pa.int32()),
        ("id", pa.int64()), ("n", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (*entry, row["id"], row["n"])
            for row, _, back in _each(batches, found)
            for entry in entries(row["word"], row["path"], back)
        )
        return _arrays(rows, schema)

    return run


def meet(
    before: np.ndarray, after: np.ndarray, kind: np.ndarray, ids: np.ndarray, n: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of entries sorted by their pair: ``id, near, best_n, best_id`` of each entry that meets
    neighbours in its bucket: their number and the most frequent, of equals the smallest."""
    fresh = np.ones(len(ids), dtype=bool)
    fresh[1:] = (before[1:] != before[:-1]) | (after[1:] != after[:-1])
    bucket = np.cumsum(fresh) - 1
    shared = np.bincount(bucket)[bucket] > 1
    bucket, kind, ids, n = bucket[shared], kind[shared], ids[shared], n[shared]
    order = np.lexsort((ids, -n, bucket))
    bucket, kind, ids, n = bucket[order], kind[order], ids[order], n[order]
    buckets = int(bucket[-1]) + 1 if len(bucket) else 0

    def ranked(chosen: np.ndarray, place: int) -> np.ndarray:
        """Per bucket the row of the chosen entry at a place of its order, or -1."""
        rows = np.flatnonzero(chosen)
        own = bucket[rows]
        at = np.arange(len(rows)) - np.searchsorted(own, own)
        found = np.full(buckets, -1)
        found[own[at == place]] = rows[at == place]
        return found

    skip, last = kind != GAP, kind == SKIP_LAST
    skips = np.bincount(bucket[skip], minlength=buckets)
    lasts = np.bincount(bucket[last], minlength=buckets)
    first, second = ranked(skip, 0), ranked(skip, 1)
    gap, first_last = ranked(~skip, 0), ranked(last, 0)
    rows = np.arange(len(ids))
    other = np.where(first[bucket] == rows, second[bucket], first[bucket])
    shorter = np.where(last, gap[bucket], -1)
    # the earlier row of a bucket's order is the more frequent
    both = np.where(
        (other >= 0) & (shorter >= 0), np.minimum(other, shorter), np.maximum(other, shorter)
    )
    best = np.where(skip, both, first_last[bucket])
    near = np.where(skip, skips[bucket] - 1 + (shorter >= 0), lasts[bucket])
    met = near > 0
    best = best[met]
    return ids[met], near[met], n[best], ids[best]


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("before", "after", "kind", "id", "n")
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [batch[c].to_numpy(zero_copy_only=False) for c in names]
        if held is not None:
            now = [np.concatenate(pair) for pair in zip(held, now, strict=True)]
        # the last bucket may go on in the next batch; it is small
        same = (now[0] == now[0][-1:]) & (now[1] == now[1][-1:])
        cut = len(same) - int(same.sum())
        held = [c[cut:] for c in now]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in meet(*(c[:cut] for c in now))],
            ["id", "near", "best_n", "best_id"],
        )
    if held is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in meet(*held)], ["id", "near", "best_n", "best_id"]
        )


def _sorted(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame, dict]:
    """Rows with ``_key`` in ranges sorted by it, the staged table below, and the borders."""
    parts = shuffle_partitions(rows.sparkSession)
    ranged = stage(
        rows.repartitionByRange(parts, "_key").withColumn("_part", F.spark_partition_id()), name
    )
    ends = ranged.groupBy("_part").agg(F.min("_key"), F.max("_key")).collect()
    found = borders(sorted(map(tuple, ends)))
    return ranged.repartition(parts, "_part").sortWithinPartitions("_part", "_key"), ranged, found


def neighbours(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``id, word, n`` of distinct words, with ids in code-point order, and per id with a
    neighbour ``id, n_near, best_n, best_id``. ``words`` (word, n) is read once."""
    keyed = words.where("word IS NOT NULL").select("word", "n", F.col("word").alias("_key"))
    rows, ranged, found = _sorted(keyed, "words")
    nodes = stage(
        rows.mapInArrow(_forward(found), "id bigint, word string, n bigint, path array<bigint>"),
        "nodes",
    )
    drop(ranged)
    rows, ranged, found = _sorted(nodes.withColumn("_key", F.reverse("word")), "reversed")
    pairs = rows.mapInArrow(
        _backward(found), "before bigint, after bigint, kind int, id bigint, n bigint"
    )
    parts = shuffle_partitions(words.sparkSession)
    met = (
        pairs.repartition(parts, "before", "after").sortWithinPartitions("before", "after")
        .mapInArrow(_meet, "id bigint, near bigint, best_n bigint, best_id bigint")
    )
    best = F.max(F.struct("best_n", (-F.col("best_id")).alias("other")))
    near = stage(
        met.groupBy("id").agg(F.sum("near").alias("n_near"), best.alias("best"))
        .select("id", "n_near", "best.best_n", (-F.col("best.other")).alias("best_id")),
        "near",
    )
    drop(ranged)
    return nodes.select("id", "word", "n"), near


def group(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of distinct words given as ``word, n``."""
    named, near = neighbours(words)
    joined = named.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best_id")).alias("form_id"),
    )
    joined = stage(joined, "forms")
    linked = joined.where("form_id IS NOT NULL")
    tops = roots(linked.select(F.col("id").alias("b"), F.col("form_id").alias("a")))
    forms = named.select(
        F.col("id").alias("form_id"), F.col("word").alias("form"), F.col("n").alias("form_n")
    )
    top_words = named.select(F.col("id").alias("component"), F.col("word").alias("root"))
    return (
        joined.join(forms, "form_id", "left")
        .join(tops.withColumnRenamed("node", "id"), "id", "left")
        .join(top_words, "component", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    )
