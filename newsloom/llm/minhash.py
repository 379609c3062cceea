"""Near-duplicate documents by one-permutation hashing.

A document is the set of hashes of its word shingles. One permutation splits the hash range
into bins, the smallest hash of each bin is a component of the sketch, and an empty bin takes
the component of the first filled bin in a random order of its own (optimal densification:
two sketches agree there as often as elsewhere). Bands of components are bucket keys.

Documents with equal sets are one node. In each bucket only a star of pairs around one
centre is compared, on the full sets (``groups.grow``). Where a bucket still holds several
groups after that, its sets meet in one task, in blocks of at most ``BLOCK`` members, which
compares the members outside the largest group with all others and returns one link for each
such member and group. So pairs stay few in large groups, and no link found by the bands is
lost that would join two groups.

With 48 bands of 5 components, a pair at similarity 0.75 shares no bucket with probability
2e-6. Links themselves are exact: ``100 * intersection >= 75 * union``.

Nulls and empty texts: no shingles, linked with nothing. Rows with the same id are one
document, linked by any of its texts; a null id gives ``component_id`` null and is kept.
Repeated rows come back as often as they were given. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import stage
from newsloom.llm.groups import grow

WORDS = 5
PERCENT = 75
BANDS = 48
ROWS = 5
CACHE = 200_000
BLOCK = 2048
#: Columns of the table of common hashes at a time.
WIDE = 4096

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS, cache: dict[bytes, int] | None = None):
    """Sorted distinct 64-bit hashes of the runs of ``words`` words; of the whole text, if
    it has fewer. A-Z are lower-cased; words end at ASCII white space."""
    known = {} if cache is None else cache
    if len(known) > CACHE:
        known.clear()
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    for word in set(found):
        if word not in known:
            known[word] = xxhash.xxh3_64_intdigest(word)
    hashes = np.fromiter((known[w] for w in found), dtype=np.uint64, count=len(found))
    run = min(words, len(found))
    rolled = np.full(len(found) - run + 1, run, dtype=np.uint64)
    for i in range(run):
        rolled = rolled * _MULTIPLIER + hashes[i : len(found) - run + 1 + i]
    return np.unique(_mix(rolled))


def _orders(bins: int) -> np.ndarray:
    """For each bin, the place of every other bin in its order of search."""
    draws = np.random.default_rng(20).random((bins, bins))
    return draws.argsort(axis=1).argsort(axis=1).astype(np.int32)


def sketch(hashes: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """One smallest hash per bin, empty bins densified. ``hashes`` is sorted, not empty."""
    bins = len(orders)
    at = ((hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    filled, first = np.unique(at.astype(np.int64), return_index=True)
    own = np.zeros(bins, dtype=np.uint64)
    own[filled] = hashes[first]
    empty = np.setdiff1d(np.arange(bins), filled, assume_unique=True)
    if len(empty):
        source = filled[orders[np.ix_(empty, filled)].argmin(axis=1)]
        own[empty] = own[source]
    return own


def bands(own: np.ndarray, rows: int) -> np.ndarray:
    keys = own.reshape(-1, rows)
    rolled = np.arange(len(keys), dtype=np.uint64)
    for i in range(rows):
        rolled = rolled * _MULTIPLIER + keys[:, i]
    return _mix(rolled).view(np.int64)


def _sketches(words: int, count: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders, cache = _orders(count * rows), {}
        with np.errstate(over="ignore"):
            for batch in batches:
                sizes, digests, keys = [], [], []
                for text in batch["text"]:
                    found = shingles(text.as_py(), words, cache)
                    sizes.append(len(found))
                    if len(found):
                        digests.append(xxhash.xxh3_128_hexdigest(found.tobytes()))
                        keys.append(bands(sketch(found, orders), rows))
                    else:
                        digests.append(None)
                        keys.append(np.empty(0, dtype=np.int64))
                offsets = np.cumsum([0, *map(len, keys)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"],
                        pa.array(sizes, pa.int64()),
                        pa.array(digests, pa.string()),
                        pa.ListArray.from_arrays(
                            offsets, np.concatenate([*keys, np.empty(0, dtype=np.int64)])
                        ),
                    ],
                    ["doc_id", "n_shingles", "digest", "keys"],
                )

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, int] = {}
        with np.errstate(over="ignore"):
            for batch in batches:
                found = [shingles(t.as_py(), words, cache).view(np.int64) for t in batch["text"]]
                offsets = np.cumsum([0, *map(len, found)], dtype=np.int32)
                flat = np.concatenate([*found, np.empty(0, dtype=np.int64)])
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], pa.ListArray.from_arrays(offsets, flat)], ["id", "hashes"]
                )

    return run


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of ``pairs`` (a, b) those whose sets are similar enough."""
    one = sets.select(F.col("id").alias("a"), F.col("hashes").alias("_one"))
    two = sets.select(F.col("id").alias("b"), F.col("hashes").alias("_two"))
    common = F.size(F.array_intersect("_one", "_two"))
    union = F.size("_one") + F.size("_two") - F.col("_common")
    return (
        pairs.join(one, "a").join(two, "b")
        .withColumn("_common", common)
        .where(F.col("_common") * 100 >= union * percent)
        .select("a", "b")
    )


def bridges(sets: list[np.ndarray], group: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of places with similar sets and different groups: for each place outside the
    largest group, one per other group that it is similar to."""
    names, counts = np.unique(group, return_counts=True)
    apart = np.flatnonzero(group != names[counts.argmax()])
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, column, often = np.unique(flat, return_inverse=True, return_counts=True)
    shared = often[column] > 1
    owner, column = owner[shared], column[shared]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(apart), len(sets)), dtype=np.float32)
    place = np.full(len(sets), -1)
    place[apart] = np.arange(len(apart))
    kept = np.unique(column)
    for start in range(0, len(kept), WIDE):
        low, high = np.searchsorted(column, [kept[start], kept[min(start + WIDE, len(kept)) - 1] + 1])
        has = np.zeros((len(sets), WIDE), dtype=np.float32)
        has[owner[low:high], np.searchsorted(kept, column[low:high]) - start] = 1
        common += has[apart] @ has.T
    found = []
    for k, i in enumerate(apart):
        union = sizes[i] + sizes - common[k]
        near = np.flatnonzero((100 * common[k] >= percent * union) & (group != group[i]))
        _, first = np.unique(group[near], return_index=True)
        found += [(int(i), int(near[j])) for j in first]
    return found


def _compare(percent: int):
    def run(table: pa.Table) -> pa.Table:
        nodes = table["node"].to_numpy()
        group = table["component"].to_numpy()
        pairs = []
        if len(np.unique(group)) > 1:
            lists = table["hashes"].combine_chunks()
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            sets = [flat[ends[i] : ends[i + 1]] for i in range(len(nodes))]
            pairs = [(nodes[i], nodes[j]) for i, j in bridges(sets, group, percent)]
        a, b = zip(*pairs, strict=True) if pairs else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _settle(live: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the groups of open buckets; two blocks of a bucket meet in a task."""
    blocks = F.ceil(F.col("n") / BLOCK)
    own = F.pmod(F.xxhash64("node"), blocks)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1))
    met = live.select("bucket", "node", "component", own.alias("own"), other.alias("other"))
    return (
        met.join(sets.select(F.col("id").alias("node"), "hashes"), "node")
        .groupBy("bucket", F.least("own", "other"), F.greatest("own", "other"))
        .applyInArrow(_compare(percent), "a bigint, b bigint")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    count: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row of ``docs`` (doc_id, text)."""
    texts = docs.select("doc_id", "text")
    sketches = stage(
        texts.mapInArrow(
            _sketches(words, count, rows),
            "doc_id bigint, n_shingles bigint, digest string, keys array<bigint>",
        ),
        "sketches",
    )
    # equal sets are one node, named by its smallest id
    classes = sketches.groupBy("digest").agg(F.min("doc_id").alias("node"))
    own = stage(
        sketches.where("digest IS NOT NULL").join(classes, "digest")
        .select("doc_id", "n_shingles", "digest", "node"),
        "classes",
    )
    keyed = (
        sketches.where("digest IS NOT NULL").join(
            own.where("doc_id = node").select("digest", "node").distinct(), "digest"
        ).where("doc_id = node")
        .select("node", F.col("n_shingles").alias("size"), F.explode("keys").alias("bucket"))
        .distinct()
    )
    members = stage(
        keyed.join(
            keyed.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("centre"))
            .where("n > 1"),
            "bucket",
        ),
        "buckets",
    )
    sets = stage(
        texts.join(members.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
        .mapInArrow(_sets(words), "id bigint, hashes array<bigint>"),
        "sets",
    )
    alike = F.least("a_size", "b_size") * 100 >= F.greatest("a_size", "b_size") * percent
    groups = grow(
        members, lambda pairs: _confirm(pairs, sets, percent), ("size",), alike,
        lambda live: _settle(live, sets, percent),
    )
    return (
        sketches.select("doc_id", "n_shingles", "digest")
        .join(own.select("digest", "node").distinct(), "digest", "left")
        .join(groups, "node", "left")
        .select(
            "doc_id", "n_shingles",
            F.when(
                F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id")
            ).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
