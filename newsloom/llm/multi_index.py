"""Near-duplicate vectors by an inverted multi-index (Babenko and Lempitsky 2012).

Each half of the unit vectors has a codebook of its own; the pairs of codewords are a grid of
cells, and a vector is stored in one. To find its duplicates it visits cells in the order of
the summed distances of the halves (the multi-sequence order) until ``RECALL`` of the vectors
at the threshold would be met: that number of cells is fitted on pairs made from the sample,
each a vector and one turned from it by the largest angle allowed, in a random direction. A
pair counts if either vector visits the other's cell. All pairs so met are verified by their
cosine in double precision.

Equal vectors are one node with a count. Codebooks are fitted on at most ``SAMPLE`` vectors,
those with the smallest hashes; every vector is stored and searched. The rows that meet in a
cell are cut into blocks of about ``BLOCK`` stored and ``BLOCK`` visiting vectors, and a task
holds one pair of blocks, whatever share of the rows one cell has.

Vectors that do not take part (``vectors.usable``) link with nothing. Repeated rows come back
as given and count as one vector; a null id gives no links, ``component_id`` null and is kept.
Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import stage
from newsloom.llm.groups import components
from newsloom.llm.vectors import matrix, usable

THRESHOLD = 0.95
RECALL = 0.995
SAMPLE = 10_000
#: Vectors per cell that the codebooks aim at, and the most codewords of a half.
FILL, WORDS = 64, 1024
ROUNDS = 10
BLOCK = 1024


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def _distances(rows: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (words * words).sum(axis=1)[None, :] - 2 * rows @ words.T


def codebook(rows: np.ndarray, words: int, rng: np.random.Generator) -> np.ndarray:
    """Centres by Lloyd's method; an empty one keeps its place."""
    centres = rows[rng.choice(len(rows), size=min(words, len(rows)), replace=False)].copy()
    for _ in range(ROUNDS):
        nearest = _distances(rows, centres).argmin(axis=1)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        filled = counts > 0
        centres[filled] = sums[filled] / counts[filled][:, None]
    return centres


def visits(one: np.ndarray, two: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` cells with the smallest sums, in order, for each row of the distances to
    the codewords of the halves. Only places (a, b) in the sorted halves with
    ``(a + 1) * (b + 1) <= count`` can be among them."""
    near, far = one.argsort(axis=1, kind="stable"), two.argsort(axis=1, kind="stable")
    pairs = [
        (a, b)
        for a in range(min(count, one.shape[1]))
        for b in range(min(count // (a + 1), two.shape[1]))
    ]
    a, b = (np.array(x) for x in zip(*pairs, strict=True))
    sums = np.take_along_axis(one, near[:, a], 1) + np.take_along_axis(two, far[:, b], 1)
    order = sums.argsort(axis=1, kind="stable")[:, :count]
    rows = np.arange(len(one))[:, None]
    return near[rows, a[order]] * two.shape[1] + far[rows, b[order]]


class Index:
    """The two codebooks and the number of cells to visit."""

    def __init__(self, sample: np.ndarray, total: int, threshold: float, recall: float):
        rng = np.random.default_rng(3)
        sample = unit(sample)
        self.half = sample.shape[1] // 2
        words = int(min(WORDS, max(1, math.ceil(math.sqrt(total / FILL)))))
        self.one = codebook(sample[:, : self.half], words, rng)
        self.two = codebook(sample[:, self.half :], words, rng)
        base = sample[rng.choice(len(sample), size=min(2000, len(sample)), replace=False)]
        turn = rng.standard_normal(base.shape)
        turn -= (turn * base).sum(axis=1)[:, None] * base
        length = np.sqrt((turn * turn).sum(axis=1))
        turn = turn / np.where(length > 0, length, 1)[:, None]
        other = threshold * base + math.sqrt(1 - threshold**2) * turn
        cells = len(self.one) * len(self.two)
        self.count = 1
        while self.count < cells:
            there = self.cells(base, self.count), self.cells(other, self.count)
            met = (there[0] == there[1][:, :1]).any(axis=1) | (there[1] == there[0][:, :1]).any(axis=1)
            if met.mean() >= recall:
                break
            self.count = min(cells, math.ceil(self.count * 1.3) + 1)

    def cells(self, rows: np.ndarray, count: int | None = None) -> np.ndarray:
        return visits(
            _distances(rows[:, : self.half], self.one),
            _distances(rows[:, self.half :], self.two),
            count or self.count,
        )


def _assign(index: Index, dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                cells = index.cells(unit(matrix(part["embedding"], dimensions)))
                offsets = np.arange(0, cells.size + 1, cells.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part["node"], part["embedding"],
                     pa.ListArray.from_arrays(offsets, cells.ravel().astype(np.int64))],
                    ["node", "embedding", "cells"],
                )

    return run


def _verify(dimensions: int, threshold: float):
    def run(table: pa.Table) -> pa.Table:
        probe = np.asarray(table["probe"].to_numpy(zero_copy_only=False), dtype=bool)
        ids = table["node"].to_numpy()
        rows = unit(matrix(table["embedding"], dimensions))
        one, two = [], []
        if probe.any() and not probe.all():
            stored, own = rows[~probe], ids[~probe]
            for at in range(0, int(probe.sum()), 256):
                asked, names = rows[probe][at : at + 256], ids[probe][at : at + 256]
                i, j = np.nonzero(asked @ stored.T >= threshold)
                other = names[i] != own[j]
                one.append(np.minimum(names[i], own[j])[other])
                two.append(np.maximum(names[i], own[j])[other])
        none = np.empty(0, dtype=np.int64)
        return pa.table({"a": np.concatenate([*one, none]), "b": np.concatenate([*two, none])})

    return run


def links(
    nodes: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, sample: int = SAMPLE
) -> DataFrame:
    """``a, b`` (a < b) of the pairs of ``nodes`` (node, embedding) at the threshold."""
    empty = nodes.limit(0).select(F.col("node").alias("a"), F.col("node").alias("b"))
    picked = nodes.orderBy(F.xxhash64("node"), "node").limit(sample).collect()
    if len(picked) < 2:
        return empty
    vectors = np.array([r["embedding"] for r in picked], dtype=np.float64)
    index = Index(vectors, nodes.count(), threshold, recall)
    dimensions = vectors.shape[1]
    assigned = stage(
        nodes.select("node", "embedding").mapInArrow(
            _assign(index, dimensions), "node bigint, embedding array<double>, cells array<bigint>"
        ),
        "cells",
    )
    stored = assigned.select("node", "embedding", F.get("cells", F.lit(0)).alias("cell"))
    probes = assigned.select("node", "embedding", F.explode("cells").alias("cell"))
    # at most a row per cell of the grid
    blocks = (
        stored.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("_stored"))
        .join(
            probes.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("_probes")), "cell"
        )
    )
    part = F.xxhash64("node", F.lit("block"))
    ranges = [F.sequence(F.lit(0).cast("bigint"), F.col(c) - 1) for c in ("_stored", "_probes")]
    left = stored.join(blocks, "cell").select(
        "node", "embedding", F.lit(False).alias("probe"), "cell",
        F.pmod(part, F.col("_stored")).alias("block"), F.explode(ranges[1]).alias("visit"),
    )
    right = probes.join(blocks, "cell").select(
        "node", "embedding", F.lit(True).alias("probe"), "cell",
        F.explode(ranges[0]).alias("block"), F.pmod(part, F.col("_probes")).alias("visit"),
    )
    return (
        left.unionByName(right).groupBy("cell", "block", "visit")
        .applyInArrow(_verify(dimensions, threshold), "a bigint, b bigint")
        .distinct()
    )


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each row of ``rows`` (vec_id, embedding)."""
    vectors = stage(usable(rows).distinct(), "vectors")
    nodes = stage(
        vectors.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("n")),
        "nodes",
    )
    found = stage(links(nodes, threshold), "links")
    both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = nodes.groupBy("node").agg(F.max("n").alias("n"))
    linked = (
        both.join(sizes.withColumnRenamed("node", "b"), "b")
        .groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    )
    groups = components(found)
    judged = (
        sizes.join(linked, "node", "left").join(groups, "node", "left")
        .select(
            "node", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    ids = (
        vectors.join(nodes.select("embedding", "node"), "embedding")
        .groupBy("vec_id").agg(F.min("node").alias("node"))
    )
    named = ids.join(judged, "node").select("vec_id", "n_links", "component_id")
    return rows.select("vec_id").join(named, "vec_id", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
