"""Nearest neighbours by collision counting (query-aware hashing, Huang et al. 2015).

Largest inner product becomes smallest distance by one more component: with M the largest
norm, a vector gets the root of ``M^2 - |x|^2``, a query 0 and the length M. Each projection
on a random line is a sorted array. A query opens a window around its own projection on each
line and widens it by virtual rehashing: with radius R the window is as wide as makes a
vector at distance R collide on half of the lines. A vector that collides on enough lines is
verified with its inner product. The search ends at the radius within which the wanted number
of verified vectors lies, which is looked for by halving; as ``MISS`` standard deviations are left to chance, a vector at
that very distance is missed once in 44 times, nearer ones less often.

The vectors are cut into blocks of about ``BLOCK`` rows by a hash of the id, the queries, a
stated part of the rows, into blocks of ``QUERIES``. Each pair of blocks is a task with a
bounded number of rows, and the best of all blocks are merged by a limited window.

Vectors that take part are those of ``vectors.usable``. Copies are vectors like others; ties
go to the smaller id. Rows with the query's own id are no candidates. Other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.llm.common import stage
from newsloom.llm.vectors import matrix, usable

LINES = 64
MISS = 2.0
WIDEN = 1.2
FIRST_RADIUS = 0.2
BLOCK = 16_384
QUERIES = 512
#: If more than this share of a block is verified at once, reading its rows in order costs less
#: than picking them out.
GATHER = 1 / 32

#: Half of a normal distribution lies within this many standard deviations.
HALF = 0.6744897501960817


class Block:
    """The sorted projections of one block."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, longest: float, lines: int, seed: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows, self.longest = ids[order], rows[order], longest
        rest = np.sqrt(np.maximum(longest**2 - (self.rows**2).sum(axis=1), 0))
        self.axes = np.random.default_rng(seed).standard_normal((rows.shape[1] + 1, lines))
        projected = np.hstack([self.rows, rest[:, None]]) @ self.axes
        self.sorted = np.sort(projected, axis=0).T.copy()
        order = np.argsort(projected, axis=0, kind="stable")
        ranks = np.empty(order.shape, dtype=np.uint16 if len(ids) < 1 << 16 else np.uint32)
        np.put_along_axis(ranks, order, np.arange(len(ids), dtype=ranks.dtype)[:, None], axis=0)
        self.ranks = ranks.T.copy()
        self.least = math.floor(lines / 2 - MISS * math.sqrt(lines) / 2)

    def _windows(self, queries: np.ndarray, radii: list[float]) -> tuple[np.ndarray, np.ndarray]:
        """By query, radius and line: the first rank of a window, and how many it holds."""
        reach = HALF * np.array(radii)
        lengths = np.sqrt((queries**2).sum(axis=1))
        at = (queries * (self.longest / lengths)[:, None]) @ self.axes[:-1]
        low = np.empty((len(queries), len(radii), len(self.ranks)), dtype=np.int64)
        high = np.empty_like(low)
        for line, values in enumerate(self.sorted):
            low[:, :, line] = np.searchsorted(values, at[:, line, None] - reach, side="left")
            high[:, :, line] = np.searchsorted(values, at[:, line, None] + reach, side="right")
        return low, high - low

    def _collided(self, low: np.ndarray, width: np.ndarray) -> np.ndarray:
        """Which vectors lie in enough of the windows."""
        kind = self.ranks.dtype
        # ranks below the window wrap around and become large
        inside = (self.ranks - low.astype(kind)[:, None]) < width.astype(kind)[:, None]
        few = np.uint8 if len(self.ranks) < 256 else np.uint32
        return inside.view(np.uint8).sum(axis=0, dtype=few) >= self.least

    def _scores(self, places: np.ndarray, query: np.ndarray) -> np.ndarray:
        return np.einsum("ij,j->i", self.rows[places], query)

    def search(self, own_ids: np.ndarray, queries: np.ndarray, count: int) -> list[list[tuple[int, float]]]:
        """The best ``count`` verified vectors of each query, best first."""
        radii = [FIRST_RADIUS * self.longest]
        while radii[-1] < 2 * self.longest:
            radii.append(radii[-1] * WIDEN)
        low, width = self._windows(queries, radii)
        return [
            self._widen(own, query, count, radii, low[k], width[k])
            for k, (own, query) in enumerate(zip(own_ids, queries, strict=True))
        ]

    def _widen(self, own_id, query, count, radii, low, width) -> list[tuple[int, float]]:
        length = float(np.sqrt((query**2).sum()))
        other = self.ids != own_id
        known = np.full(len(self.ids), np.nan)

        def verified(turn: int) -> tuple[np.ndarray, np.ndarray]:
            # with an endless radius every vector collides on every line
            near = self._collided(low[turn], width[turn]) if turn < len(radii) else other
            found = np.flatnonzero(near & other)
            fresh = found[np.isnan(known[found])]
            if len(fresh) > len(known) * GATHER:
                known[fresh] = (self.rows @ query)[fresh]
            else:
                known[fresh] = self._scores(fresh, query)
            return found, known[found]

        def ends(turn: int) -> bool:
            # so many collisions are needed for ``count`` vectors
            if width[turn].sum() < self.least * count:
                return False
            _, scores = verified(turn)
            if len(scores) < count:
                return False
            worst = np.partition(scores, -count)[-count] / (length * self.longest)
            return self.longest * math.sqrt(max(0.0, 2 - 2 * worst)) <= radii[turn]

        # wider windows hold all that narrower ones do, so the first radius at which the
        # search ends is found by halving
        turn = bisect.bisect_left(range(len(radii)), True, key=ends)
        found, scores = verified(turn)
        if len(found) > count:
            # products of the whole block may differ in the last bits; those kept are summed alike
            slack = 1e-12 * length * self.longest
            found = found[scores >= np.partition(scores, -count)[-count] - slack]
        scores = self._scores(found, query)
        best = np.lexsort((self.ids[found], -scores))[:count]
        return [(int(self.ids[found[i]]), float(scores[i])) for i in best]


def _search(dimensions: int, longest: float, count: int, lines: int, seed: int):
    def run(table: pa.Table) -> pa.Table:
        probe = np.asarray(table["probe"].to_numpy(zero_copy_only=False), dtype=bool)
        ids = table["vec_id"].to_numpy()
        rows = matrix(table["embedding"], dimensions)
        out: list[tuple[int, int, float]] = []
        if probe.any() and not probe.all():
            block = Block(ids[~probe], rows[~probe], longest, lines, seed)
            own = ids[probe]
            for asked, hits in zip(own.tolist(), block.search(own, rows[probe], count), strict=True):
                out += [(asked, *hit) for hit in hits]
        query_id, vec_id, score = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({
            "query_id": pa.array(query_id, pa.int64()),
            "vec_id": pa.array(vec_id, pa.int64()),
            "score": pa.array(score, pa.float64()),
        })

    return run


def nearest(
    rows: DataFrame,
    is_query: Column,
    count: int = 20,
    lines: int = LINES,
    block: int = BLOCK,
    queries: int = QUERIES,
    seed: int = 1,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``rows`` (vec_id, embedding) that
    ``is_query``, the ``count`` other vectors found with the largest inner product."""
    vectors = stage(usable(rows).distinct(), "vectors")
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))
    total, asked, longest, dimensions = vectors.agg(
        F.count("*"), F.count_if(is_query), F.max(norm), F.max(F.size("embedding"))
    ).first()
    blocks, askers = max(1, math.ceil(total / block)), max(1, math.ceil((asked or 0) / queries))
    number = F.pmod(F.xxhash64("vec_id"), F.lit(blocks).cast("bigint"))
    asker = F.pmod(F.xxhash64("vec_id", F.lit("query")), F.lit(askers).cast("bigint"))

    def numbers(upto: int) -> Column:
        return F.sequence(F.lit(0).cast("bigint"), F.lit(upto - 1).cast("bigint"))

    every = vectors.select(
        "vec_id", "embedding", F.lit(False).alias("probe"), number.alias("block"),
        F.explode(numbers(askers)).alias("asker"),
    )
    probes = vectors.where(is_query).select(
        "vec_id", "embedding", F.lit(True).alias("probe"),
        F.explode(numbers(blocks)).alias("block"),
        asker.alias("asker"),
    )
    found = (
        every.unionByName(probes).groupBy("block", "asker")
        .applyInArrow(
            _search(dimensions or 0, longest or 0.0, count, lines, seed),
            "query_id bigint, vec_id bigint, score double",
        )
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= count)
        .select("query_id", "rank", "vec_id", "score")
    )
