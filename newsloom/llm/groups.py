"""Connected groups: of given links, and of links that are looked for inside buckets.

Everything is joins and aggregates of narrow rows; a hot node or bucket meets only in joins,
whose partitions adaptive execution splits. Each round ends in a staged table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import drop, stage

#: Centres per bucket grow by this factor from round to round.
GROWTH = 32


def roots(parents: DataFrame) -> DataFrame:
    """``node, component`` from one row ``b, a`` (a < b) per node b with a parent: pointers
    are followed two at a time until each leads to the top of its tree."""
    now = stage(parents.select("b", "a"), "parents")
    while True:
        above = now.select(F.col("b").alias("a"), F.col("a").alias("_up"))
        after = stage(
            now.select("b", "a").join(above, "a", "left")
            .select("b", F.coalesce("_up", "a").alias("a"), F.col("_up").isNotNull().alias("_on")),
            "parents",
        )
        drop(now)
        now = after
        if now.where("_on").isEmpty():
            return now.select(F.col("b").alias("node"), F.col("a").alias("component"))


def _relabel(edges: DataFrame, found: DataFrame) -> DataFrame:
    """Edges between the components of their ends."""
    for end in ("a", "b"):
        named = found.select(F.col("node").alias(end), F.col("component").alias("_top"))
        edges = edges.join(named, end, "left").withColumn(end, F.coalesce("_top", end)).drop("_top")
    return (
        edges.where("a != b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of an undirected graph given as bigint columns ``a, b``: the
    smallest node that can be reached, for each node from which a smaller one can be.

    Each node hooks onto its smallest smaller neighbour, the trees are flattened, and the
    edges left between trees do the same again, until there are none."""
    left = stage(
        edges.where("a != b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
    )
    found = None
    while not left.isEmpty():
        hooked = roots(left.groupBy("b").agg(F.min("a").alias("a")))
        after = stage(_relabel(left, hooked), "edges")
        drop(left)
        left = after
        if found is None:
            found = hooked
            continue
        tops = hooked.select(F.col("node").alias("component"), F.col("component").alias("_top"))
        moved = found.join(tops, "component", "left").select(
            "node", F.coalesce("_top", "component").alias("component")
        )
        found = stage(moved.unionByName(hooked), "components")
    if found is None:
        return left.select(F.col("a").alias("node"), F.col("a").alias("component"))
    return found


def open_pairs(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of different groups, with what else they have."""
    columns = pairs.columns
    for end in ("b", "a"):
        tops = found.select(F.col("node").alias(end), F.col("component").alias(f"_{end}"))
        pairs = pairs.join(tops, end, "left")
    return pairs.where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select(*columns)


def joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """Groups after more links, of which there may be none."""
    if links.isEmpty():
        return found
    between = components(_relabel(links, found))
    tops = between.select(F.col("node").alias("component"), F.col("component").alias("_top"))
    moved = found.join(tops, "component", "left").select(
        "node", F.coalesce("_top", "component").alias("component")
    )
    fresh = between.join(found.select("node"), "node", "left_anti")
    return stage(moved.unionByName(fresh), "groups")


def grow(
    members: DataFrame,
    confirm: Callable[[DataFrame], DataFrame],
    carried: tuple[str, ...] = (),
    may: Column | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """``node, component`` of the links that ``confirm`` finds inside buckets.

    ``members`` has ``bucket, node, n, centre`` (members of the bucket, its smallest node)
    and ``carried`` columns of the node; the symmetric condition ``may`` on them, as
    ``a_<column>`` and ``b_<column>``, can rule a pair out. Only stars are compared: first each node with the centre it shares most buckets
    with, then with the other centres. Where a bucket still holds nodes of several groups,
    more centres are drawn, ``GROWTH`` times as many in each round, and compared with the
    members of other groups, until a bucket is one group or all its members have been
    centres: no link between buckets' members that would join two groups is left out.

    ``finish`` can take the place of the rounds after the stars: it is given the members of
    the open buckets with their ``component`` and returns links ``a, b`` that join all
    groups of a bucket that have any link. ``known`` are groups found before, which stay and
    are not compared again; the result has them too."""
    own = members.select("node", *carried).distinct()

    def allowed(pairs: DataFrame) -> DataFrame:
        if may is None:
            return pairs.select("a", "b")
        for side in ("a", "b"):
            pairs = pairs.join(
                own.select(F.col("node").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in carried)),
                side,
            )
        return pairs.where(may).select("a", "b")

    stars = members.where("node != centre").groupBy("node", "centre").agg(F.count("*").alias("k"))
    first = stars.groupBy("node").agg(
        F.max_by("centre", F.struct("k", -F.col("centre"))).alias("centre")
    )
    pairs = first.select(F.col("centre").alias("a"), F.col("node").alias("b"))
    if known is not None:
        pairs = open_pairs(pairs, known)
    links = stage(confirm(allowed(pairs)), "links")
    if known is None:
        found = roots(links)
    else:
        found = joined(known, links)
    width = 1
    while True:
        live = members.join(found, "node", "left").withColumn(
            "component", F.coalesce("component", "node")
        )
        spread = (
            live.groupBy("bucket")
            .agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
            .where("_low < _high").select("bucket")
        )
        live = stage(live.join(spread, "bucket"), "live")
        widest = live.agg(F.max("n")).first()[0]
        if widest is None:
            return found
        if finish is not None and width > 1:
            return joined(found, stage(finish(live), "links"))
        if width == 1:
            chosen = F.col("node") == F.col("centre")
        else:  # about ``width`` of each bucket, all of a small one
            draw = F.pmod(F.xxhash64("bucket", "node"), F.lit(1 << 30)) / float(1 << 30)
            chosen = draw * F.col("n") < width
        centres = live.where(chosen).select(
            "bucket", F.col("node").alias("_centre"), F.col("component").alias("_group"),
            *(F.col(c).alias(f"b_{c}") for c in carried),
        )
        met = live.select(
            "bucket", "node", "component", *(F.col(c).alias(f"a_{c}") for c in carried)
        ).join(centres, "bucket")
        # pairs that are ruled out end in the join
        apart = F.col("component") != F.col("_group")
        pairs = (
            met.where(apart if may is None else apart & may)
            .select(F.least("node", "_centre").alias("a"), F.greatest("node", "_centre").alias("b"))
            .distinct()
        )
        found = joined(found, stage(confirm(pairs), "links"))
        drop(live)
        if width > 1 and width >= widest:
            return found
        width *= GROWTH
