"""Mix sources to target weights: Efraimidis-Spirakis sampling within each source.

Sources in code point order (null last) take the weights in turn and share the words of all
documents. A target stops at ``max_epochs`` times its source's words; the excess goes to the
others by weight until none is above. A source's target is met by whole passes over its
documents first, then by a weighted sample without replacement: each document draws the key
``-ln(u) / weight`` and the smallest keys are taken as long as their sizes fit the rest;
two more rounds fill what is left open with the next documents short enough for it.

Nulls: a null source is a source of its own, a null text has size 0, a null id draws as
the text "null". Equal rows draw the same key and are taken together. Empty documents count
as taken 0. An empty table gives an empty result. Other columns of the input are ignored;
those named like results do no harm.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import WORD, running_sums, stage, uniform

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix"
#: After the first cut, shorter documents fill what the one at the cut left open.
ROUNDS = 3
NO_ID = -(2**63)


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def quality_weight(text: str, size: Column) -> Column:
    """How near the mean word length is to that of prose (6 with the blank), from 0.1 to 1."""
    mean = F.length(text) / F.greatest(size, F.lit(1))
    return F.greatest(F.lit(0.1), F.lit(1.0) - F.abs(F.coalesce(mean, F.lit(0.0)) - 6.0) / 12.0)


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS):
    """``source, source_size, target`` from ``source, source_size``.

    Sorted by the multiple of the weight at which a source is full, the sources before some
    place are full and the others get the same amount for a unit of weight: that level is
    the largest at whose place the source is not full. Only that number reaches the driver."""
    ranked = running_sums(
        sizes.withColumns({
            "_null": F.col("source").isNull().cast("int"),
            "_name": F.coalesce("source", F.lit("")),
            "_one": F.lit(1),
        }),
        [], ["_null", "_name"], {"_rank": "_one"},
    )
    kinds = F.array(*map(F.lit, weights))
    weighed = ranked.select(
        "source", "source_size", "_rank",
        F.element_at(kinds, (F.col("_rank") % len(weights) + 1).cast("int"))
        .cast("bigint").alias("_weight"),
        (F.col("source_size") * max_epochs).alias("_full"),
    ).withColumn("_level", F.col("_full") / F.col("_weight"))
    weighed = stage(weighed, "sources")
    total, weight = weighed.agg(F.sum("source_size"), F.sum("_weight")).first()
    if total is None:
        return weighed.select("source", "source_size", F.lit(0.0).alias("target"))
    placed = running_sums(
        weighed, [], ["_level", "_rank"], {"_full_before": "_full", "_weight_before": "_weight"}
    ).withColumn(
        "_share", (F.lit(total) - F.col("_full_before")) / (F.lit(weight) - F.col("_weight_before"))
    )
    level = placed.where(F.col("_level") >= F.col("_share")).agg(F.max("_share")).first()[0]
    target = F.least(F.col("_full").cast("double"), F.lit(float(level or 0)) * F.col("_weight"))
    return weighed.select("source", "source_size", target.alias("target"))


def plan_mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    quality: Column | None = None,
    rounds: int = ROUNDS,
) -> DataFrame:
    """The mix as one row per source: ``source, source_size, target, epochs`` and ``cuts``,
    one struct ``most, key, id`` per round: documents of at most ``most`` words whose (key,
    id) is at most the cut are taken once more.

    ``docs`` has ``doc_id, text, source``; ``quality`` replaces the weight of a document.
    Keys are sorted and summed in ranges, so a source may hold any share of the rows."""
    sized = stage(
        keyed(docs.select("doc_id", "text", "source"), seed, quality)
        .select("source", "size", "_key", F.coalesce("doc_id", F.lit(NO_ID)).alias("_id")),
        "sizes",
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    epochs = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    planned = stage(
        targets(sizes, weights, max_epochs).withColumns({"epochs": epochs, **_named()}), "targets"
    )
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    now = planned.select(
        "_null", "_name", rest.alias("_rest"),
        F.array().cast("array<struct<most:double,key:double,id:bigint>>").alias("cuts"),
    )
    once = (
        sized.where(F.col("size") > 0).withColumns(_named())
        .groupBy("_null", "_name", "_key", "_id").agg(F.sum("size").alias("size"))
    )
    for _ in range(rounds):
        now = stage(now, "cuts")
        fitting = (
            once.join(now, ["_null", "_name"])
            .where((F.col("size") <= F.col("_rest")) & ~is_cut())
            .select("_null", "_name", "_key", "_id", "size", "_rest")
        )
        before = running_sums(fitting, ["_null", "_name"], ["_key", "_id"], {"_before": "size"})
        taken = (
            before.where(F.col("_before") + F.col("size") <= F.col("_rest"))
            .groupBy("_null", "_name")
            .agg(F.max(F.struct("_key", "_id")).alias("_last"), F.sum("size").alias("_sum"))
        )
        cut = F.struct(
            F.col("_rest").alias("most"), F.col("_last._key").alias("key"),
            F.col("_last._id").alias("id"),
        )
        now = now.join(taken, ["_null", "_name"], "left").select(
            "_null", "_name",
            (F.col("_rest") - F.coalesce("_sum", F.lit(0))).alias("_rest"),
            F.when(F.col("_sum").isNull(), F.col("cuts"))
            .otherwise(F.array_append("cuts", cut)).alias("cuts"),
        )
    return planned.join(now, ["_null", "_name"], "left").select(
        "source", "source_size", "target", "epochs", "cuts"
    )


def _named() -> dict[str, Column]:
    """A source without nulls, for joins and windows."""
    return {
        "_null": F.col("source").isNull().cast("int"), "_name": F.coalesce("source", F.lit(""))
    }


def is_cut() -> Column:
    """Was the row, with ``size, _key, _id`` and the ``cuts`` of its source, taken in a round?"""
    return F.exists(
        "cuts",
        lambda c: (F.col("size") <= c["most"])
        & (F.struct("_key", "_id") <= F.struct(c["key"], c["id"])),
    )


def keyed(docs: DataFrame, seed: str = SEED, quality: Column | None = None) -> DataFrame:
    """The columns of ``docs`` with ``size`` and the sampling key ``_key``."""
    sized = docs.withColumn("size", words())
    weight = quality if quality is not None else quality_weight("text", F.col("size"))
    draw = uniform(F.col("doc_id").cast("string"), seed=seed)
    return sized.withColumn("_key", -F.log(draw) / weight)


def mix(docs: DataFrame, **settings) -> DataFrame:
    """``doc_id, text, lang, source, n_chars`` as far as given, with ``size, source_size,
    target, taken, copies``; one row per document."""
    own = [c for c in ("doc_id", "text", "lang", "source", "n_chars") if c in docs.columns]
    planned = stage(plan_mix(docs, **settings), "mix").withColumnRenamed("source", "_source")
    seed, quality = settings.get("seed", SEED), settings.get("quality")
    rows = (
        keyed(docs.select(*own), seed, quality)
        .join(planned, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_id", F.coalesce("doc_id", F.lit(NO_ID)))
    )
    more = F.when((F.col("size") > 0) & is_cut(), 1).otherwise(0)
    return (
        rows.withColumn("copies", (F.col("epochs") + more).cast("int"))
        .withColumn("taken", F.col("size") * F.col("copies"))
        .select(*own, "size", "source_size", "target", "taken", "copies")
    )
