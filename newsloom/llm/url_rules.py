"""URL filter by a Bloom filter cascade.

Each rule is a host and the start of a path; it fits its host and all subdomains, and the
longest rule that fits decides. The keys of a URL are all its host suffixes joined with the
starts of its path that have the length of some rule's path. The first level of the cascade
is a Bloom filter of the listed keys, the second one of those keys of the corpus that pass
the first without being listed, the third one of listed keys that pass the second, and so
on until no false positive is left. As the levels are made over all keys of the corpus, the
number of levels a key passes tells exactly whether it is listed, and no row is joined.

The bits of a level are a literal in the plan. Their size follows the number of rules only
(the first level's error rate is set so that about as many false positives are left), and
is checked: beyond ``MAX_LISTED`` rules the keys are joined to the rules instead.

Nulls: a null URL, or one without ``://``, has empty host and path, fits no rule and gets
the default verdict. Rules with a null host are ignored; a null path is empty. Repeated
rules count once, and of two verdicts for one rule "block" holds. Only ``url`` and the id
are read; other columns do no harm. An empty table gives no rows, no rules the default.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import drop, stage

MAX_LISTED = 200_000
MAX_LEVELS = 64
LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def parts(url: str = "url") -> dict[str, Column]:
    """``host`` and ``path`` of a URL."""
    at = F.instr(F.col(url), "://")
    rest = F.substr(F.col(url), at + 3)
    end = "(?s)[/?#].*\\z"
    host = F.translate(F.regexp_replace(rest, end, ""), UPPER, LOWER)
    path = F.regexp_extract(rest, "(?s)\\A[^/?#]*(/[^?#]*)?", 1)
    return {
        "host": F.when(at > 0, host).otherwise(F.lit("")),
        "path": F.when(at > 0, path).otherwise(F.lit("")),
    }


def keys(lengths: list[int]) -> Column:
    """Host suffixes joined with the starts of the path that have the given lengths."""
    labels = F.split("host", "\\.")
    count = F.size(labels)
    hosts = F.transform(
        F.sequence(F.lit(1), count),
        lambda i: F.array_join(F.slice(labels, i, count), "."),
    )
    fitting = F.filter(
        F.array(*(F.lit(n) for n in lengths)), lambda n: F.length("path") >= n
    )
    starts = F.transform(fitting, lambda n: F.left("path", n))
    every = F.flatten(F.transform(hosts, lambda h: F.transform(starts, lambda p: F.concat(h, p))))
    return F.when(F.col("host") != "", every).otherwise(F.array().cast("array<string>"))


def _positions(key: Column, level: int, bits: int, count: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits)) for i in range(count)]


class Level:
    """One Bloom filter: a literal of 64-bit words."""

    def __init__(self, rows: DataFrame, number: int, expected: int, rate: float):
        rate = min(max(rate, 1e-9), 0.5)
        bits = max(64, math.ceil(-expected * math.log(rate) / math.log(2) ** 2))
        self.number, self.bits = number, 64 * math.ceil(bits / 64)
        self.count = max(1, round(self.bits / max(1, expected) * math.log(2)))
        self.count = min(self.count, 24)
        places = _positions(F.col("key"), number, self.bits, self.count)
        found = (
            rows.select(F.explode(F.array(*places)).alias("at"))
            .groupBy(F.expr("at div 64").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits"))
        )
        words = np.zeros(self.bits // 64, dtype=np.int64)
        for row in found.toLocalIterator():  # at most bits / 64 rows, which the rules bound
            words[row["word"]] = row["bits"]
        self.words = words

    def passes(self, key: Column) -> Column:
        words = F.lit(self.words)
        tests = (
            F.getbit(F.get(words, F.floor(p / 64).cast("int")), (p % 64).cast("int")) == 1
            for p in _positions(key, self.number, self.bits, self.count)
        )
        return reduce(and_, tests)


class Cascade:
    """Exact membership in ``listed`` for every key of ``universe`` (columns ``key``)."""

    def __init__(self, listed: DataFrame, universe: DataFrame):
        listed = stage(listed.distinct(), "listed")
        inside, size = listed, listed.count()
        keys_seen = universe.agg(F.approx_count_distinct("key")).first()[0]
        # the first level leaves about as many false positives as there are listed keys
        self.levels = [Level(listed, 1, size, size / max(1, keys_seen) / math.sqrt(2))]
        outside = stage(
            universe.where(self.levels[0].passes(F.col("key"))).distinct()
            .join(listed, "key", "left_anti"),
            "outside",
        )
        while (left := outside.count()) and len(self.levels) < MAX_LEVELS:
            level = Level(outside, len(self.levels) + 1, left, 0.5)
            self.levels.append(level)
            kept = stage(inside.where(level.passes(F.col("key"))), "cascade")
            drop(inside)
            inside, outside = outside, kept
        if outside.count():
            raise RuntimeError(f"the cascade did not close within {MAX_LEVELS} levels")
        drop(inside)
        drop(outside)

    def holds(self, key: Column) -> Column:
        """Listed are the keys whose first failed level is even, or that pass an odd number."""
        found = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            found = F.when(level.passes(key), found).otherwise(F.lit(level.number % 2 == 0))
        return found


def judge(
    pages: DataFrame, rules: DataFrame, default: str = "allow", max_listed: int = MAX_LISTED
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of each row of ``pages`` (``page_id, url``)
    under ``rules`` (``host, path, verdict``)."""
    split = pages.select("page_id", "url").withColumns(parts()).drop("url")
    listed = stage(
        rules.where(F.col("host").isNotNull())
        .select(
            F.concat("host", F.coalesce("path", F.lit(""))).alias("key"),
            F.length(F.coalesce("path", F.lit(""))).alias("length"),
            "verdict",
        )
        .groupBy("key", "length").agg(F.max("verdict").alias("verdict")),
        "rules",
    )
    if listed.isEmpty():
        return split.select(
            "*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")
        )
    lengths = sorted(r[0] for r in listed.select("length").distinct().collect())
    keyed = split.withColumn("keys", keys(lengths))
    universe = keyed.select(F.explode("keys").alias("key"))
    if listed.count() > max_listed:
        return _by_join(keyed, listed, default)
    every = Cascade(listed.select("key"), universe)
    blocked = listed.where(F.col("verdict") == "block").select("key")
    # which listed keys block: a cascade over the listed keys alone
    block = Cascade(blocked, listed.select("key")) if not blocked.isEmpty() else None
    fits = F.filter("keys", every.holds)
    longest = F.array_max(F.transform(fits, lambda k: F.struct(F.length(k).alias("n"), k.alias("k"))))
    verdict = F.when(block.holds(F.col("rule")), "block").otherwise("allow") if block else F.lit("allow")
    return keyed.withColumn("rule", longest["k"]).select(
        "page_id", "host", "path", "rule",
        F.when(F.col("rule").isNull(), F.lit(default)).otherwise(verdict).alias("verdict"),
    )


def _by_join(keyed: DataFrame, listed: DataFrame, default: str) -> DataFrame:
    """The same result by a join, for lists too long for a literal."""
    own = keyed.withColumn("_row", F.monotonically_increasing_id())
    own = stage(own, "keyed")
    best = (
        own.select("_row", F.explode("keys").alias("key"))
        .join(listed, "key")
        .groupBy("_row")
        .agg(F.max(F.struct(F.length("key").alias("n"), "key", "verdict")).alias("best"))
    )
    return own.join(best, "_row", "left").select(
        "page_id", "host", "path", F.col("best.key").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
