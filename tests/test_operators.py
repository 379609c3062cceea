"""Operators on rows: first rows, running sums, joins, limits, change, extraction, merge."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from newsloom.operators import skew
from newsloom.operators.change import (
    change_status,
    first_seen,
    fresh_links,
    mark_known,
    merge_section_snapshots,
    merge_url_index,
    section_diff,
    split_invalid,
)
from newsloom.operators.classify import classify, early_reason
from newsloom.operators.extract import KeywordExtractor, extract_with
from newsloom.operators.merge import merge_news
from newsloom.operators.runs import check_sum, freshness_stats, run_totals, source_stats
from newsloom.operators.select import cap_items, cap_new_rows, first_sections, mark_duplicates
from newsloom.schemas import EXTRACTION, NEWS, URL_INDEX
from newsloom.specs import RunConfig, limited


def scan_rows(spark, seed=7, sources=6, repeats=4):
    """Random scan rows; one source holds a third of them and one key a third of those."""
    rng = random.Random(seed)
    rows = []
    for source in range(sources):
        n = 400 if source == 0 else 160
        places = rng.sample([(s, p) for s in range(40) for p in range(40)], n)
        for section, pos in places:
            hot = rng.random() < 0.33
            key = None if rng.random() < 0.1 else "hot" if hot else f"k{rng.randrange(n // repeats)}"
            rows.append(("r", f"s{source}", section, pos, key, rng.random() < 0.3))
    rng.shuffle(rows)
    ddl = "run_id string, source_id string, section_ord int, link_pos int, entry_key string, good boolean"
    return rows, spark.createDataFrame(rows, ddl).repartition(5)


def by_source(rows):
    out = {}
    for row in sorted(rows, key=lambda r: r[1:4]):
        out.setdefault(row[1], []).append(row)
    return out


@pytest.mark.parametrize("bounded", [True, False])
def test_duplicates_equal_a_seen_set(spark, bounded):
    rows, df = scan_rows(spark)
    want = {}
    for source, ordered in by_source(rows).items():
        seen = set()
        for row in ordered:
            want[(source, row[2], row[3])] = row[4] is not None and row[4] in seen
            seen.add(row[4])
    got = mark_duplicates(df, 200 if bounded else None).collect()
    assert {(r.source_id, r.section_ord, r.link_pos): r.is_duplicate for r in got} == want


@pytest.mark.parametrize("max_items, max_new", [(50, 7), (None, 30), (None, 400), (50, None)])
def test_limits_equal_a_loop(spark, max_items, max_new):
    rows, df = scan_rows(spark, seed=11)
    want = set()
    for source, ordered in by_source(rows).items():
        scanned = new = 0
        for row in ordered:
            if max_items is not None and scanned >= max_items:
                break
            if max_new is not None and new >= max_new:
                break
            scanned += 1
            new += row[5]
            want.add((source, row[2], row[3]))
    kept = cap_new_rows(cap_items(df, max_items), max_new, F.col("good"), max_items)
    got = [(r.source_id, r.section_ord, r.link_pos) for r in kept.collect()]
    assert len(got) == len(want) and set(got) == want


def test_range_wise_limit_equals_the_window(spark, monkeypatch):
    rows, df = scan_rows(spark, seed=3)
    plain = {tuple(r) for r in cap_items(df, 30).collect()}
    monkeypatch.setattr("newsloom.operators.select.WINDOW_CAP", 10)
    assert {tuple(r) for r in cap_items(df, 30).collect()} == plain


def test_first_rows(spark):
    rows, df = scan_rows(spark)
    first = skew.keep_first(df.where("entry_key is not null"), ["entry_key"], ["source_id", "section_ord", "link_pos"])
    want = {}
    for row in sorted(rows, key=lambda r: r[1:4]):
        if row[4] is not None:
            want.setdefault(row[4], row)
    assert {r.entry_key: tuple(r) for r in first.collect()} == want
    last = skew.keep_first(df, ["source_id"], ["section_ord", "link_pos"], last=True)
    assert {r.source_id: tuple(r) for r in last.collect()} == {
        k: v[-1] for k, v in by_source(rows).items()
    }
    flagged = skew.flag_first(df, ["source_id"], ["section_ord", "link_pos"]).where("is_first")
    assert {r.source_id: tuple(r)[:-1] for r in flagged.collect()} == {
        k: v[0] for k, v in by_source(rows).items()
    }
    assert first_seen(df, ["source_id"], ["section_ord", "link_pos"]).count() == 6


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
@pytest.mark.parametrize("hot_rows", [10, 10**9])
def test_spread_join_equals_a_plain_join(spark, how, hot_rows):
    rows, df = scan_rows(spark)
    keys = sorted({r[4] for r in rows if r[4]})
    right = spark.createDataFrame([(k,) for k in keys if k != "k3"], "entry_key string")
    if how in ("left", "inner"):
        right = right.withColumn("found", F.upper("entry_key"))
    spread = skew.spread_join(df, right, ["entry_key"], how, hot_rows=hot_rows)
    plain = df.join(right, "entry_key", how)
    assert spread.columns == plain.columns
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))
    bounded = skew.spread_join(df, right, ["entry_key"], how, max_rows=10)
    assert bounded.count() == plain.count()


def test_hot_keys_are_spread(spark):
    rows, df = scan_rows(spark)
    right = spark.createDataFrame([("hot", 1)], "entry_key string, x int")
    joined = skew.spread_join(df.where("entry_key = 'hot'"), right, ["entry_key"], "inner", hot_rows=10)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        used = joined.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert used > 1


def test_thousands_of_hot_keys_are_spread_by_their_counts(spark):
    keys = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7 * 10).alias("n"))
    left = keys.select("k", F.explode(F.sequence(F.lit(0), F.col("n"))).alias("x")).repartition(16)
    right = keys.select("k", (F.col("k") * 2).alias("y"))
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salts = skew.hot_keys(left, ["k"], 10, 16).groupBy("_salts").count().collect()
        assert sum(r["count"] for r in salts) == keys.where("n >= 9").count()
        assert {r["_salts"] for r in salts} == {2, 3, 4, 5, 6, 7}
        joined = skew.spread_join(left, right, ["k"], "inner", hot_rows=10)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == left.count() and max(sizes) < 1.3 * sum(sizes) / 16
        assert joined.where("y != k * 2").count() == 0
        one = left.withColumn("k", F.lit(7).cast("bigint"))
        sizes = [r["count"] for r in skew.spread_join(one, right, ["k"], hot_rows=1000)
                 .groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == left.count() and max(sizes) < 0.4 * sum(sizes)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_sections(spark):
    df = spark.createDataFrame([("a", i) for i in range(12)] + [("b", 0)], "source_id string, section_ord int")
    assert first_sections(df, 10).count() == 11


def test_fresh_links_keep_their_spelling(spark):
    news = spark.createDataFrame([("https://h.com/known",), ("junk",)], "source_url string")
    links = spark.createDataFrame(
        [("https://www.h.com/known/?utm=1", 0), ("https://h.com/New/", 1), ("https://h.com/New/", 2)],
        "url string, place int",
    )
    got = {tuple(r) for r in fresh_links(links, news).collect()}
    assert got == {("https://h.com/New/", 1), ("https://h.com/New/", 2)}
    stats = freshness_stats(mark_known(links, news).withColumn("source_id", F.lit("s"))).first()
    assert tuple(stats) == ("s", 3, 2, 1)
    good, bad = split_invalid(links.union(spark.createDataFrame([("nope", 9)])))
    assert (good.count(), bad.first().url) == (3, "nope")


def test_change_status(spark):
    from newsloom.functions.identity import entry_key

    index = spark.createDataFrame(
        [
            ("same", "h", None, "r", True),
            ("other", "old", None, "r", True),
            ("todo", "h", None, "r", False),
            ("blank", "h", None, "r", True),
            ("unknown", None, None, "r", None),
        ],
        URL_INDEX,
    )
    rows = spark.createDataFrame(
        [("same", "h"), ("other", "h"), ("todo", "h"), ("blank", "h"), ("absent", "h"), ("unknown", "h"), (None, None)],
        "url string, content_hash string",
    )
    news = index.select(entry_key("url", "content_hash").alias("entry_key"), F.when(F.col("url") == "blank", " ").otherwise("s").alias("news_summary"))
    got = {r.url: r.change_status for r in change_status(rows, index, news).collect()}
    assert got == {
        "same": "unchanged",
        "other": "updated",
        "todo": "retry",
        "blank": "retry",
        "absent": "new",
        "unknown": "new",
        None: "new",
    }
    assert change_status(rows, None).select("change_status").distinct().first()[0] == "new"


def test_section_diff_and_snapshots(spark):
    now = spark.createDataFrame(
        [("a", "h1"), ("b", "h2"), ("c", "h3"), ("d", None)], "section_url string, link_hash string"
    )
    before = spark.sql(
        "SELECT * FROM VALUES ('a', 'h1', timestamp'2024-01-01'), ('b', 'x', timestamp'2024-01-01'), "
        "('d', 'h', timestamp'2024-01-01'), ('e', 'h', timestamp'2024-01-01') "
        "AS t(section_url, content_hash, checked_at)"
    )
    got = {r.section_url: r.is_unchanged for r in section_diff(now, before).collect()}
    assert got == {"a": True, "b": False, "c": False, "d": False}
    current = now.where("link_hash is not null").selectExpr(
        "section_url", "link_hash AS content_hash", "timestamp'2024-01-02' AS checked_at"
    )
    merged = merge_section_snapshots(before, current)
    assert {r.section_url: r.content_hash for r in merged.collect()} == {
        "a": "h1", "b": "h2", "c": "h3", "d": "h", "e": "h",
    }
    again = merge_section_snapshots(merged, current)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, merged.collect()))


def test_url_index_takes_the_last_row(spark):
    empty = spark.createDataFrame([], URL_INDEX)
    run = spark.sql(
        "SELECT * FROM VALUES ('u', 'h1', timestamp'2024-01-01', 'r', true, 1), "
        "('u', 'h2', timestamp'2024-01-01', 'r', false, 2) "
        "AS t(url, content_hash, last_seen_at, last_run_id, extraction_complete, seq)"
    )
    row = merge_url_index(empty, run).collect()
    assert [(r.content_hash, r.extraction_complete) for r in row] == [("h2", False)]


def news(spark, rows):
    full = [(k, u, s, n, None, "d", "x", status, None, "h", seq) for k, u, s, n, status, seq in rows]
    return spark.createDataFrame(full, NEWS + ", seq int")


def test_news_upsert(spark):
    first = news(spark, [("key-1", "u", "agfunder", "Original", "new", 0)])
    second = news(
        spark,
        [
            ("key-1", "u2", "inc42", "Renamed", "updated", 5),
            ("key-1", "u3", "inc42", "Earlier", "updated", 4),
            ("key-2", "v", "inc42", "Second", "new", 6),
        ],
    )
    once = merge_news(spark.createDataFrame([], NEWS), first)
    merged = merge_news(once, second)
    got = {r.entry_key: (r.source_url, r.source_id, r.startup_name, r.entry_status) for r in merged.collect()}
    assert got == {
        "key-1": ("u", "agfunder", "Renamed", "updated"),
        "key-2": ("v", "inc42", "Second", "new"),
    }
    again = merge_news(merged, second)
    assert sorted(map(str, again.collect())) == sorted(map(str, merged.collect()))


def articles(spark, rows):
    return spark.createDataFrame(rows, "url string, title string, body_excerpt string")


def test_extractor_failures_stay_with_their_row(spark):
    def fussy(payloads):
        if any('"bad"' in p for p in payloads):
            raise RuntimeError("no")
        return ['{"isRelevant": true, "startupName": "N", "newsSummary": "S"}' for _ in payloads]

    rows = [("u1", "good", "b"), ("u2", "bad", "b"), ("u3", "good", "b"), ("u4", "skip", "b")]
    df = extract_with(articles(spark, rows).coalesce(1), fussy, F.col("title") != "skip")
    got = {r.url: r.extraction for r in df.collect()}
    assert got["u1"].is_relevant and got["u3"].startup_name == "N"
    assert got["u2"].extraction_failed and not got["u2"].is_relevant
    assert got["u4"] is None


def test_extractor_sees_a_cut_body_once_per_row(spark):
    calls = spark.sparkContext.accumulator(0)

    def count(payloads):
        calls.add(len(payloads))
        return [None if len(p) > 200 else '{"isRelevant": false}' for p in payloads]

    df = extract_with(articles(spark, [("u", "t", "x" * 5000)] * 3), count, max_chars=50, parallelism=3)
    rows = df.select("extraction.*").collect()
    assert calls.value == 3 and not any(r.extraction_failed for r in rows)


def test_keyword_extractor(spark):
    rows = [
        ("u1", "Tide raises $1.5m", "See https://tideworks.com for it. More."),
        ("u2", "Weather", "Nothing here."),
        ("u3", "Quiet title", "The firm raised money"),
    ]
    got = {r.url: r.extraction for r in extract_with(articles(spark, rows), KeywordExtractor()).collect()}
    assert got["u1"].startup_name == "Tide" and got["u1"].startup_website == "https://tideworks.com"
    assert got["u1"].news_summary == "See https://tideworks.com for it."
    assert not got["u2"].is_relevant and got["u3"].news_summary is None


OUTCOMES = [
    # url, fetch error, wall, title, body, key, dup, change, extraction -> action, reason
    ((None, None, False, "t", "b", None, False, "new", None), "error", "invalid_url"),
    (("u", "HTTP 500", True, "", "", None, False, "new", None), "error", "article_fetch: HTTP 500"),
    (("u", None, True, "", "", None, False, "new", None), "error", "login_required"),
    (("u", None, False, "", "b", None, False, "new", None), "skipped", "missing_title"),
    (("u", None, False, None, "b", None, False, "new", None), "skipped", "missing_title"),
    (("u", None, False, " ", "b", None, False, "new", None), "skipped", "empty_body"),
    (("u", None, False, "t", " ", None, False, "new", None), "skipped", "empty_body"),
    (("u", None, False, "t", "b", "k", True, "unchanged", None), "skipped", "duplicate_in_run"),
    (("u", None, False, "t", "b", "k", False, "unchanged", None), "skipped", "unchanged_content"),
    (("u", None, False, "t", "b", "k", False, "new", None), "error", "extraction_failed"),
    (("u", None, False, "t", "b", "k", False, "new", (False, None, None, None, None, True)), "error", "extraction_failed"),
    (("u", None, False, "t", "b", "k", False, "new", (False, "n", None, None, "s", False)), "not_relevant", None),
    (("u", None, False, "t", "b", "k", False, "new", (True, "n", None, None, None, False)), "error", "incomplete_extraction"),
    (("u", None, False, "t", "b", "k", False, "retry", (True, "n", None, None, "s", False)), "new", None),
    (("u", None, False, "t", "b", "k", False, "updated", (True, "n", None, None, "s", False)), "updated", None),
]


def test_classification_order(spark):
    ddl = (
        "url string, fetch_error string, paywalled boolean, title string, body_excerpt string, "
        f"entry_key string, is_duplicate boolean, change_status string, extraction {EXTRACTION}, place int"
    )
    rows = [case + (i,) for i, (case, *_) in enumerate(OUTCOMES)]
    df = spark.createDataFrame(rows, ddl).withColumn("min_body_chars", F.lit(1))
    df = df.withColumn("early_reason", early_reason())
    done = classify(df, True).orderBy("place").collect()
    assert [(r.action, r.reason) for r in done] == [(a, b) for _, a, b in OUTCOMES]
    off = classify(df, False).orderBy("place").collect()
    assert {r.reason for r in off[9:]} == {"ai_disabled"}
    assert classify(df, True, "current").orderBy("place").collect()[-1].action == "new"


def test_counters(spark):
    rows = [("r", "a", "section", None), ("r", "a", "section", "section_unchanged")]
    rows += [("r", "a", "section", "error"), ("r", "a", "article", "new")]
    rows += [("r", "a", "article", x) for x in ("updated", "skipped", "not_relevant", "error")]
    rows += [("r", "b", "article", "new")]
    df = spark.createDataFrame(rows, "run_id string, source_id string, kind string, action string")
    took = spark.createDataFrame([("a", 5), ("b", 7)], "source_id string, duration_ms long")
    stats = source_stats(df, took)
    assert {r.source_id: tuple(r)[2:] for r in stats.collect()} == {
        "a": (3, 1, 5, 1, 1, 1, 1, 2, 5),
        "b": (0, 0, 1, 1, 0, 0, 0, 0, 7),
    }
    assert tuple(run_totals(stats).first())[1:] == (3, 1, 6, 2, 1, 1, 1, 2, 12)
    events = df.where("action is not null").count()
    assert check_sum(stats).agg(F.sum("events")).first()[0] == events


def test_settings_are_checked():
    config = RunConfig("r", "d", "s")
    assert (config.max_items, config.max_new_rows, config.max_sections) == (None, None, None)
    usual = limited(config)
    assert (usual.max_items, usual.max_new_rows, usual.max_sections) == (50, 20, 10)
    with pytest.raises(ValueError):
        replace(config, store_tables=False)
    with pytest.raises(ValueError):
        replace(config, status_mode="x")
    with pytest.raises(ValueError):
        replace(config, max_items=0)
