"""Whole jobs, stores, recorded files and streams."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.operators.extract import KeywordExtractor
from newsloom.plans.complete import complete_run, run_cycle
from newsloom.plans.discover import State, discover
from newsloom.session import stage, staging_root
from newsloom.sites import AGFUNDER, INC42_FEED, SOURCES
from newsloom.sources import tables
from newsloom.sources.store import Store, export_flat
from newsloom.specs import RunConfig, Section, enabled
from newsloom.streaming.incremental import read_page_stream, stream_cycles

BASE = "https://agfundernews.com"
FEED = "https://inc42.com/industry/agritech/"
SITE = replace(
    AGFUNDER,
    sections=(Section("home", f"{BASE}/", "high"), Section("tag", f"{BASE}/tag/agtech", "high"),
              Section("lost", f"{BASE}/tag/lost", "low")),
)


def config(run, **changes):
    day = f"2026-06-{run:02d}"
    base = RunConfig(f"{day}T00-00-00-000Z", day, f"{day}T00:00:00.000Z")
    return replace(base, **changes)


def done_at(run):
    return f"2026-06-{run:02d}T01:00:00Z"


def article(title, body):
    return f"<html><h1>{title}</h1><div class='article-content'><p>{body}</p></div></html>"


def listing(*paths):
    return "<html>" + "".join(f"<a href='{p}'>x</a>" for p in paths) + "</html>"


def page_table(spark, pages):
    rows = [(u, h, None, None) for u, h in pages.items()]
    return spark.createDataFrame(rows, schemas.PAGES)


def pages_of(run):
    pages = {
        f"{BASE}/": listing("/alpha-raises", "/weather", "/gone", "/tag/x"),
        f"{BASE}/tag/agtech": listing("/alpha-raises", "/no-title", "/empty", "/half"),
        f"{BASE}/alpha-raises": article("Alpha raises $1m", "Alpha raised seed money. More."),
        f"{BASE}/weather": article("Weather", "Rain all day."),
        f"{BASE}/no-title": article("", "text"),
        f"{BASE}/empty": article("Title", " "),
        f"{BASE}/half": article("Half", "They raised money"),
    }
    if run >= 3:
        # the home page is as before; on the tag page one article is new
        pages[f"{BASE}/tag/agtech"] = listing("/alpha-raises", "/half", "/beta-bags")
        pages[f"{BASE}/alpha-raises"] = article("Alpha raises $2m", "Alpha raised more. Yes.")
        pages[f"{BASE}/half"] = article("Half", "They raised money")
        pages[f"{BASE}/beta-bags"] = article("Beta bags $3m", "Beta raised it. Good.")
    return pages


def events(result):
    return {
        (r.source_id, r.url, r.action): r.reason
        for r in result.outcomes.select("source_id", "url", "action", "reason").collect()
    }


def test_three_runs_of_an_html_source(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    extractor = KeywordExtractor()

    def run(n, **changes):
        table = page_table(spark, pages_of(n))
        return run_cycle(spark, [SITE], config(n, **changes), done_at(n), store, pages=table, extractor=extractor)

    first = run(1)
    assert events(first) == {
        ("agfunder", f"{BASE}/alpha-raises", "new"): None,
        ("agfunder", f"{BASE}/weather", "not_relevant"): None,
        ("agfunder", f"{BASE}/gone", "error"): "article_fetch: page not fetched",
        ("agfunder", f"{BASE}/alpha-raises", "skipped"): "duplicate_in_run",
        ("agfunder", f"{BASE}/no-title", "skipped"): "missing_title",
        ("agfunder", f"{BASE}/empty", "skipped"): "empty_body",
        ("agfunder", f"{BASE}/half", "error"): "incomplete_extraction",
    }
    stats = first.stats.first()
    assert (stats.sections_checked, stats.sections_skipped, stats.articles_scanned) == (3, 0, 7)
    assert (stats.new, stats.skipped, stats.not_relevant, stats.errors) == (1, 3, 1, 3)
    logs = store.read_logs()
    assert logs.count() == 9
    lost = logs.where("reason like 'section_fetch%'").first()
    assert (lost.url, lost.event) == (f"{BASE}/tag/lost", "error")
    assert store.read("section_snapshot").count() == 2

    # nothing has changed: the sections are skipped, and only what was not settled is read
    second = run(2)
    again = {
        ("agfunder", f"{BASE}/gone", "error"): "article_fetch: page not fetched",
        ("agfunder", f"{BASE}/no-title", "skipped"): "missing_title",
        ("agfunder", f"{BASE}/empty", "skipped"): "empty_body",
        ("agfunder", f"{BASE}/half", "error"): "incomplete_extraction",
    }
    assert events(second) == again
    stats = second.stats.first()
    assert (stats.sections_skipped, stats.articles_scanned, stats.new) == (2, 4, 0)
    assert store.read("news").count() == 1

    third = run(3)
    gone = ("agfunder", f"{BASE}/gone", "error")
    assert events(third) == {
        gone: again[gone],
        ("agfunder", f"{BASE}/alpha-raises", "updated"): None,
        ("agfunder", f"{BASE}/half", "error"): "incomplete_extraction",
        ("agfunder", f"{BASE}/beta-bags", "new"): None,
    }
    rows = store.read("news").collect()
    assert sorted((r.startup_name, r.entry_status) for r in rows) == [
        ("Alpha", "new"), ("Alpha", "updated"), ("Beta", "new"),
    ]
    summary = json.loads(
        store.read_logs().where("event = 'run_complete'").orderBy(F.desc("run_id")).first().meta
    )
    assert summary["runId"] == config(3).run_id and summary["excelPaths"] is None
    assert summary["totals"]["updated"] == 1 and summary["sources"][0]["id"] == "agfunder"
    assert summary["storage"] == {"excel": False, "postgres": True}

    # a repeated run writes the same tables again
    before = sorted(map(str, store.read("news").collect())), store.read_logs().count()
    run(3)
    assert (sorted(map(str, store.read("news").collect())), store.read_logs().count()) == before

    always_new = run(4, status_mode="current")
    assert {r.action for r in always_new.outcomes.select("action").collect()} <= {"error", "skipped"}


def test_limits_and_extraction_off(spark):
    paths = [f"/story-{i}" for i in range(30)]
    pages = {f"{BASE}/": listing(*paths)}
    pages |= {BASE + p: article(f"S{p[7:]} raises", f"S raised {p}. End.") for p in paths}
    table = page_table(spark, pages)
    site = replace(SITE, sections=SITE.sections[:1])
    got = discover(spark, [site], config(1, max_items=12), pages=table, extractor=KeywordExtractor())
    assert got.candidates.count() == 12
    got = discover(spark, [site], config(1, max_new_rows=4), pages=table, extractor=KeywordExtractor())
    rows = got.candidates.orderBy("link_pos").collect()
    assert [r.link_pos for r in rows] == [0, 1, 2, 3]
    wide = config(1, max_items=None, max_new_rows=None)
    got = discover(spark, [site], wide, pages=table, extractor=KeywordExtractor(), parallelism=3)
    assert got.candidates.where("action = 'new'").count() == 30
    asked = spark.sparkContext.accumulator(0)

    def count(payloads):
        asked.add(len(payloads))
        return KeywordExtractor()(payloads)

    wide = config(1, max_items=None, max_new_rows=4)
    got = discover(spark, [site], wide, pages=table, extractor=count).candidates
    assert sorted(r.link_pos for r in got.collect()) == [0, 1, 2, 3] and asked.value == 30
    off = discover(spark, [site], config(1), pages=table)
    assert {r.reason for r in off.candidates.select("reason").distinct().collect()} == {"ai_disabled"}
    none = discover(spark, [site], config(1, max_sections=1), pages=page_table(spark, {}))
    assert none.candidates.count() == 0 and none.sections.first().action == "error"
    assert enabled([replace(site, enabled=False)]) == []
    with pytest.raises(ValueError):
        discover(spark, [replace(site, enabled=False)], config(1), pages=table)


def shots(*texts):
    return "\n".join(f'- StaticText "{t}"' for t in texts)


def snapshot_table(spark, rows):
    return spark.createDataFrame(rows, schemas.SNAPSHOTS)


LONG = "The firm raised money in a round that was led by people who like it very much indeed."


def feed_rows():
    def links(*names):
        return "\n".join(f'- link "x" url=https://inc42.com/buzz/{n}/' for n in names)

    return [
        (FEED, 1, links("one", "two") + "\n- link y url=https://inc42.com/about"),
        (FEED, 2, links("two", "three", "known", "wall", "late")),
        ("https://inc42.com/buzz/one", 1, shots("One raises", LONG + " Fine.")),
        ("https://inc42.com/buzz/two", 1, shots("Two", "short")),
        ("https://inc42.com/buzz/known", 1, shots("Known", LONG)),
        ("https://inc42.com/buzz/wall", 1, shots("W", "Sign in to continue")),
        ("https://inc42.com/buzz/late", 1, shots("Late", "short")),
        ("https://inc42.com/buzz/late", 2, shots("Late bags", LONG + " End.")),
    ]


def test_snapshot_source(spark):
    news = spark.createDataFrame([("https://inc42.com/buzz/known",)], "source_url string")
    got = discover(
        spark,
        [INC42_FEED],
        config(1),
        snapshots=snapshot_table(spark, feed_rows()),
        state=State(news=news),
        extractor=KeywordExtractor(),
    )
    rows = got.candidates.orderBy("link_pos").collect()
    assert [(r.url.split("/")[-1], r.action, r.reason) for r in rows] == [
        ("one", "new", None),
        ("two", "skipped", "empty_body"),
        ("three", "error", "article_fetch: page not fetched"),
        ("wall", "error", "login_required"),
        ("late", "new", None),
    ]
    assert got.sections.first().action is None


def test_a_walled_feed_ends_its_source_only(spark, tmp_path):
    walled = [(FEED, 1, shots("Sign in to read") + "\n- link x url=https://inc42.com/buzz/one")]
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    result = run_cycle(
        spark,
        [INC42_FEED, SITE],
        config(1, store_flat=True),
        done_at(1),
        store,
        pages=page_table(spark, pages_of(1)),
        snapshots=snapshot_table(spark, walled),
        extractor=KeywordExtractor(),
        exports=str(tmp_path / "flat"),
    )
    stats = {r.source_id: r for r in result.stats.collect()}
    assert (stats["inc42"].articles_scanned, stats["inc42"].errors) == (0, 1)
    assert stats["agfunder"].new == 1
    summary = result.summary.first()
    assert summary.totals.articlesScanned == 7 and len(summary.sources) == 2
    # the flat files hold the same rows
    back = tables.read_flat_news(spark, str(tmp_path / "flat" / "news"))
    assert [r.entry_key for r in back.collect()] == [r.entry_key for r in store.read("news").collect()]
    logs = tables.read_flat_logs(spark, str(tmp_path / "flat" / "logs"))
    assert logs.count() == store.read_logs().count()
    meta = logs.where("event = 'run_complete'").first().meta
    assert json.loads(meta)["storage"] == {"excel": True, "postgres": True}


def test_fallback_in_a_run(spark):
    pages = {f"{BASE}/": listing("/thin") + "x" * 600, f"{BASE}/thin": "<p>js</p>"}
    site = replace(SITE, sections=SITE.sections[:1])
    snaps = snapshot_table(spark, [(f"{BASE}/thin", 1, shots("Thin raises", "It raised. Yes."))])
    for on, action in ((True, "new"), (False, "skipped")):
        got = discover(
            spark, [site], config(1, snapshot_fallback=on), pages=page_table(spark, pages),
            snapshots=snaps, extractor=KeywordExtractor(),
        )
        assert got.candidates.first().action == action
    # a thin listing page that falls back shows no links
    thin = {f"{BASE}/": listing("/thin")}
    snaps = snapshot_table(spark, [(f"{BASE}/", 1, shots("x"))])
    got = discover(
        spark, [site], config(1, snapshot_fallback=True), pages=page_table(spark, thin), snapshots=snaps
    )
    assert got.candidates.count() == 0 and got.sections.first().action is None


def test_stores_of_rows(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    assert store.read("news").count() == 0 and store.read_logs().count() == 0
    ddl = ", ".join(f"{c} string" for c in schemas.LOG_COLUMNS[:-1])
    entry = ("run-1", "agfunder", "new", "https://agfundernews.com/a", None, "key-1", None)
    other = ("run-2", "inc42", "skipped", "https://inc42.com/b", "duplicate_in_run", None, None)
    odd = ("run-2", "inc42", "section_unchanged", "u", None, None, None)
    store.append_logs(spark.createDataFrame([entry], ddl), "2026-06-01", "1", done_at(1))
    store.append_logs(spark.createDataFrame([other, odd], ddl), "2026-06-02", "2", done_at(2))
    store.append_logs(spark.createDataFrame([other, odd], ddl), "2026-06-02", "2", done_at(2))
    rows = store.read_logs().orderBy("run_id").collect()
    assert [r.run_id for r in rows] == ["run-1", "run-2"] and rows[0].logged_at < rows[1].logged_at
    assert spark.read.parquet(str(tmp_path / "store" / "rejected_logs")).count() == 1

    news = [("k1", "u", "s", "One", None, None, "sum", "new", None, "h", 0),
            ("k2", "u", "s", "Two", None, None, "sum", "wrong", None, "h", 1)]
    store.upsert_news(spark.createDataFrame(news, schemas.NEWS + ", seq int"), "v1")
    renamed = [("k1", "u", "s", "Uno", None, None, "sum", "updated", None, "h2", 0)]
    for _ in range(2):
        store.upsert_news(spark.createDataFrame(renamed, schemas.NEWS + ", seq int"), "v2")
    assert [(r.startup_name, r.content_hash) for r in store.read("news").collect()] == [("Uno", "h2")]
    # a version that was not finished is not seen
    (tmp_path / "store" / "news" / "v3").mkdir()
    assert store.read("news").count() == 1


def test_flat_files_by_header_or_position(spark, tmp_path):
    news = spark.createDataFrame(
        [("k", "u", "s", 'N "q"', None, "two\nlines", None, "updated", None),
         ("", "u", "s", "dropped", None, None, None, "new", None)],
        ", ".join(f"{c} string" for c in schemas.NEWS_COLUMNS),
    )
    path = str(tmp_path / "news")
    export_flat(news, schemas.NEWS_COLUMNS, path)
    row = tables.read_flat_news(spark, path).collect()
    assert [(r.startup_name, r.startup_website, r.description, r.entry_status) for r in row] == [
        ('N "q"', None, "two\nlines", "updated")
    ]
    odd = spark.createDataFrame([("s", "b", "k")], "source_id string, b string, entry_key string")
    picked = tables.by_header(odd, ("entry_key", "source_url", "source_id", "startup_name"))
    assert tuple(picked.first()) == ("k", "b", "s", None)


def test_recorded_files(spark, tmp_path):
    index = {"https://h.com/a": {"contentHash": "x", "lastSeenAt": "2025-03-09T10:00:01.500Z",
                                 "lastRunId": "r", "extractionComplete": False},
             "https://h.com/b": {"contentHash": "y", "extractionComplete": True}}
    crawl = [{"sourceId": "inc42", "url": "u", "action": "updated",
              "at": "2025-03-09T11:06:00.250Z", "entryKey": "k"},
             {"sourceId": "inc42", "url": "v", "action": "error",
              "at": "2025-03-09T11:07:30.750Z", "reason": "incomplete_extraction"}]
    stats = {shown: i for i, (_, shown) in enumerate(schemas.STATS)}
    summary = {"runId": "r", "runDate": "2025-03-09", "storage": {"excel": True, "postgres": False},
               "totals": stats, "sources": [{"id": "inc42", **stats}]}
    for name, value in (("index", index), ("crawl", crawl), ("summary", summary)):
        (tmp_path / f"{name}.json").write_text(json.dumps(value, indent=2))
    got = tables.read_url_index(spark, str(tmp_path / "index.json"))
    assert {r.url: (r.content_hash, r.extraction_complete) for r in got.collect()} == {
        "https://h.com/a": ("x", False),
        "https://h.com/b": ("y", True),
    }
    assert got.where("last_seen_at is not null").count() == 1
    rows = tables.read_crawl_events(spark, str(tmp_path / "crawl.json")).orderBy("url").collect()
    assert [(r.source_id, r.action, r.reason, r.entry_key) for r in rows] == [
        ("inc42", "updated", None, "k"),
        ("inc42", "error", "incomplete_extraction", None),
    ]
    row = tables.read_run_summary(spark, str(tmp_path / "summary.json")).first()
    assert row.totals.articlesScanned == 2 and row.sources[0].id == "inc42" and row.storage.excel


def test_seeds(spark):
    rows = tables.seeds(spark, [*SOURCES, replace(SITE, source_id="off", enabled=False)]).collect()
    assert [(r.source_id, r.section_ord) for r in rows][:3] == [("inc42", 0), ("agfunder", 0), ("agfunder", 1)]
    assert len(rows) == 9 and rows[0].fetch_mode == "browser" and rows[1].priority == "high"


def test_stream_of_page_files(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    folder, checkpoint = str(tmp_path / "pages"), str(tmp_path / "checkpoint")
    for run in (1, 2, 3):
        page_table(spark, pages_of(run)).coalesce(1).write.mode("append").parquet(folder)
        query = stream_cycles(
            read_page_stream(spark, folder), [SITE], config(1), store, checkpoint, KeywordExtractor()
        )
        query.awaitTermination()
    rows = store.read("news").collect()
    assert sorted((r.startup_name, r.entry_status) for r in rows) == [
        ("Alpha", "new"), ("Alpha", "updated"), ("Beta", "new"),
    ]
    runs = store.read_logs().where("event = 'run_complete'").select("run_id").distinct().count()
    assert runs == 3


def test_staging_uses_the_shared_folder(spark):
    root = staging_root(spark)
    kept = stage(spark.range(5), "five")
    assert kept.count() == 5 and kept.inputFiles()[0].replace("file://", "").startswith(root.replace("file:", ""))


def test_complete_run_needs_a_folder_for_exports(spark, tmp_path):
    site = replace(SITE, sections=SITE.sections[:1])
    table = page_table(spark, pages_of(1))
    flat = config(1, store_flat=True, store_tables=False)
    got = discover(spark, [site], flat, pages=table)
    with pytest.raises(ValueError):
        complete_run(got.candidates, got.sections, flat, done_at(1), Store(spark, str(tmp_path)))


def test_nothing_is_lost_over_runs_with_limits_and_missing_pages(spark, tmp_path):
    paths = [f"/story-{i}" for i in range(6)]
    pages = {f"{BASE}/": listing(*paths)}
    pages |= {BASE + p: article(f"S{p[7:]} raises", f"S raised {p}. End.") for p in paths}
    site = replace(SITE, sections=SITE.sections[:1])
    want = {f"{BASE}{p}" for p in paths}
    for limit in ({"max_items": 2}, {"max_new_rows": 2}, {}):
        store = Store(spark, str(tmp_path / "-".join(["store", *limit])), buckets=2)
        for n in range(1, 6):
            table = dict(pages)
            if n == 1:  # a page that is missing at first
                del table[f"{BASE}/story-1"]
            run_cycle(spark, [site], config(n, **limit), done_at(n), store,
                      pages=page_table(spark, table), extractor=KeywordExtractor())
        assert {r.source_url for r in store.read("news").collect()} == want, limit


def test_a_run_that_fails_after_the_news_loses_nothing(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    site = replace(SITE, sections=SITE.sections[:1])

    def run(n):
        return run_cycle(spark, [site], config(n), done_at(n), store,
                         pages=page_table(spark, pages_of(1)), extractor=KeywordExtractor())

    with monkeypatch.context() as patch:
        patch.setattr(Store, "upsert_news", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(1)
    assert ("agfunder", f"{BASE}/alpha-raises", "new") in events(run(2))
    assert store.read("news").count() == 1
    with pytest.raises(ValueError):
        run(1)  # older than what is stored


def test_text_after_the_payload_cut_counts_as_a_change(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    site = replace(SITE, sections=SITE.sections[:1])
    body = "Zeta raised it. " + "word " * 900

    def run(n, end, links):
        pages = {f"{BASE}/": listing("/zeta", *links),
                 f"{BASE}/zeta": article("Zeta raises", body + end)}
        return run_cycle(spark, [site], config(n, extract_max_chars=2000), done_at(n), store,
                         pages=page_table(spark, pages), extractor=KeywordExtractor())

    run(1, "old", [])
    assert ("agfunder", f"{BASE}/zeta", "updated") in events(run(2, "new", ["/more"]))


def test_a_parser_that_raises_ends_its_page_only(spark):
    def fails(page):
        if "bad" in page:
            raise ValueError("bad page")
        return ["/good-1", "/bad-1"] if "list" in page else ("Good raises", "It raised. Yes.")

    site = replace(
        SITE, sections=(Section("a", f"{BASE}/a", "high"), Section("b", f"{BASE}/b", "high")),
        listing_parser=fails, article_parser=fails,
    )
    pages = {f"{BASE}/a": "list", f"{BASE}/b": "bad list", f"{BASE}/good-1": "x", f"{BASE}/bad-1": "bad"}
    got = discover(spark, [site], config(1), pages=page_table(spark, pages), extractor=KeywordExtractor())
    rows = {r.url: (r.action, r.reason) for r in got.candidates.collect()}
    assert rows == {
        f"{BASE}/good-1": ("new", None),
        f"{BASE}/bad-1": ("error", "article_parse: ValueError: bad page"),
    }
    reasons = {r.section_url: r.reason for r in got.sections.collect()}
    assert reasons[f"{BASE}/b"] == "section_parse: ValueError: bad page" and reasons[f"{BASE}/a"] is None


def test_rows_without_key_and_a_hot_key_are_dealt_evenly(spark):
    from newsloom.operators.select import mark_duplicates

    rows = spark.range(20_000).selectExpr(
        "'r' AS run_id", "'s' AS source_id", "CAST(NULL AS bigint) AS link_pos", "0 AS section_ord",
        "concat('u', id) AS url",
        "CASE WHEN id % 10 < 8 THEN NULL WHEN id % 2 = 0 THEN 'hot' ELSE concat('k', id) END AS entry_key",
    ).repartition(8)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        done = mark_duplicates(rows, None)
        sizes = [r[0] for r in done.groupBy(F.spark_partition_id()).agg(F.count("*")).select("count(1)").collect()]
        assert max(sizes) < 6000 and done.where("is_duplicate").count() == 1999
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
