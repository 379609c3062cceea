"""Answer journal, keyed stream state, link table, dense counters, limits over runs."""

import json
import random
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.functions.identity import extract_payload
from newsloom.operators.extract import KeywordExtractor, _answers, extract_with
from newsloom.operators.journal import AnswerJournal
from newsloom.operators.link_table import SCHEMA as LINKS
from newsloom.operators.link_table import found_links, merge_link_table
from newsloom.operators.runs import run_spine, run_summary, source_stats
from newsloom.operators.select import cap_items, cap_new_rows, cap_scan, first_sections
from newsloom.plans.complete import left_counts, run_cycle
from newsloom.sources.store import Store
from newsloom.specs import Section
from newsloom.streaming.incremental import read_page_stream, stream_seen_articles
from newsloom.streaming.seen import mark_seen
from tests.test_jobs import BASE, SITE, article, config, done_at, listing, page_table, replace


class Asked:
    """Writes down each payload it is asked about; fails for some."""

    def __init__(self, path, fails=()):
        self.path, self.fails = str(path), fails

    def __call__(self, payloads):
        with open(self.path, "a") as log:
            for p in payloads:
                log.write(json.loads(p)["title"] + "\n")
        if any(json.loads(p)["title"] in self.fails for p in payloads):
            raise ValueError("no answer")
        return [json.dumps({"isRelevant": True, "startupName": json.loads(p)["title"]}) for p in payloads]

    def titles(self):
        with open(self.path) as log:
            return sorted(set(log.read().split()))


def rows(spark, titles):
    return spark.createDataFrame(
        [(f"u{t}", t, "body") for t in titles], "url string, title string, body_excerpt string"
    )


def names(df):
    return sorted((r.title, r.extraction.startup_name, r.extraction.extraction_failed) for r in df.collect())


def test_a_second_run_asks_for_changed_payloads_only(spark, tmp_path):
    journal = AnswerJournal(spark, str(tmp_path / "journal"), buckets=4)
    first = Asked(tmp_path / "one", fails=("c",))
    got = extract_with(rows(spark, ["a", "b", "c", "a"]), first, journal=journal, run_id="r1")
    assert names(got) == [("a", "a", False), ("a", "a", False), ("b", "b", False), ("c", None, True)]
    assert first.titles() == ["a", "b", "c"]
    second = Asked(tmp_path / "two")
    got = extract_with(rows(spark, ["a", "b", "c", "d"]), second, journal=journal, run_id="r2")
    assert [n for n, _, failed in names(got) if not failed] == ["a", "b", "c", "d"]
    assert second.titles() == ["c", "d"]  # what failed is asked again
    changed = rows(spark, ["a"]).withColumn("body_excerpt", F.lit("other"))
    third = Asked(tmp_path / "three")
    assert names(extract_with(changed, third, journal=journal, run_id="r3"))[0][1] == "a"
    assert third.titles() == ["a"]


def test_finished_rounds_of_a_failed_run_are_kept(spark, tmp_path, monkeypatch):
    journal = AnswerJournal(spark, str(tmp_path / "journal"), buckets=2, round_size=3)
    titles = [f"t{n}" for n in range(9)]
    first, written = Asked(tmp_path / "one"), []
    real = AnswerJournal.settle

    def killed(self):  # the run dies after its rounds, before they are put into the table
        if written:
            raise KeyboardInterrupt
        written.append(1)
        return real(self)

    with monkeypatch.context() as patch:
        patch.setattr(AnswerJournal, "settle", killed)
        with pytest.raises(KeyboardInterrupt):
            extract_with(rows(spark, titles), first, journal=journal, run_id="r1")
    assert len(journal._rounds()) == 3 and first.titles() == titles
    second = Asked(tmp_path / "two")
    second("")  # the file is there
    got = extract_with(rows(spark, titles), second, journal=journal, run_id="r1")
    assert [n for _, n, _ in names(got)] == titles and second.titles() == []
    assert journal._rounds() == [] and journal.settle() == 0


def test_rows_that_are_not_wanted_are_not_asked_about(spark, tmp_path):
    journal = AnswerJournal(spark, str(tmp_path / "journal"), buckets=2)
    asked = Asked(tmp_path / "one")
    got = extract_with(
        rows(spark, ["a", "b"]), asked, F.col("title") == "a", journal=journal, run_id="r"
    ).collect()
    assert {r.title: r.extraction and r.extraction.startup_name for r in got} == {"a": "a", "b": None}
    assert asked.titles() == ["a"] and got[0].__fields__ == ["url", "title", "body_excerpt", "extraction"]


def test_a_batch_is_given_up_after_its_time():
    def slow(payloads):
        time.sleep(30 if "x" in payloads else 0)
        return payloads

    started = time.monotonic()
    assert _answers(slow, ["a", "x"], 0.3) == [None, None] and time.monotonic() - started < 5
    assert _answers(slow, ["a"], 5) == ["a"]
    with pytest.raises(ZeroDivisionError):
        from newsloom.operators.extract import _called
        _called(lambda _: 1 / 0, ["a"], 5)


def at(n):
    return datetime(2026, 1, 1, 0, 0, n)


def test_seen_state_over_batches_and_a_restart(spark, tmp_path):
    batches = [
        [("a", at(1), "1"), ("a", at(3), "2"), ("a", at(2), "3"), ("b", at(1), "1"), (None, at(1), "9")],
        [("a", at(9), "2"), ("b", at(9), "5"), ("c", None, "7")],
        [("a", at(4), "8"), ("c", None, "7"), ("c", None, "6"), ("b", datetime(2026, 1, 1, 0, 2), "5")],
    ]
    schema = "url string, fetched_at timestamp, content_hash string"
    for batch in batches:  # each batch is a new start of the stream
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        arriving = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        (
            mark_seen(arriving, limit_ms=60_000).writeStream.outputMode("update")
            .foreachBatch(lambda df, n: df.write.parquet(str(tmp_path / "out" / str(n))))
            .option("checkpointLocation", str(tmp_path / "check"))
            .trigger(availableNow=True).start().awaitTermination()
        )
    got = {}
    for n in range(3):
        for r in spark.read.parquet(str(tmp_path / "out" / str(n))).collect():
            got[n, r.url] = (r.change_status, r.content_hash, r.n_seen, r.first_seen, r.last_seen)
    assert got == {
        (0, "a"): ("new", "2", 3, at(1), at(3)), (0, "b"): ("new", "1", 1, at(1), at(1)),
        (1, "a"): ("unchanged", "2", 4, at(1), at(9)), (1, "b"): ("updated", "5", 2, at(1), at(9)),
        (1, "c"): ("new", "7", 1, None, None), (2, "a"): ("updated", "8", 5, at(1), at(9)),
        (2, "c"): ("unchanged", "7", 3, None, None),
        (2, "b"): ("new", "5", 3, at(1), datetime(2026, 1, 1, 0, 2)),  # forgotten after a minute
    }


def test_articles_of_a_stream_are_judged_by_its_state(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    spec = replace(SITE, sections=())
    pages = {f"{BASE}/a": article("A raises", "A raised. Yes."), f"{BASE}/b": article("B raises", "B raised. Yes.")}
    changed = pages | {f"{BASE}/b": article("B raises", "B raised more. Yes.")}
    for n, table in enumerate((pages, changed)):
        page_table(spark, table).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream_seen_articles(
            read_page_stream(spark, str(tmp_path / "in")), spec, config(1), store,
            str(tmp_path / "check"), KeywordExtractor(), limit_ms=3_600_000,
        ).awaitTermination()
    logged = store.read_logs().where("event != 'run_complete'").collect()
    assert sorted((r.run_id[-1], r.url[-1], r.event, r.reason) for r in logged) == [
        ("0", "a", "new", None), ("0", "b", "new", None),
        ("1", "a", "skipped", "unchanged_content"), ("1", "b", "updated", None),
    ]
    assert store.read("news").count() == 3


def test_link_table_equals_a_dictionary(spark):
    draw = random.Random(5)
    table, want = spark.createDataFrame([], LINKS), {}
    for n in range(1, 5):
        run = f"r{n}"
        read = [s for s in "abcd" if draw.random() < 0.7]
        steps = [
            (s, step, pos, f"u{draw.randrange(6)}")
            for s in read if draw.random() < 0.8 for step in range(3) for pos in range(3)
        ]
        found = found_links(spark.createDataFrame(
            steps, "section_url string, step int, link_pos bigint, url string"
        ))
        sections = spark.createDataFrame([(s,) for s in read], "section_url string")
        merged = merge_link_table(table, found, sections, run)
        now = {}
        for s, step, pos, url in steps:
            now[s, url] = min(now.get((s, url), (9, 9)), (step, pos))
        changes = {}
        for k in {*want, *now}:
            old = want.get(k)
            if k in now:
                changes[k] = "new" if old is None else "back" if old["gone"] else "kept"
                want[k] = {"first": old["first"] if old else (run, *now[k]), "last": run, "gone": None}
            elif k[0] in read:
                changes[k] = "still_gone" if old["gone"] else "gone"
                want[k] = old | {"gone": old["gone"] or run}
        got = merged.collect()
        assert {(r.section_url, r.url): r.change for r in got if r.change} == changes
        assert {
            (r.section_url, r.url): {"first": (r.first_run, r.first_step, r.first_pos), "last": r.last_run, "gone": r.gone_run}
            for r in got
        } == want
        table = spark.createDataFrame(got, merged.schema).drop("change")


def test_idle_runs_and_sources_show_in_the_summary(spark, tmp_path):
    activity = spark.createDataFrame(
        [("r1", "a", "article", "new")], "run_id string, source_id string, kind string, action string"
    )
    spine = run_spine(spark, ["r1", "r2"], ["a", "b"])
    stats = source_stats(activity, None, spine)
    assert sorted((r.run_id, r.source_id, r.new) for r in stats.collect()) == [
        ("r1", "a", 1), ("r1", "b", 0), ("r2", "a", 0), ("r2", "b", 0)
    ]
    found = {r.runId: r for r in run_summary(stats, config(1), done_at(1)).collect()}
    assert found["r2"].totals["new"] == 0 and [s.id for s in found["r2"].sources] == ["a", "b"]
    # a cycle that finds nothing still ends in one summary row with all enabled sources
    idle = replace(SITE, source_id="idle", sections=())
    result = run_cycle(
        spark, [idle, replace(idle, source_id="off", enabled=False)], config(1), done_at(1),
        Store(spark, str(tmp_path / "s"), buckets=2), pages=page_table(spark, {"https://x.com/": "y"}),
        extractor=KeywordExtractor(),
    )
    row = result.summary.collect()
    assert len(row) == 1 and [s.id for s in row[0].sources] == ["idle"]
    assert result.events.where("event = 'run_complete'").count() == 1


def test_sections_beyond_the_limit_are_the_next_runs_first(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), buckets=2)
    site = replace(SITE, sections=tuple(Section(str(n), f"{BASE}/tag/{n}") for n in range(5)))
    # the second listing is never found, and must not be in the way of the others
    pages = {f"{BASE}/tag/{n}": listing(f"/story-{n}") for n in range(5) if n != 1}
    pages |= {f"{BASE}/story-{n}": article(f"S{n} raises", "S raised. Yes.") for n in range(5)}
    read = []
    for run in range(1, 5):
        result = run_cycle(
            spark, [site], config(run, max_sections=2), done_at(run), store,
            pages=page_table(spark, pages), extractor=KeywordExtractor(),
        )
        stats = result.stats.collect()[0]
        left = result.left.collect()[0]
        read.append(stats.sections_checked)
        assert (left.sections_left, left.links_left) == (3, 0)
    assert read == [2, 2, 2, 2]
    assert {r.source_url for r in store.read("news").collect()} == {f"{BASE}/story-{n}" for n in (0, 2, 3, 4)}
    assert left_counts(None, None) is None


def test_rotation_of_many_sections_in_ranges(spark):
    seeds = spark.createDataFrame(
        [("s", n, f"u{n}") for n in range(500)], "source_id string, section_ord int, section_url string"
    )
    checked = spark.createDataFrame([], schemas.SECTION_SNAPSHOT)
    assert first_sections(seeds, 300, checked).count() == 300
    done = spark.createDataFrame([(f"u{n}", "h", at(1)) for n in range(300)], schemas.SECTION_SNAPSHOT)
    got = sorted(r.section_ord for r in first_sections(seeds, 300, done).collect())
    assert got == [*range(100), *range(300, 500)]


def test_both_limits_in_one_pass_equal_one_after_the_other(spark):
    draw = random.Random(3)
    data = [("r", draw.choice("ab"), 0, n, draw.random()) for n in range(3000)]
    table = spark.createDataFrame(
        data, "run_id string, source_id string, section_ord int, link_pos bigint, v double"
    ).repartition(5)
    good = F.col("v") > 0.7
    for items, new in ((700, 150), (400, 400), (None, 90), (333, None)):
        two = cap_new_rows(cap_items(table, items), new, good, None)
        one = cap_scan(table, items, new, good)
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_payload_of_the_journal_is_that_of_the_extractor(spark, tmp_path):
    journal = AnswerJournal(spark, str(tmp_path / "j"), buckets=2)
    long = spark.createDataFrame([("u", "t", "x" * 3000)], "url string, title string, body_excerpt string")
    extract_with(long, Asked(tmp_path / "one"), max_chars=100, journal=journal, run_id="r").collect()
    cut = F.concat(F.substring("body_excerpt", 1, 99), F.lit(chr(0x2026)))
    want = long.select(F.sha2(extract_payload("url", "title", cut), 256)).first()[0]
    assert [r.payload_hash for r in journal.table.read().collect()] == [want]


def test_payloads_are_neither_written_nor_sent_to_be_looked_up(spark, tmp_path, monkeypatch):
    from newsloom.operators import journal as module

    written, stage = [], module.stage
    monkeypatch.setattr(module, "stage", lambda df, name: written.append(df.columns) or stage(df, name))
    rows = [("a",), ("b",), ("b",), (None,), ("c",)]
    payloads = spark.createDataFrame(rows, "payload string")
    own = AnswerJournal(spark, str(tmp_path / "journal"), buckets=2)
    first = own.answer(payloads.where("payload = 'a'"), lambda c: F.concat(F.lit("1"), c), "r1")
    assert [r.answer for r in first.collect()] == ["1a"]
    second = own.answer(payloads, lambda c: F.concat(F.lit("2"), c), "r2")
    assert sorted(r.answer for r in second.collect()) == ["1a", "2b", "2c"]
    assert written and not any("payload" in columns for columns in written)
    rounds = AnswerJournal(spark, str(tmp_path / "rounds"), buckets=2, round_size=1)
    many = rounds.answer(payloads, lambda c: F.concat(F.lit("3"), c), "r1")
    assert sorted(r.answer for r in many.collect()) == ["3a", "3b", "3c"]


def test_rows_of_a_url_are_judged_without_frames():
    from datetime import datetime, timezone

    from pyspark.sql import Row

    from newsloom.streaming.seen import SeenUrls

    class Value:
        now = None

        def get(self):
            return self.now

        def update(self, value):
            self.now = value

    def at(minute, zone=timezone.utc):
        return datetime(2024, 5, 1, 12, minute, tzinfo=zone)

    judge = SeenUrls(["url", "fetched_at", "content_hash"], 60_000, None)
    judge.seen = Value()

    def batch(*copies):
        rows = (Row(url="u", fetched_at=t, content_hash=h) for t, h in copies)
        return next(judge.handleInputRows(("u",), rows, None)).asDict()

    got = batch((at(3), "b"), (None, "z"), (at(1), "a"))
    assert (got["change_status"], got["content_hash"], got["n_seen"]) == ("new", "b", 3)
    assert (got["first_seen"], got["last_seen"]) == (at(1), at(3))
    # the state gives times back without a zone, in that of the process
    value = judge.seen.now
    judge.seen.now = (value[0], *(t.astimezone().replace(tzinfo=None) for t in value[1:3]), value[3])
    got = batch((at(4), "b"))
    assert (got["change_status"], got["n_seen"], got["first_seen"]) == ("unchanged", 4, at(1))
    assert batch((at(6), "c"))["change_status"] == "new"  # two minutes later
