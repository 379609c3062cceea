"""Keyed tables in buckets: what a write touches, what a join moves."""

import os
import random

import pytest
from pyspark.sql import functions as F

from newsloom.operators.change import change_status, merge_url_index
from newsloom.operators.merge import merge_keyed
from newsloom.plans.discover import State
from newsloom.schemas import URL_INDEX
from newsloom.sources.keyed import KeyedTable
from newsloom.sources.store import Store


def urls(spark, numbers, value):
    rows = [(f"https://h.com/{n}", value) for n in numbers]
    return spark.createDataFrame(rows, "url string, value bigint")


def upsert(table, batch, version):
    return table.upsert(
        batch, version,
        lambda old, new, place: merge_keyed(old, new, "url", ["value"], place=place),
    )


def files(root):
    return {
        os.path.join(d, f): os.path.getmtime(os.path.join(d, f))
        for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")
    }


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def above_scans(plan, table="newsloom_"):
    """The operators between the scans of the stored table and the join above them."""
    lines = plan.split("\n")
    for at, line in enumerate(lines):
        if "FileScan" in line and table in line:
            depth = line.index("FileScan")
            for above in reversed(lines[:at]):
                mark = len(above) - len(above.lstrip(" :+-"))
                if mark < depth:
                    depth = mark
                    if "Join" in above:
                        break
                    yield above.strip(" :+-")


def test_a_write_touches_the_buckets_of_its_keys(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "url string, value bigint", "url", 16)
    assert table.read().count() == 0
    assert upsert(table, urls(spark, range(200), 1), "v1") == list(range(16))
    before, folders = files(tmp_path / "t" / "data"), table.folders()[0]
    touched = upsert(table, urls(spark, [3, 5, 900], 2), "v2")
    assert 1 <= len(touched) <= 3
    after = files(tmp_path / "t" / "data")
    assert all(after[name] == at for name, at in before.items())
    assert len(after) - len(before) == len(touched)
    assert {b for b, f in table.folders()[0].items() if folders.get(b) != f} == set(touched)
    rows = {r.url: r.value for r in table.read().collect()}
    assert len(rows) == 201 and table.read("v2").where("value = 2").count() == 0
    assert {u for u, v in rows.items() if v == 2} == {f"https://h.com/{n}" for n in (3, 5, 900)}


def test_a_crash_between_buckets_loses_nothing(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"), "url string, value bigint", "url", 8)
    upsert(table, urls(spark, range(50), 1), "v1")
    before = sorted(map(tuple, table.read().collect()))
    with monkeypatch.context() as patch:  # the folders are written, the list is not
        patch.setattr(KeyedTable, "_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            upsert(table, urls(spark, range(0, 50, 2), 2), "v2")
    assert sorted(map(tuple, table.read().collect())) == before
    failing = urls(spark, [1], 2).withColumn("value", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        upsert(table, failing, "v2")
    assert sorted(map(tuple, table.read().collect())) == before
    for _ in range(2):  # a repeated version gives the same rows
        upsert(table, urls(spark, range(0, 50, 2), 2), "v2")
        assert table.read().where("value = 2").count() == 25 and table.read().count() == 50


def test_vacuum_keeps_what_kept_versions_name(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "url string, value bigint", "url", 8)
    upsert(table, urls(spark, range(100), 1), "v1")
    for n in range(2, 6):
        upsert(table, urls(spark, [n], n), f"v{n}")
    want = sorted(map(tuple, table.read().collect()))
    gone = table.vacuum(keep=1)
    assert any("versions/v1" in g for g in gone) and table.versions() == ["v5"]
    assert len(files(tmp_path / "t" / "data")) == 8
    assert sorted(map(tuple, table.read().collect())) == want and table.vacuum(1) == []


def test_resize_and_random_batches_equal_a_dictionary(spark, tmp_path):
    draw = random.Random(8)
    table = KeyedTable(spark, str(tmp_path / "t"), "url string, value bigint", "url", 4)
    want = {}
    for n in range(1, 5):
        batch = {draw.randrange(60): n * 100 + draw.randrange(9) for _ in range(25)}
        want |= {f"https://h.com/{k}": v for k, v in batch.items()}
        rows = [(f"https://h.com/{k}", v) for k, v in batch.items()]
        upsert(table, spark.createDataFrame(rows, "url string, value bigint"), f"v{n}")
        if n == 2:
            table.resize("v2b", 12)
            assert table.folders()[1] == 12
    assert {r.url: r.value for r in table.read().collect()} == want
    upsert(table, urls(spark, [], 0), "v9")
    assert table.read().count() == len(want)


@pytest.mark.parametrize("parts", ["4", "200"])
def test_the_stored_side_is_not_shuffled(spark, tmp_path, parts):
    before = {
        k: spark.conf.get(k)
        for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")
    }
    store = Store(spark, str(tmp_path / "s"), buckets=8)
    index = urls(spark, range(40), 1).selectExpr(
        "url", "'h' AS content_hash", "CAST(NULL AS timestamp) AS last_seen_at",
        "'r' AS last_run_id", "true AS extraction_complete", "0 AS seq",
    )
    store.update_url_index(index, "v1")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        links = urls(spark, range(30, 60), 2).withColumn("content_hash", F.lit("h"))
        found = store.look_up("url_index", links)
        between = list(above_scans(plan_of(found)))
        assert between and not [x for x in between if "Exchange" in x], between
        assert found.count() == 10
        merged = merge_url_index(
            store.read("url_index"), index, place=store.tables["url_index"].placed(8)
        )
        between = list(above_scans(plan_of(merged)))
        assert between and not [x for x in between if "Exchange" in x], between
        one = store.look_up("url_index", urls(spark, [7], 1))
        assert len(one.inputFiles()) == 1 and one.count() == 1
        near = State.of(store, "v2").near(links)
        states = change_status(links, near.url_index, near.news)
        assert states.where("change_status = 'new'").count() == 20
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_look_up_of_nulls_and_before_a_version(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), buckets=4)
    row = [("https://h.com/1", "h", None, "r", True, 0)]
    store.update_url_index(spark.createDataFrame(row, URL_INDEX + ", seq int"), "v1")
    keys = spark.createDataFrame([(None,), ("https://h.com/1",)], "url string")
    assert store.look_up("url_index", keys).count() == 1
    assert store.look_up("url_index", keys, before="v1").count() == 0
