"""Operators on vectors and pages, the pipeline, against brute force."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from newsloom.llm import groups, multi_index, neighbours, url_rules, warc
from newsloom.llm.common import running_sums
from tests.llm.helpers import Groups, prose

VECTORS = "vec_id bigint, embedding array<float>, label int"


def vector_rows():
    rng = np.random.default_rng(2)
    base = rng.standard_normal((300, 16)).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(base)]
    for i in range(60):  # near copies
        rows.append((1000 + i, (base[i % 12] + rng.standard_normal(16) * 0.05).astype(np.float32).tolist(), 1))
    rows += [(2000 + i, base[7].tolist(), 2) for i in range(150)]  # a hot vector
    return rows


def odd_vectors():
    return [
        (3000, None, 0), (3020, [0.0] * 16, 0), (3040, [float("nan")] * 16, 0),
        (3060, [None] + [1.0] * 15, 0), (3080, [float("inf")] + [1.0] * 15, 0),
        (3100, [1.0, 2.0], 0), (None, [1.0] * 16, 0),
    ]


def test_nearest_against_brute_force(spark):
    rows = vector_rows() + odd_vectors()
    frame = spark.createDataFrame(rows, VECTORS).withColumn("block", F.lit(1))
    got = neighbours.nearest(frame, F.col("vec_id") % 20 == 0, count=20, block=200, queries=8).collect()
    ids = np.array([r[0] for r in vector_rows()])
    data = np.array([r[1] for r in vector_rows()], dtype=np.float32).astype(np.float64)
    asked = ids[ids % 20 == 0]
    assert {r.query_id for r in got} == set(asked.tolist())
    hits = 0
    for q in asked:
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21))
        score = data @ data[ids == q][0]
        best = [ids[i] for i in np.lexsort((ids, -score)) if ids[i] != q][:20]
        hits += len(set(best) & {r.vec_id for r in own})
        for r in own:
            assert r.score == pytest.approx(score[ids == r.vec_id][0], abs=1e-12)
        order = [(-r.score, r.vec_id) for r in own]
        assert order == sorted(order)
    assert hits >= 0.95 * 20 * len(asked)
    few = spark.createDataFrame(vector_rows()[:5], VECTORS)
    assert neighbours.nearest(few, F.lit(True)).count() == 20
    assert neighbours.nearest(few.limit(0), F.lit(True)).count() == 0


def test_collisions_are_counted_without_lists_of_rows():
    """A block counts a query's collisions by ranks, at few radii, and finds what widening step by step finds."""
    rows = np.random.default_rng(3).standard_normal((600, 16))
    rows = np.vstack([rows, rows[:40]])  # copies tie
    ids = np.arange(len(rows))
    block = neighbours.Block(ids, rows, float(np.sqrt((rows**2).sum(axis=1)).max()), 64, 1)
    turns, counted = [], block._collided
    block._collided = lambda low, width: turns.append(1) or counted(low, width)
    hits = found = 0
    for own, got in zip(ids[::20], block.search(ids[::20], rows[::20], 20), strict=True):
        score = rows @ rows[own]
        best = [i for i in np.lexsort((ids, -score.round(12))) if i != own][:20]
        hits, found = hits + len(set(best) & {i for i, _ in got}), found + len(got)
        assert [i for i, _ in got] == sorted((i for i, _ in got), key=lambda i: (-score[i].round(12), i))
    assert found == 20 * len(ids[::20]) and hits >= 0.95 * found
    assert len(turns) <= 6 * len(ids[::20])


def test_vector_duplicates_against_brute_force(spark):
    rows = vector_rows() + odd_vectors()
    got = {r.vec_id: r for r in multi_index.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()}
    ids = [r[0] for r in vector_rows()]
    data = multi_index.unit(np.array([r[1] for r in vector_rows()], dtype=np.float32).astype(np.float64))
    linked = data @ data.T >= 0.95
    tops = Groups(ids)
    for i, j in zip(*np.nonzero(linked), strict=True):
        tops.join(ids[i], ids[j])
    right = sum(
        (got[i].n_links, got[i].component_id, got[i].kept)
        == (int(linked[k].sum()) - 1, tops.top(i), tops.top(i) == i)
        for k, i in enumerate(ids)
    )
    assert right >= 0.99 * len(ids)
    for i, *_ in odd_vectors():
        assert got[i].n_links == 0 and got[i].component_id == i and got[i].kept
    assert multi_index.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def test_visits_are_the_nearest_cells():
    rng = np.random.default_rng(1)
    one, two = rng.random((5, 9)), rng.random((5, 7))
    for count in (1, 6, 30, 63):
        got = multi_index.visits(one, two, count)
        for k in range(5):
            sums = (one[k][:, None] + two[k][None, :]).ravel()
            assert got[k].tolist() == np.argsort(sums, kind="stable")[:count].tolist()


def test_components_of_paths_and_stars(spark):
    rng = np.random.default_rng(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)]
    edges += [tuple(map(int, rng.integers(200, 260, 2))) for _ in range(40)] + [(7, 7)]
    tops = Groups({x for e in edges for x in e})
    for a, b in edges:
        tops.join(a, b)
    got = dict(groups.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert {x: got.get(x, x) for x in tops.up} == {x: tops.top(x) for x in tops.up}
    assert groups.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_groups_are_not_lost_to_stars(spark):
    """Links that no star around the smallest node shows are found by later rounds."""
    linked = {(2, 3), (5, 9), (9, 11), (20, 70)}
    rows = [(1, n, 12, 1) for n in range(1, 13)] + [(2, n, 60, 20) for n in range(20, 80)]
    members = spark.createDataFrame(rows, "bucket bigint, node bigint, n bigint, centre bigint")
    truth = spark.createDataFrame(sorted(linked), "a bigint, b bigint")
    found = dict(groups.grow(members, lambda pairs: pairs.join(truth, ["a", "b"])).collect())
    assert found == {3: 2, 9: 5, 11: 5, 70: 20}


def test_running_sums_of_a_hot_key(spark):
    frame = spark.range(5000).selectExpr("IF(id % 10 = 0, id % 7, 99) AS k", "id", "id % 5 AS v")
    got = {r.id: r.before for r in running_sums(frame, ["k"], ["id"], {"before": "v"}).collect()}
    sums = {}
    for r in frame.orderBy("id").collect():
        assert got[r.id] == sums.get(r.k, 0)
        sums[r.k] = sums.get(r.k, 0) + r.v


# --- URLs -----------------------------------------------------------------------------

URLS = [
    "http://a.example.net/en/1", "HTTP://Example.NET/fr/2", "https://example.com/de/x?q=/en/",
    "https://notexample.com/de/", "https://w.org/fr/", "https://w.org", "net/", None, "", "://",
    "https://net", "https://net/", "https://b.net/#en", "x://deep.a.example.net/en/?y",
]
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def _judged(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        for stop in "?#":
            rest = rest.split(stop)[0]
        host, slash, tail = rest.partition("/")
        host, path = host.lower(), slash + tail
    fits = [
        (len(h + p), h + p, v) for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


@pytest.mark.parametrize("most", [200_000, 0])
def test_url_rules(spark, most):
    many = RULES + [(f"h{i}.example.net", f"/p{i % 7}", ("block", "allow")[i % 2]) for i in range(300)]
    urls = URLS + [f"http://x.h{i}.example.net/p{i % 5}/z" for i in range(400)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumn("key", F.lit(1))
    for rules in (RULES, many):
        table = spark.createDataFrame(rules + rules[:1], "host string, path string, verdict string")
        got = url_rules.judge(pages, table, max_listed=most).collect()
        assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == {
            i: _judged(u, rules) for i, u in enumerate(urls)
        }
    none = table.limit(0)
    assert {r.verdict for r in url_rules.judge(pages, none).collect()} == {"allow"}
    assert url_rules.judge(pages.limit(0), table).count() == 0


# --- WARC -----------------------------------------------------------------------------


def test_derivatives_round_trip(spark, tmp_path):
    rows = [
        (1, "http://h.example/a", "<title>T &amp; U</title><script>x</script><p>One<p>Two <a href='/b'>l</a>"),
        (2, None, "<p>no address"), (3, "http://h.example/c", None), (4, "http://[bad", "<a href='x'>y</a>"),
        (5, "http://h.example/e", "<div>" * 2000 + "deep é" * 20_000),
        (1, "http://h.example/a", "<title>T &amp; U</title><script>x</script><p>One<p>Two <a href='/b'>l</a>"),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("block", F.lit(0))
    source = warc.responses(pages)
    got = warc.derivatives(source)
    records = got.collect()
    assert len(records) == 12 and all(r.digest_valid for r in records)
    ids = {r.page_id: r.record_id for r in source.collect()}
    by = {(r.page_id, r.record_type): r for r in records}
    for (page, _), r in by.items():
        assert r.refers_to == ids[page] and r.content_length == len(r.block.encode())
        assert r.block_digest == warc.digest(r.block.encode())
    assert by[1, "conversion"].block == "T & U\nOne\nTwo l"
    meta = json.loads(by[1, "metadata"].block)
    assert meta["html"]["title"] == "T & U" and meta["html"]["links"][0]["url"] == "http://h.example/b"
    assert meta["warc"]["WARC-Record-ID"] == ids[1] and meta["payload"]["valid"]
    assert by[3, "conversion"].block == "" and "Target-URI" not in by[2, "metadata"].headers
    warc.write(got, str(tmp_path / "out"), compression="none")
    read = {}
    for file in sorted((tmp_path / "out").glob("part-*")):
        for headers, block in warc.parse(file.read_bytes()):
            assert warc.digest(block) == headers["WARC-Block-Digest"]
            read[headers["WARC-Record-ID"]] = block.decode()
    assert read == {r.record_id: r.block for r in records}
    broken = source.withColumn("payload_digest", F.lit("sha1:WRONG"))
    assert not warc.derivatives(broken).first().digest_valid
    assert warc.derivatives(warc.responses(pages.limit(0))).count() == 0


def test_repeated_headers_and_other_charsets():
    def texts(head, payload):
        block = ("HTTP/1.1 200 OK\r\n" + head + "\r\n\r\n").encode() + payload
        row = {
            "page_id": 1, "record_id": "<urn:x>", "target_uri": None, "date": warc.DATE,
            "payload_digest": None, "block": block,
            "headers": [{"name": "WARC-Concurrent-To", "value": v} for v in ("<a>", "<b>")],
        }
        meta, plain = warc.derive(row)
        return json.loads(meta[-1]), plain[-1]

    page = "<p>caf\u00e9".encode("latin-1")
    meta, text = texts("Set-Cookie: a=1\r\nContent-Type: text/html; charset=\"ISO-8859-1\"\r\nSet-Cookie: b=2", page)
    assert text == "caf\u00e9" and meta["http"]["headers"]["Set-Cookie"] == ["a=1", "b=2"]
    assert meta["warc"]["WARC-Concurrent-To"] == ["<a>", "<b>"]
    for head in ("Content-Type: text/html; charset=unheard", "Content-Type: text/html; charset=hex", "X: y"):
        assert texts(head, page)[1] == "caf\ufffd"


# --- pipeline -------------------------------------------------------------------------


def test_the_stages_take_effect(spark, tmp_path):
    rows = []
    for i in range(240):
        lines = [prose(30, 10 * i + k) for k in range(4)] + (["A line that each document repeats here"] if i % 2 else [])
        if i % 6 == 0:
            lines[2] += ". You grubnoddle and grubnoddle. grubnoddle!"
        rows.append((i, "\n".join(lines), "en", f"s{i % 3}", 0))
    rows += [(500, rows[1][1] + " more", "en", "s1", 0), (501, None, "en", None, 0), (502, "", "en", "s2", 0)]
    ddl = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, ddl).write.parquet(str(tmp_path / "documents.parquet"))
    marks = [(i, 1, int(i % 6 == 0)) for i in range(240)]
    spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, seen = spark.createDataFrame(rows, ddl), {}
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"stage-{k}"))
        docs = spark.read.parquet(str(tmp_path / f"stage-{k}"))
        seen[name] = docs.collect()
        if name != "pack_sequences":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    clean = {r.doc_id for r in seen["drop_toxic"]}
    assert len(clean & set(range(0, 240, 6))) <= 2 and len(clean) >= 198
    # document 500 has the line with " more" at its end: 5 edits, more than the share that may be
    assert sum("each document repeats" in (r.text or "") for r in seen["drop_lines"]) == 2
    mixed = seen["mix_sources"]
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in seen["drop_copies"]}
    packed = seen["pack_sequences"]
    assert sum(r.start + r.length == r.doc_tokens for r in packed) == len(mixed)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(packed)
