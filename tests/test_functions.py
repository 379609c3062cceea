"""Scalar functions: URLs, text, identity, answers."""

import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.functions import answers, identity, text, urls
from newsloom.sites import AGFUNDER, INC42_FEED

NBSP, WIDE, BOM = chr(0xA0), chr(0x3000), chr(0xFEFF)


def column(spark, values, make, ddl="c string"):
    """The results of a column expression over values of one column ``c``."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {ddl}")
    rows = df.select("i", make.alias("out")).orderBy("i").collect()
    return [r.out for r in rows]


CANONICAL = [
    ("https://agfundernews.com/foo?utm=1#x", "https://agfundernews.com/foo"),
    ("https://www.inc42.com/buzz/foo/", "https://inc42.com/buzz/foo"),
    ("HTTP://me:pw@WWW.Host.com:8080/A//b///", "http://host.com/A//b"),
    ("https://host.com", "https://host.com/"),
    ("  https://host.com/a\nb\t ", "https://host.com/ab"),
    ("https://host.com/a/../b/./c/..", "https://host.com/b"),
    ("https://host.com/%2e%2E/a", "https://host.com/a"),
    ("https://host.com/a b|c", "https://host.com/a%20b|c"),
    ("https://host.com/" + chr(0xE9) + '"<>`{}', "https://host.com/%C3%A9%22%3C%3E%60%7B%7D"),
    ("https:\\\\host.com\\a", "https://host.com/a"),
    ("https://host.com?x=/a/b", "https://host.com/"),
    ("http://[::1]:80/x/", "http://[::1]/x"),
    ("mailto:a@b.com", None),
    ("no url", None),
    ("http://a b.com/", None),
    ("https:///", None),
    ("", None),
    (None, None),
]


def test_canonical_url(spark):
    got = column(spark, [u for u, _ in CANONICAL], urls.canonical_url("c"))
    assert got == [c for _, c in CANONICAL]


def test_canonical_url_is_idempotent(spark):
    once = [c for _, c in CANONICAL if c]
    assert column(spark, once, urls.canonical_url("c")) == once


RESOLVED = [
    ("/x", "https://h.com:81/a/b?q", "https://h.com:81/x"),
    ("x", "https://h.com/a/b", "https://h.com/a/x"),
    (" x ", "https://h.com/a/", "https://h.com/a/x"),
    ("//o.com/z", "http://h.com/a", "http://o.com/z"),
    ("?k", "https://h.com/a/b#f", "https://h.com/a/b?k"),
    ("../x", "https://h.com/a/b/c", "https://h.com/a/b/../x"),
    ("https://o.com/p", "https://h.com/", "https://o.com/p"),
    ("javascript:void(0)", "https://h.com/", None),
    ("  ", "https://h.com/", None),
    (None, "https://h.com/", None),
    ("/x", "nonsense", None),
]


def test_resolve_href(spark):
    df = spark.createDataFrame([(i, h, b) for i, (h, b, _) in enumerate(RESOLVED)], "i int, h string, b string")
    rows = df.select("i", urls.resolve_href("h", "b").alias("u")).orderBy("i").collect()
    assert [r.u for r in rows] == [u for *_, u in RESOLVED]


def test_article_rules(spark):
    slug = {
        "https://agfundernews.com/harbor-kelp-raises-11m": True,
        "https://www.agfundernews.com/Rainbow-2": True,
        "https://agfundernews.com/tag/agtech": False,
        "https://agfundernews.com/about": False,
        "https://agfundernews.com/wp-login": False,
        "https://agfundernews.com/slug/": False,
        "https://agfundernews.com/": False,
        "https://other.com/rainbow": False,
        "junk": False,
    }
    prefix = {
        "https://inc42.com/buzz/heron-bags-23-mn/": True,
        "https://inc42.com/features/indian-startup-ipo-tracker-2026/": True,
        "https://inc42.com/BUZZ/x": True,
        "https://inc42.com/buzz/": False,
        "https://inc42.com/industry/agritech/": False,
        "https://inc42.com/about": False,
    }
    assert column(spark, list(slug), urls.is_article_url("c", AGFUNDER)) == list(slug.values())
    got = column(spark, list(prefix), urls.is_article_url("c", INC42_FEED))
    assert got == list(prefix.values())


def test_prefix_filter_is_plain_text(spark):
    cases = ["https://agfundernews.com/terms-of-trade", "https://agfundernews.com/Terms", "https://agfundernews.com/news"]
    assert column(spark, cases, urls.not_excluded("c", AGFUNDER)) == [False, True, True]


def test_snapshot_url(spark):
    cases = {
        "https://WWW.x.com/a/?q#f": "https://www.x.com/a",
        "https://x.com:443/a//": "https://x.com/a/",
        "https://x.com:8443": "https://x.com:8443",
        " odd ": "odd",
    }
    assert column(spark, list(cases), urls.snapshot_url("c")) == list(cases.values())


def test_html_to_text(spark):
    cases = {
        "<p>a</p><p>b</p>": "a b",
        "x<SCRIPT>if (a<b) {}</script>y<style>p{}</style>z": "x y z",
        "&amp;lt;b&gt;&#039;&nbsp;&quot;": "<b>' &quot;",
        f" a{NBSP}{WIDE}b{BOM}\n": "a b",
        "<p": "<p",
        "": "",
    }
    assert column(spark, list(cases), text.html_to_text("c")) == list(cases.values())


def test_cuts_and_words(spark):
    assert column(spark, ["abcdef", "abcde", ""], text.truncate_text("c", 5)) == [
        "abcd" + chr(0x2026),
        "abcde",
        "",
    ]
    assert column(spark, ["abcdef"], text.cut_text("c", 2)) == ["ab"]
    words = ["", f"{NBSP} {BOM}", " a  b\tc ", None]
    assert column(spark, words, text.count_words("c")) == [0, 0, 3, None]
    assert column(spark, [f"{WIDE}x{NBSP}", " ", None], text.or_null("c")) == ["x", None, None]


@given(st.lists(st.tuples(st.text(max_size=20), st.text(max_size=20)), min_size=1, max_size=30))
@settings(max_examples=5, deadline=None)
def test_normalize_content_matches_a_plain_version(spark, pairs):
    import re

    strip = text.WS_CHARS

    def plain(title, body):
        joined = title.strip(strip) + "\x01" + body.strip(strip)
        return re.sub(f"[{re.escape(strip)}]+", " ", joined)

    clean = [
        (t, b)
        for t, b in pairs
        if not any(0xD800 <= ord(c) <= 0xDFFF for c in t + b) and (t + b).isascii()
    ]
    df = spark.createDataFrame([(i, t, b) for i, (t, b) in enumerate(clean)], "i int, t string, b string")
    rows = df.select("i", identity.normalize_content("t", "b").alias("n"), identity.content_hash("t", "b").alias("h")).orderBy("i").collect()
    for (t, b), row in zip(clean, rows, strict=True):
        assert row.n == plain(t, b).lower()
        assert row.h == hashlib.md5(row.n.encode()).hexdigest()


def test_identity(spark):
    pairs = [("Title", "Body v1"), (" title ", "BODY\n v1"), ("Title", "Body v2")]
    hash_ = identity.content_hash("t", "b")
    got = (
        spark.createDataFrame(pairs, "t string, b string")
        .select(hash_.alias("h"), identity.entry_key(F.lit("u"), hash_).alias("k"))
        .collect()
    )
    assert got[0] == got[1] and got[0].h != got[2].h and got[0].k != got[2].k
    expected = hashlib.md5(f"agritech.news:u:{got[0].h}".encode()).hexdigest()
    assert got[0].k == expected and len(got[0].k) == 32


def test_link_list_hash_ignores_order_but_not_repeats(spark):
    a, b = "https://agfundernews.com/a", "https://agfundernews.com/b"
    lists = [[a, b], [b, f" {a}{NBSP}"], [a, b, b], []]
    got = column(spark, lists, identity.link_list_hash("c"), "c array<string>")
    assert got[0] == got[1] == hashlib.md5(f"{a}\n{b}".encode()).hexdigest()
    assert got[2] != got[0] and got[3] == hashlib.md5(b"").hexdigest()


def test_run_identity(spark):
    row = spark.sql("SELECT timestamp'2025-03-09 11:05:02.004' AS ts").select(
        identity.run_id("ts").alias("r"), identity.run_date("ts").alias("d"), identity.iso_time("ts").alias("i")
    ).first()
    assert tuple(row) == ("2025-03-09T11-05-02-004Z", "2025-03-09", "2025-03-09T11:05:02.004Z")


def test_payload_is_the_json_text_of_three_fields(spark):
    row = spark.createDataFrame([("u", 'a "b"/' + chr(0xE9), "x\ny")], "u string, t string, b string")
    got = row.select(identity.extract_payload("u", "t", "b").alias("p")).first().p
    wanted = json.dumps(
        {"sourceUrl": "u", "title": 'a "b"/' + chr(0xE9), "bodyExcerpt": "x\ny"},
        ensure_ascii=False,
        separators=(",", ":"),
    )
    assert got == wanted


FENCED = '```json\n{"isRelevant":false,"startupName":null}\n```'
ANSWERS = [
    # raw answer, relevant, name, failed
    ('{"isRelevant":true,"startupName":" Harbor Kelp ","newsSummary":"x"}', True, "Harbor Kelp", False),
    (FENCED, False, None, False),
    ('```\n{"isRelevant":true}```', True, None, False),
    ('{"isRelevant":"false"}', True, None, False),
    ('{"isRelevant":""}', False, None, False),
    ('{"isRelevant":0}', False, None, False),
    ('{"isRelevant":0.0}', False, None, False),
    ('{"isRelevant":1e3}', True, None, False),
    ('{"isRelevant":null}', False, None, False),
    ('{"isRelevant":{}}', True, None, False),
    ('{"isRelevant":[]}', True, None, False),
    ('{"isRelevant":true,"startupName":7}', True, None, False),
    ('{"isRelevant":true,"startupName":"  "}', True, None, False),
    ('{"isRelevant":false,"isRelevant":true}', True, None, False),
    ("[1]", False, None, False),
    ("3", False, None, False),
    ('"text"', False, None, False),
    ("null", False, None, True),
    ("", False, None, True),
    (None, False, None, True),
    ("not json", False, None, True),
    ('{"isRelevant":true} extra', False, None, True),
    ('{"isRelevant":true}{"b":1}', False, None, True),
    ('{"isRelevant":true},{"b":1}', False, None, True),
    ('{"isRelevant":true}}', False, None, True),
    ('{"isRelevant":true}] ', False, None, True),
    ("{'isRelevant':true}", False, None, True),
]


def test_parse_extraction(spark):
    got = column(spark, [a[0] for a in ANSWERS], answers.parse_extraction("c"))
    for (raw, relevant, name, failed), row in zip(ANSWERS, got, strict=True):
        assert (row.is_relevant, row.startup_name, row.extraction_failed) == (relevant, name, failed), raw


@pytest.mark.parametrize(
    "relevant, name, summary, complete",
    [
        (False, None, None, True),
        (None, None, None, True),
        (True, "Tide", "Raised $1.5m", True),
        (True, "Tide", None, False),
        (True, None, "Raised", False),
        (True, "Tide", "  ", False),
    ],
)
def test_complete_extraction(spark, relevant, name, summary, complete):
    df = spark.createDataFrame([(relevant, name, summary)], "r boolean, n string, s string")
    assert df.select(answers.is_complete_extraction("r", "n", "s")).first()[0] is complete
