"""Listing pages, article pages, thin pages."""

import random
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.functions.dom import page_article, page_hrefs
from newsloom.operators.articles import (
    apply_fallback,
    extract_articles,
    fetch_pages,
    is_thin_page,
    join_articles,
    native_article,
)
from newsloom.operators.links import explode_links, listing_links, native_hrefs
from newsloom.sites import AGFUNDER, INC42_PAGES, SOURCES
from newsloom.specs import Selectors

LISTING = """<!doctype html><title>front <a href="/in-title">no</a></title>
<ul id=stories>
<li><a title="a > b" href="https://agfundernews.com/harbor-kelp-opens-second-plant">Kelp plant</a>
<li><a rel=next href='/orchid-loam-sells-its-barn?ref=mail'><img src=x>Loam</a>
<li><a href="
/orchid-loam-sells-its-barn#photos">photos</a>
</ul>
<template-like><a>bare</a><a href>empty</a><a href="tel:123">call</a></template-like>
<p><a href="/tag/soil">soil</a> <a href="https://agfundernews.com/about">who we are</a>
<a href="https://another.example/harbor">other host</a>
<!-- old: <a href="/removed-story">gone</a> --><style>a{x:'<a href="/in-style">'}</style>
<script>document.write('<a href="/written-story">w</a>')</script>"""
LINKS = [
    "https://agfundernews.com/harbor-kelp-opens-second-plant",
    "https://agfundernews.com/orchid-loam-sells-its-barn",
]
LISTING_2 = """<nav><a href="https://inc42.com/industry/soil/">soil</a></nav>
<div><a href='https://WWW.inc42.com/features/a-year-of-rain'>rain</a></div>
<div><a href="https://inc42.com/buzz/loam-and-co-hires/?x=1">hires</a></div>
<footer><a href="https://inc42.com/jobs">jobs</a></footer>"""
LINKS_2 = ["https://inc42.com/features/a-year-of-rain", "https://inc42.com/buzz/loam-and-co-hires"]

ARTICLE = """<main><p class=crumb>Home</p><h1>Moss &amp; Tide opens a lab &gt; 2 sites</h1>
<section class="article-content wide"><aside class="single-sidebar">Write to the editors</aside>
<div class="content-column"><div class="text-wrapper"><ul><li>The lab of <i>Moss &amp; Tide</i>
has nine rooms.<li>It was built <b>in May.</b></ul>&lt;more&gt;</div></div></section></main>"""


def pages(spark, rows, ddl="source_id string, section_url string, html string"):
    return spark.createDataFrame(rows, ddl)


def test_listing_links_of_both_sources_in_one_plan(spark):
    df = pages(
        spark,
        [
            ("agfunder", "https://agfundernews.com/", LISTING),
            ("inc42", "https://inc42.com/", LISTING_2),
            ("agfunder", "https://agfundernews.com/tag/x", None),
        ],
    )
    for parser in ("dom", "native"):
        got = listing_links(df, [AGFUNDER, INC42_PAGES], parser=parser).collect()
        assert [r.links for r in got] == [LINKS, LINKS_2, None]
    rows = explode_links(listing_links(df, [AGFUNDER, INC42_PAGES])).collect()
    assert [(r.link_pos, r.url) for r in rows if r.source_id == "agfunder"] == list(enumerate(LINKS))


def test_hrefs(spark):
    assert page_hrefs(LISTING)[:2] == [LINKS[0], "/orchid-loam-sells-its-barn?ref=mail"]
    native = pages(spark, [("s", "u", LISTING)]).select(native_hrefs().alias("h")).first().h
    assert [h for h in native if h] == [h for h in page_hrefs(LISTING) if h]


def test_listing_parser_plug_in(spark):
    own = replace(AGFUNDER, listing_parser=lambda markup: markup.split())
    df = pages(spark, [("agfunder", "https://agfundernews.com/", "/one /two /tag/x")])
    assert listing_links(df, [own]).first().links == [
        "https://agfundernews.com/one",
        "https://agfundernews.com/two",
    ]


def test_article_without_sidebar(spark):
    row = extract_articles(pages(spark, [("agfunder", "u", ARTICLE)]), [AGFUNDER], 2000).first()
    assert row.title == "Moss & Tide opens a lab > 2 sites"
    assert row.body_excerpt == (
        "The lab of Moss & Tide has nine rooms. It was built in May. <more>"
    )
    short = extract_articles(pages(spark, [("agfunder", "u", ARTICLE)]), [AGFUNDER], 11).first()
    assert short.body_excerpt == "The lab of" + chr(0x2026)


def test_article_of_the_prefix_source(spark):
    markup = (
        '<meta property="og:title" content=" From meta "><h1>no class</h1>'
        '<div class="entry-content">b</div><article>c</article>'
    )
    df = pages(spark, [("inc42", "u", markup), ("agfunder", "u", markup), ("inc42", "u", "")])
    got = extract_articles(df, [AGFUNDER, INC42_PAGES]).collect()
    assert (got[0].title, got[0].body_excerpt) == ("From meta", "b")
    assert (got[1].title, got[1].body_excerpt) == ("no class", "")
    assert (got[2].title, got[2].body_excerpt) == ("", "")


def test_article_parser_plug_in(spark):
    own = replace(AGFUNDER, article_parser=lambda markup: (markup[:3], "<p>" + markup[3:]))
    row = extract_articles(pages(spark, [("agfunder", "u", "abcdef")]), [own]).first()
    assert (row.title, row.body_excerpt) == ("abc", "def")


def test_selector_details():
    def body(markup, *selectors):
        return page_article(markup, Selectors(titles=("h1",), bodies=selectors))[1]

    # the first match only, an empty match falls through, nested matches stay inside
    assert body("<div class=a>1</div><div class=a>2</div>", ".a") == "1"
    assert body("<div class=a></div><p class=b>x</p>", ".a", ".b") == "x"
    assert body("<div class='a z'><div class=a>1</div>2</div>", ".a") == '<div class="a">1</div>2'
    assert body("<div class=b>0</div><div class=a><i><u class=b>1</u></i></div>", ".a .b") == "1"
    # what the parser serialises again
    assert body("<article>a &lt; b &copy; &quot;<br/>c</article>", "article") == (
        f"a &lt; b {chr(0xA9)} \"<br>c"
    )
    assert body("<article>x<script>a<b</script>y</article>", "article") == "x<script>a<b</script>y"
    # open paragraphs and list items end by themselves
    assert body("<article><p>a<p>b<ul><li>c<li>d</article>tail", "article") == (
        "<p>a</p><p>b</p><ul><li>c</li><li>d</li></ul>"
    )
    assert body("<article><b>a<p>b</article>z", "article").startswith("<b>a<p>b")
    assert body("<article>never closed", "article") == "never closed"


def test_native_article(spark):
    title, body = native_article("html")
    df = pages(spark, [("s", "u", "<h1 class=x> T </h1><article><p>a</p>b</article>")])
    assert tuple(df.select(title, body).first()) == ("T", "a b")


def test_thin_page(spark):
    df = pages(spark, [("s", "u", "x" * 499), ("s", "u", "x" * 500)])
    assert [r[0] for r in df.select(is_thin_page("html")).collect()] == [True, False]


def test_fallback_reads_the_snapshot_of_thin_pages(spark):
    snapshot = '- StaticText " The title "\n- StaticText "a < b &lt;"\n- StaticText "c"'
    articles = spark.createDataFrame(
        [
            ("agfunder", "u1", "thin", "t", "b"),
            ("agfunder", "u2", "thin", "t", "b"),
            ("agfunder", "u3", "x" * 600, "t", "b"),
            ("inc42", "u1", "thin", "t", "b"),
        ],
        "source_id string, url string, html string, title string, body_excerpt string",
    )
    snaps = spark.createDataFrame([("u1", snapshot), ("u3", snapshot)], "url string, snapshot string")
    rows = apply_fallback(articles, snaps, [AGFUNDER, INC42_PAGES]).collect()
    got = {(r.source_id, r.url): (r.title, r.body_excerpt) for r in rows}
    assert got == {
        ("agfunder", "u1"): ("The title", "a < b < c"),
        ("agfunder", "u2"): ("t", "b"),
        ("agfunder", "u3"): ("t", "b"),
        ("inc42", "u1"): ("", "a < b < c"),
    }


def test_fetch_takes_the_last_copy_and_misses_become_errors(spark):
    table = spark.createDataFrame(
        [
            ("https://h.com/a/", "old", 1, None),
            ("https://www.h.com/a?x", "new", 2, None),
            ("https://h.com/b", None, 1, "HTTP 500"),
            ("bad url", "z", 1, None),
            ("https://h.com/unwanted", "z", 1, None),
        ],
        "url string, html string, t long, fetch_error string",
    ).withColumn("fetched_at", F.timestamp_seconds("t"))
    links = spark.createDataFrame(
        [("https://h.com/a",), ("https://h.com/b",), ("https://h.com/c",), (None,)], "url string"
    )
    keys = links.where("url is not null").distinct()
    for bound in (None, 10):
        found = fetch_pages(keys, table.select(*schemas.struct_type(schemas.PAGES).names), bound)
        got = {r.url: (r.html, r.fetch_error) for r in found.collect()}
        assert got == {
            "https://h.com/a": ("new", None),
            "https://h.com/b": (None, "HTTP 500"),
        }
        joined = join_articles(links, found, ["url"], bound).collect()
        assert {r.url: r.fetch_error for r in joined} == {
            "https://h.com/a": None,
            "https://h.com/b": "HTTP 500",
            "https://h.com/c": "page not fetched",
            None: "page not fetched",
        }


def test_broken_markup_neither_fails_nor_takes_long():
    rules = Selectors(titles=("h1",), bodies=("div",))
    pieces = ("<", "<a ", "<![", "<!--", "<div>", "<p>", "<script>", "</b>", "<a href='", "&")
    for piece in pieces:
        page_hrefs(piece * 20_000)
        page_article(piece * 20_000, rules)
    assert page_hrefs("<![if x]><a href=/one>1</a><!x><?y><a href=/two") == ["/one"]
    assert page_article("<h1>a<![CDATA[b]]>c</h1><div>d<br/x", rules) == ("ac", "d")


@pytest.mark.parametrize("spec", SOURCES, ids=lambda s: s.source_id)
def test_nested_markup_takes_linear_time(spec):
    selectors = replace(spec.selectors, bodies=(*spec.selectors.bodies, ".a .b div", "p .c span"))

    def seconds(count, page):
        started = time.process_time()
        page_article(page(count), selectors)
        return time.process_time() - started

    pages = (
        lambda n: "<div class='a'>" * n,
        lambda n: "<div class='text-wrapper'>" * n,
        lambda n: "<p><object>" + "<x><div>" * (n // 2),
        lambda n: "<span class=a>" * (n // 2) + "</span>" * (n // 2),
        lambda n: "<b><div>" * (n // 4) + "</b>" * (n // 4) + "</div>" * (n // 4),
        lambda n: "<span class=a><div>" * (n // 4) + "</span>" * (n // 4),
        lambda n: "<ul><li>" * (n // 2),
        lambda n: "<table><tr><td>" * (n // 3),
    )
    for page in pages:  # eight times the markup; a quadratic walk takes 64 times as long
        assert seconds(160_000, page) < 20 * seconds(20_000, page) + 0.5, page(20)


def _plain_match(chain, path):
    """The last of a chain of (tag, class) fits the path, the rest around it in order."""
    def fits(step, element):
        tag, _, name = step.partition(".")
        return (not tag or tag == element[0]) and (not name or name == element[1])

    if not chain or not fits(path[-1], chain[-1]):
        return False
    rest = list(path[:-1])
    for element in chain[:-1]:
        if rest and fits(rest[0], element):
            rest.pop(0)
    return not rest


def test_descendant_selectors_equal_a_search_of_the_chain():
    draw = random.Random(6)
    paths = [(".a", ".b"), ("span.a", "div", ".b"), ("div", "div", "div.c"), ("b", "span.c")]
    for _ in range(400):
        chain, markup, first, number = [], [], {}, 0
        for _ in range(draw.randint(3, 40)):
            if chain and draw.random() < 0.4:
                inline = [i for i, e in enumerate(chain) if e[0] in ("span", "b")]
                at = draw.choice(inline) if inline and draw.random() < 0.5 else len(chain) - 1
                tag = chain[at][0]
                at = max(i for i, e in enumerate(chain) if e[0] == tag)
                markup.append(f"</{tag}>")
                # an inline element ends alone, another takes with it what is open inside
                chain = chain[:at] + (chain[at + 1 :] if tag in ("span", "b") else [])
            else:
                element = draw.choice(("div", "span", "b")), draw.choice(("a", "b", "c"))
                chain.append(element)
                number += 1
                markup.append(f"<{element[0]} class={element[1]} id=n{number}><i>{number}</i>")
                for path in paths:
                    if path not in first and _plain_match(chain, path):
                        first[path] = str(number)
        for path in paths:
            body = page_article("".join(markup), Selectors(bodies=(" ".join(path),)))[1]
            got = body.partition("<i>")[2].partition("</i>")[0] if body else None
            assert got == first.get(path), (path, "".join(markup))


def test_templates_and_raw_text():
    rules = Selectors(titles=("h1",), bodies=("article",))
    page = (
        "<template><h1>shape</h1><article>row</article><a href=/t>t</a></template>"
        "<iframe><h1>frame</h1></iframe><xmp><h1>raw</h1></xmp><noframes><article>n</article>"
        "</noframes><h1>Real</h1><article>x<template><p>y</p></template>z</article><a href=/u>u</a>"
    )
    assert page_article(page, rules) == ("Real", "x<template><p>y</p></template>z")
    assert page_hrefs(page) == ["/u"]
    assert page_hrefs("</template><a href=/v>") == ["/v"]


def test_attribute_values():
    cases = {
        "<a href='/s?a=1&copy=2&amp;b=3&lt=4'>": "/s?a=1&copy=2&b=3&lt=4",
        '<A class=x HREF="/q&#39;s&eacute;">': "/q's" + chr(0xE9),
        "<a title=it's href=/x/y/>": "/x/y/",
        '<a title="a > b" href = /z >': "/z",
        "<a href=/first href=/second>": "/first",
        "<a href>": "",
    }
    assert {markup: page_hrefs(markup)[0] for markup in cases} == cases


def test_a_worker_reads_a_few_pages_of_a_batch_at_a_time():
    import pyarrow as pa

    from newsloom.operators.links import PAGES, read_slices

    read = []
    count = 2 * PAGES + 5
    batch = (pa.array([*map(str, range(count - 1)), None]), pa.array(["s"] * count))
    found = read_slices(
        iter([batch]), lambda page, source: read.append(page) or {"text": page}, pa.struct([("text", pa.string())])
    )
    assert len(next(found)) == PAGES == len(read)
    rest = [row["text"].as_py() for part in found for row in part]
    assert rest == [*map(str, range(PAGES, count - 1)), None]
