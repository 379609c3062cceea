"""Accessibility snapshots."""

from newsloom.operators.change import merge_links, new_links
from newsloom.operators.snapshots import (
    is_article_complete,
    is_paywalled,
    read_attempts,
    select_attempts,
    snapshot_article,
    snapshot_article_links,
    snapshot_lines,
    snapshot_links,
    snapshot_texts,
    snapshot_urls,
)
from newsloom.sites import INC42_FEED
from newsloom.sources.tables import read_snapshot_files, read_snapshots

WALL = INC42_FEED.paywall


def one(spark, snapshot, make):
    return spark.createDataFrame([(snapshot,)], "snapshot string").select(make).first()[0]


def test_lines_and_texts(spark):
    snapshot = (
        'page\r\n- main "x"\n  - StaticText "He said \\"hi\\"\\nthere" StaticText "two"\r\n'
        '-no space\n\t- StaticText   "  "\n- StaticText "open\n- StaticText ""'
    )
    assert len(one(spark, snapshot, snapshot_lines())) == 5
    assert one(spark, snapshot, snapshot_texts()) == ['He said "hi"\nthere', "two"]


def test_long_texts_and_many_escapes_need_no_stack(spark):
    long = "x" * 200_000
    escapes = '\\"\\n' * 50_000
    snapshot = f'- StaticText "{long}"\n- StaticText "{escapes}"\n- StaticText "{long}'
    texts = one(spark, snapshot, snapshot_texts())
    assert texts == [long, '"\n' * 50_000]


def test_urls_and_links(spark):
    snapshot = """
- link "Sign in" url=https://inc42.com/login
- link "A" [ref=e1, url=https://inc42.com/buzz/reed-mill-opens/?utm=1, focused]
- link "A again" url=HTTPS://www.inc42.com/buzz/reed-mill-opens] url=https://inc42.com/buzz/b
curl=https://inc42.com/buzz/no-node
"""
    assert one(spark, snapshot, snapshot_urls()) == [
        "https://inc42.com/login",
        "https://inc42.com/buzz/reed-mill-opens",
        "https://www.inc42.com/buzz/reed-mill-opens",
        "https://inc42.com/buzz/b",
    ]
    wanted = ["https://inc42.com/buzz/reed-mill-opens", "https://inc42.com/buzz/b"]
    assert one(spark, snapshot, snapshot_article_links("snapshot", [INC42_FEED])) == wanted
    df = spark.createDataFrame([("inc42", snapshot)], "source_id string, snapshot string")
    assert snapshot_links(df, [INC42_FEED]).first().links == wanted


def test_article(spark):
    snapshot = '- StaticText " Title "\n- StaticText "one"\n- StaticText "two"'
    row = one(spark, snapshot, snapshot_article("snapshot", 5))
    assert (row.title, row.body_excerpt) == (" Title ", "one\nt")
    assert tuple(one(spark, "- link x", snapshot_article())) == ("", "")


def test_paywall(spark):
    cases = {
        '- link "Sign in" url=https://inc42.com/login': False,
        '- StaticText "Sign in to continue reading"': True,
        '- StaticText "SIGN IN TO READ"': True,
        '- StaticText "Sign in"\n- StaticText "Join Inc42 Plus"': True,
        '- StaticText "Latest News"': False,
    }
    for snapshot, walled in cases.items():
        assert one(spark, snapshot, is_paywalled("snapshot", WALL)) is walled


def test_completeness(spark):
    cases = [("Title", "a" * 80, True), ("", "a" * 80, False), ("Title", "short", False)]
    cases += [(" ", "a" * 80, False), ("Title", " " * 80, False), (None, None, False)]
    df = spark.createDataFrame(cases, "t string, b string, want boolean")
    assert df.where(is_article_complete("t", "b") != df.want).count() == 0


def test_link_merge(spark):
    a, b, c = "https://inc42.com/buzz/a", "https://inc42.com/buzz/b", "https://inc42.com/buzz/c"
    df = spark.createDataFrame([([a, b], [b, c, c]), ([a], [a])], "old array<string>, found array<string>")
    got = df.select(merge_links("old", "found").alias("m"), new_links("old", "found").alias("n")).collect()
    assert [tuple(r) for r in got] == [([a, b, c], [c]), ([a], [])]


def shot(title, body):
    return f'- StaticText "{title}"\n- StaticText "{body}"'


def test_attempts(spark):
    long = "b" * 80
    rows = [
        ("complete", 1, shot("t", "short")),
        ("complete", 2, shot("t2", long)),
        ("complete", 3, shot("t3", long)),
        ("wall", 1, shot("t", "short")),
        ("wall", 2, shot("t", "sign in to read")),
        ("wall", 3, shot("t", long)),
        ("never", 1, shot("t1", "x")),
        ("never", 2, shot("t2", "x")),
        ("late", 3, shot("t3", "x")),
        ("late", 4, shot("t4", long)),
        ("high", 5, shot("t5", "x")),
        ("high", 7, shot("t7", "x")),
        ("high", 9, shot("t9", "x")),
        ("high", 11, shot("t11", long)),
        ("twice", 1, shot("t", long)),
        ("twice", 1, shot("t", long + " sign in to read")),
    ]
    df = spark.createDataFrame(rows, "url string, attempt int, snapshot string")
    got = {r.url: r for r in select_attempts(read_attempts(df, [INC42_FEED])).collect()}
    assert {k: (r.attempt, r.paywalled, r.complete) for k, r in got.items()} == {
        "complete": (2, False, True),
        "wall": (2, True, False),
        "never": (2, False, False),
        "late": (4, False, True),
        "high": (9, False, False),  # attempts count by rank, whatever their numbers
        "twice": (1, True, True),
    }


def test_snapshot_sources(spark, tmp_path):
    folder = tmp_path / "files" / "https%3A%2F%2Finc42.com%2Fbuzz%2Fa"
    folder.mkdir(parents=True)
    (folder / "2.txt").write_text("- StaticText \"x\"\nline 2\n")
    row = read_snapshot_files(spark, str(tmp_path / "files")).first()
    assert tuple(row) == ("https://inc42.com/buzz/a", 2, '- StaticText "x"\nline 2\n')
    spark.createDataFrame([("u", 1, "s")], "url string, attempt int, snapshot string").write.parquet(
        str(tmp_path / "table")
    )
    assert tuple(read_snapshots(spark, str(tmp_path / "table")).first()) == ("u", 1, "s")
