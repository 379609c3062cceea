"""Periodic runs and spelling variants against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from newsloom.llm import periodic, spelling
from newsloom.llm.queries import QUERIES
from tests.llm.helpers import WORD, words

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def save(spark, tmp_path, rows):
    frame = spark.createDataFrame(
        [(i, text, "en", "s", len(text or "")) for i, text in rows], DOCS
    )
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def brute_runs(found, least=24, times=3):
    """Maximal stretches of each period; the smallest period of a stretch counts."""
    met = {}
    for q in range(1, len(found) // times + 1):
        i = 0
        while i + q < len(found):
            j = i
            while j + q < len(found) and found[j] == found[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                met.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in met.items())


def made_periodic(i, found):
    h = zlib.crc32(str(i).encode()) if i is not None else 1
    n, g = len(found), h // 10
    if h % 10 or not n:
        return found
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if k < a else found[a + (k - a) % p] for k, w in enumerate(found)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected_runs(i, text):
    found = made_periodic(i, WORD.findall(text or ""))
    met = brute_runs(found)
    gone = {k for s, n, q in met for k in range(s + q, s + n)}
    top = None
    for run in met:
        if top is None or run[1] * top[2] > top[1] * run[2]:
            top = run
    return (
        i, len(met), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
        sha("".join(f"{s},{n},{q}\n" for s, n, q in met)),
        sha(" ".join(w for k, w in enumerate(found) if k not in gone)),
    )


def test_the_cover_meets_every_difference():
    apart = {(a - b) % periodic.CYCLE for a in periodic.COVER for b in periodic.COVER}
    assert len(apart) == periodic.CYCLE


def test_extensions_against_comparison():
    draw = random.Random(3)
    for size, kinds in ((1, 1), (40, 2), (400, 2), (500, 40)):
        ids = [draw.randrange(kinds) for _ in range(size)]
        if size == 500:
            ids[200:450] = ids[10:260]
        lce = periodic.Extensions(np.array([*ids, kinds]))
        pairs = [(a, b) for a in range(size) for b in range(a + 1, size)]
        draw.shuffle(pairs)
        pairs = pairs[:3000]
        if not pairs:
            continue
        a, b = np.array(pairs).T
        for x, y, got in zip(a, b, lce(a, b), strict=True):
            k = 0
            while y + k < size and ids[x + k] == ids[y + k]:
                k += 1
            assert got == k


def test_runs_of_arrays_against_brute_force():
    draw = random.Random(5)
    for _ in range(60):
        docs = []
        for _ in range(draw.randint(1, 6)):
            n, kinds = draw.choice([0, 3, 24, 30, 80, 300]), draw.choice([1, 2, 3, 20])
            doc = [draw.randrange(kinds) for _ in range(n)]
            if n > 40 and draw.random() < 0.6:
                start = draw.randrange(n // 2)
                q = draw.randint(1, max(1, (n - start) // 3))
                doc = doc[:start] + [doc[start + k % q] for k in range(n - start)]
                if draw.random() < 0.5:
                    doc[draw.randrange(n)] = 0
            docs.append(doc)
        for least, times in ((24, 3), (6, 3), (4, 2)):
            doc, *found = periodic.runs([np.array(d, dtype=np.int64) for d in docs], least, times)
            got = [[] for _ in docs]
            for i, *run in zip(doc.tolist(), *(f.tolist() for f in found), strict=True):
                got[i].append(tuple(run))
            assert got == [brute_runs(d, least, times) for d in docs]


def run_rows():
    rows = [(i, " ".join(words(30 + 7 * i, i))) for i in range(60)]
    rows += [
        (100, None), (101, ""), (102, " \t\n"), (103, "one"), (104, "la " * 23), (105, "la " * 24),
        (106, "a b " * 11 + "a b c"), (107, "x y z " * 40 + "end " + "u v " * 30),
        (108, "été \U0001f600 " * 30), (None, "tick tock " * 40), (None, "plain"),
        (109, "x y z " * 40), (109, "x y z " * 40),
        (110, " ".join(words(300, 7)) + " " + "na " * 20000),
        (111, " ".join(words(9000, 8) * 4)),
    ]
    return rows


def test_periodic_query_against_brute_force(spark, tmp_path):
    rows = run_rows()
    got = QUERIES["op12_periodic_runs"](spark, save(spark, tmp_path, rows)).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    short = [r for r in rows if len(r[1] or "") < 20000]
    want = [expected_runs(i, text) for i, text in short]
    left = [tuple(r) for r in got if r.doc_id not in (110, 111)]
    assert sorted(left, key=key) == sorted(want, key=key)
    assert sum(1 for r in want if r[1]) > 8
    found = {r.doc_id: r for r in got}
    assert zlib.crc32(b"110") % 10 and zlib.crc32(b"111") % 10
    assert (found[110].start, found[110].length, found[110].period) == (300, 20000, 1)
    assert found[110].exponent_milli == 20_000_000
    assert (found[111].start, found[111].length, found[111].period) == (0, 36000, 9000)
    assert found[111].collapsed_sha256 == sha(" ".join(words(9000, 8)))


def test_collapse_keeps_columns_and_takes_chunks(spark):
    rows = [(i, "p q " * 20, "n") for i in range(7)] + [(None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs string")
    docs = docs.withColumnRenamed("text", "body")
    for chunk in (1, 100, 10**6):
        got = periodic.collapse(docs, text="body", chunk=chunk)
        assert got.columns == ["doc_id", "body", *periodic.RESULTS]
        for r in got.collect():
            if r.doc_id is None:
                assert (r.n_words, r.runs, r.top, r.collapsed) == (0, [], None, "")
            else:
                assert [tuple(x) for x in r.runs] == [(0, 40, 2)] and r.collapsed == "p q"
    assert periodic.collapse(docs.limit(0), text="body").count() == 0


RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected_groups(counted):
    near = {w: [u for u in counted if one_edit(w, u)] for w in counted}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda u: (-counted[u], u), default=None)
        form[w] = best if best and counted[best] >= 2 * counted[w] else None
    rows = []
    for w in counted:
        top = w
        while form[top]:
            top = form[top]
        rows.append((
            w, form[w], top, counted[w], len(near[w]), counted[form[w]] if form[w] else None
        ))
    return sorted(rows)


def test_spelling_query_against_brute_force(spark, tmp_path):
    draw = random.Random(11)
    base = words(60, 3) + ["élèves", "caféé", "balloon", "ballon", "aaaaaa", "aaaaa", "straße"]
    rows = []
    for i in range(160):
        text = []
        for _ in range(60):
            w = base[int(len(base) * draw.random() ** 2)]
            if draw.random() < 0.08:
                k = draw.randrange(len(w))
                w = draw.choice([w[:k] + "x" + w[k:], w[:k] + "q" + w[k + 1 :], w[:k] + w[k + 1 :]])
            text.append(w.upper() if draw.random() < 0.1 and w.isascii() else w)
        rows.append((i, draw.choice([" ", ", ", "7"]).join(text)))
    rows += [(900, None), (901, ""), (902, "z" * 3000 + " " + ("z" * 2999 + "y ") * 3),
             (902, "z" * 3000), (903, "z" * 3000), (904, "z" * 3000), (None, "balloon balloon"),
             (905, "lantern " * 3 + "lanterns " * 9 + "lanternsk " * 30)]
    counts = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = lower(run)
            h = zlib.crc32(f"{i}:{run}".encode()) if i is not None else 1
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    counted = {w: n for w, n in counts.items() if n >= 3}
    got = QUERIES["op13_spelling_groups"](spark, save(spark, tmp_path, rows)).collect()
    key = lambda r: r[0]
    want = expected_groups(counted)
    assert sorted(map(tuple, got), key=key) == want
    assert sum(1 for r in want if r[1]) > 20 and any(r[1] and r[2] != r[1] for r in want)


def test_random_words_share_nodes_over_ranges(spark):
    draw = random.Random(2)
    vocabulary = {"".join(draw.choice("abé") for _ in range(draw.randint(1, 7))) for _ in range(500)}
    counted = {w: draw.randint(1, 40) for w in sorted(vocabulary)}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    frame = spark.createDataFrame(list(counted.items()), "word string, n bigint")
    try:
        for parts in ("1", "13", "90"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got = spelling.group(frame).collect()
            assert sorted(map(tuple, got), key=lambda r: r[0]) == expected_groups(counted)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("rows", [[], [(None, 4)], [("single", 3)]])
def test_few_words(spark, rows):
    got = spelling.group(spark.createDataFrame(rows, "word string, n bigint")).collect()
    assert [tuple(r) for r in got] == [(w, None, w, n, 0, None) for w, n in rows if w]


def test_borders_name_a_node_once():
    ends = [(0, "aa", "abc"), (2, "abcd", "abcf"), (3, "abcfg", "b"), (5, "ba", "c")]
    found = spelling.borders(ends)
    assert found[0] == ([], "abc", 3)
    assert found[2] == ([0, 0, 0], "abcf", 4)
    assert found[3] == ([0, 0, 0, 2], "b", 1)
    assert found[5] == ([3], "c", 0)
