"""Repeated passages against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from newsloom.llm import factors
from newsloom.llm.queries import QUERIES
from tests.llm.helpers import prose

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def brute(texts, length, keep_first):
    """Per text (in order) the bytes that stay, those removed, and the number of runs."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    met, found = set(), []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            w = d[i : i + length]
            if (w in met) if keep_first else counts[w] > 1:
                gone[i : i + length] = [True] * length
            met.add(w)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        found.append((kept, sum(gone), runs))
    return found


def corpus():
    passage = [prose(40 + 9 * k, 500 + k) for k in range(5)]
    texts = []
    for i in range(60):
        parts = [prose(5 + 3 * (i % 11), i), passage[i % 5], prose(3 + i % 7, 1000 + i)]
        if i % 4 == 0:
            parts = [prose(30, 77), *parts[::-1]]
        if i % 6 == 1:
            parts[1] = parts[1].replace("sol", "sul", 1)
        texts.append((" " if i % 3 else "").join(parts))
    texts += [texts[7], texts[7], "", None, "short", "é" * 150, "é" * 150 + "è", "ab" * 400, "a" * 700]
    texts += ["x" * 199, "x" * 199, "y" * 200, "y" * 200, "\U0001f600" + prose(60, 9), prose(60, 9) + "ß"]
    return texts


def test_ranks_are_the_order_of_strings():
    draw = random.Random(1)
    for length in (3, 8, 20, 37):
        data = bytes(draw.randrange(2, 5) for _ in range(200))
        strings = [data[i : i + length].ljust(length, b"\0") for i in range(len(data))]
        places = {s: k for k, s in enumerate(sorted({*strings}))}
        got = factors.ranks(np.frombuffer(data, dtype=np.uint8), length)
        order = {p: k for k, p in enumerate(sorted({*got.tolist()}))}
        assert [order[p] for p in got.tolist()] == [places[s] for s in strings]


def test_anchors_depend_on_the_window_alone():
    draw = random.Random(4)
    shared = bytes(draw.randrange(97, 123) for _ in range(700))
    data = bytes(draw.randrange(97, 123) for _ in range(333)) + shared + b"!" * 400
    texts = [shared, b"", b"x" * 199, data, b"ab" * 300, shared]
    with np.errstate(over="ignore"):
        for block in (50, 1000, 100_000):
            windows = [{} for _ in texts]
            for segments in factors.anchors(texts, 200, 32, block):
                for i, h, s, c, d in zip(*segments, strict=True):
                    assert d == texts[i][s : s + c + 199]
                    windows[i] |= {int(s) + k: int(h) for k in range(c)}
            for text, found in zip(texts, windows, strict=True):
                assert sorted(found) == list(range(max(0, len(text) - 199)))
            assert windows[0] == windows[5]
            assert all(windows[3][333 + s] == h for s, h in windows[0].items())


def test_the_smallest_hash_of_each_window():
    draw = np.random.default_rng(3)
    for size, span, window in ((300, 1 << 20, 20), (4000, 1 << 60, 169), (500, 40, 30), (50, 9, 50)):
        hashes = draw.integers(0, span, size, dtype=np.uint64)
        at, start, count = factors._smallest(hashes, window)
        low = (hashes & np.uint64(factors.SPARSE)) == 0
        want = []
        for s in range(size - window + 1):
            places = [k for k in range(s, s + window) if low[k]] or range(s, s + window)
            want.append(min(places, key=lambda k: (hashes[k], k)))
        assert np.repeat(at, count).tolist() == want and start[0] == 0


def test_cut():
    assert factors.cut(b"abcdefgh", []) == (b"abcdefgh", 0, 0)
    assert factors.cut(b"abcdefgh", [(1, 3), (2, 4), (4, 5), (6, 8)]) == (b"af", 6, 2)
    assert factors.cut(b"abcdefgh", [(0, 8), (2, 3)]) == (b"", 8, 1)


@pytest.mark.parametrize("meet", [factors.MEET, 1])
@pytest.mark.parametrize("keep_first", [True, False])
def test_documents_against_brute_force(spark, keep_first, meet):
    texts = corpus()
    rows = [(i, text, "kept by none") for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, kept string")
    got = factors.dedup(docs, keep_first=keep_first, meet=meet)
    assert got.columns == ["doc_id", "text", *factors.RESULTS]
    want = brute(texts, 200, keep_first)
    for r in got.collect():
        assert r.text == texts[r.doc_id]
        assert (bytes(r.kept), r.n_removed, r.n_spans) == want[r.doc_id], r.doc_id
        assert r.n_bytes == len((r.text or "").encode())
    assert sum(1 for _, n, _ in want if n) > 30


def test_query_against_brute_force(spark, tmp_path):
    texts = corpus()
    texts.append("z" * 150 + prose(4000, 1) + prose(100, 2) + prose(3000, 3) + prose(100, 2))
    rows = [(None if i % 9 == 8 else i // 2, t, "en", "s", 0) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_repeated_bytes"](spark, str(tmp_path)).collect()
    want = [
        (i, len((t or "").encode()), n, k, hashlib.sha256(kept).hexdigest())
        for (i, t, *_), (kept, n, k) in zip(rows, brute(texts, 200, False), strict=True)
    ]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_rows_of_one_document_come_back_alike(spark):
    text = prose(80, 3)
    rows = [(2, text), (2, text), (1, text), (None, text), (None, text)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r.doc_id or 9, r.n_removed > 0) for r in factors.dedup(docs).collect())
    assert got == [(1, False), (2, True), (2, True), (9, True), (9, True)]
    assert factors.dedup(docs.limit(0)).count() == 0
