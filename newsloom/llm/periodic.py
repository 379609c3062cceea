"""Find and collapse periodic runs of words in documents.

A run is a stretch of consecutive words with smallest period ``q`` that no neighbouring word
extends, at least ``least`` words and ``times`` periods long. Its first ``q`` words stay, the
rest of it goes.

Longest common extensions (LCE) come from a difference cover: of all suffixes only those at
places whose residue mod 31 lies in a set of six are sorted, by blocks of 31 words, then by
doubling. For any two places some shift below 31 leads both to sorted suffixes, so an LCE
compares at most that many words and ends in a range minimum over the common prefixes of
neighbouring sorted suffixes (a sparse table). Runs are met on a harmonic grid: a run with
period ``q`` holds a stretch of ``2q`` places or more (``least - q`` for small ``q``) whose word
comes again ``q`` later, so every ``2q``-th place is tried and extended by an LCE in both
directions: about n log n tries for n words. Of several periods of one stretch the smallest
counts.

Documents are taken in chunks of ``CHUNK`` words, parted by words that occur nowhere else, so
small documents share the sorting; a longer document is a chunk by itself.

Nulls: a null text has no words; ids and other columns pass through, whatever their values.
Repeated rows are judged one by one and come back as often as given. Empty tables give empty
tables. Columns named like a result (``RESULTS``) are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 24
TIMES = 3
#: Words sorted at a time, and grid places tried at a time.
CHUNK = 300_000
TRIES = 2_000_000

#: A perfect difference cover: every residue mod 31 is a difference of two of these. Fixed
#: values.
CYCLE = 31
COVER = (0, 1, 3, 8, 12, 18)

RUN = "struct<start: bigint, length: bigint, period: bigint>"
RESULTS = {"n_words": "bigint", "runs": f"array<{RUN}>", "top": RUN, "collapsed": "string"}


def _shifts() -> np.ndarray:
    """For two residues the smallest shift that brings both into the cover."""
    cover = np.zeros(CYCLE, dtype=bool)
    cover[list(COVER)] = True
    at = np.arange(CYCLE)
    met = cover[(at[:, None, None] + at) % CYCLE] & cover[(at[None, :, None] + at) % CYCLE]
    return met.argmax(axis=2)


SHIFTS = _shifts()
_SLOT = np.full(CYCLE, -1)
_SLOT[list(COVER)] = np.arange(len(COVER))


class Extensions:
    """LCE queries on an array of word ids whose last id occurs once."""

    def __init__(self, ids: np.ndarray) -> None:
        size = len(ids)
        ends = ids.max(initial=0) + 1 + np.arange(2 * CYCLE)
        self.ids = np.concatenate([ids, ends])
        rounds = -(-size // CYCLE)
        self.places = (np.arange(rounds)[:, None] * CYCLE + np.array(COVER)).ravel()
        self.places = self.places[self.places < size]
        levels = [self._blocks()]
        steps = [len(COVER)]
        while (after := self._double(levels[-1], steps[-1])) is not None:
            levels.append(after)
            steps.append(2 * steps[-1])
        self.rank = levels[-1]
        self.table = [self._neighbours(levels, steps)]
        while 2 * (width := 1 << (len(self.table) - 1)) <= len(self.rank):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))

    def _blocks(self) -> np.ndarray:
        """Order of the sorted places by their first ``CYCLE`` words; equal blocks share the
        rank of the first of them."""
        window = np.lib.stride_tricks.sliding_window_view(self.ids, CYCLE + 1)[self.places]
        window = window.astype(np.int64)
        pairs = [window[:, i] << 32 | window[:, i + 1] for i in range(0, CYCLE - 1, 2)]
        keys = [*pairs, window[:, CYCLE - 1]]
        order = np.lexsort(keys[::-1])
        fresh = np.zeros(len(order), dtype=bool)
        fresh[:1] = True
        for key in keys:
            fresh[1:] |= key[order[1:]] != key[order[:-1]]
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
        return rank

    @staticmethod
    def _double(rank: np.ndarray, step: int) -> np.ndarray | None:
        """Ranks by blocks of twice the length; only places with an equal are sorted again."""
        tied = np.flatnonzero(np.bincount(rank, minlength=len(rank))[rank] > 1)
        if not len(tied):
            return None
        second = np.zeros(len(tied), dtype=np.int64)
        inside = tied + step < len(rank)
        second[inside] = rank[tied[inside] + step]
        order = np.lexsort((second, rank[tied]))
        one, two = rank[tied][order], second[order]
        at = np.arange(len(order))
        head = np.ones(len(order), dtype=bool)
        head[1:] = one[1:] != one[:-1]
        fresh = head.copy()
        fresh[1:] |= two[1:] != two[:-1]
        begin = np.maximum.accumulate(np.where(head, at, 0))
        place = np.maximum.accumulate(np.where(fresh, at, 0))
        after = rank.copy()
        after[tied[order]] = one + place - begin
        return after

    def _neighbours(self, levels: list[np.ndarray], steps: list[int]) -> np.ndarray:
        """Common words of each sorted suffix and the one before it; 0 for the first."""
        order = np.empty(len(self.rank), dtype=np.int64)
        order[self.rank] = np.arange(len(order))
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), dtype=np.int64)
        for rank, step in zip(levels[::-1], steps[::-1], strict=True):
            same = rank[a] == rank[b]
            common[same] += step // len(COVER) * CYCLE
            a[same] += step
            b[same] += step
        rest = self._words(self.places[a], self.places[b], np.full(len(a), CYCLE))
        return np.concatenate([[0], common + rest])

    def _words(self, one: np.ndarray, two: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Common words from two places on, at most ``most``, by comparing them."""
        found = np.zeros(len(one), dtype=np.int64)
        live = np.arange(len(one))
        for k in range(CYCLE):
            live = live[most[live] > k]
            live = live[self.ids[one[live] + k] == self.ids[two[live] + k]]
            if not len(live):
                break
            found[live] += 1
        return found

    def __call__(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Common words from two (different) places on."""
        shift = SHIFTS[one % CYCLE, two % CYCLE]
        found = self._words(one, two, shift)
        on = np.flatnonzero(found == shift)
        a, b = one[on] + shift[on], two[on] + shift[on]
        a = self.rank[a // CYCLE * len(COVER) + _SLOT[a % CYCLE]]
        b = self.rank[b // CYCLE * len(COVER) + _SLOT[b % CYCLE]]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp(high - low)[1] - 1
        for k in np.unique(level):
            some = level == k
            row = self.table[k]
            least = np.minimum(row[low[some]], row[high[some] - (1 << int(k))])
            found[on[some]] += least
        return found


def _grid(first: np.ndarray, sizes: np.ndarray, least: int, times: int):
    """Places and periods to try, in blocks: for documents that begin at ``first``."""
    most = np.where(sizes >= least, sizes // times, 0)
    doc = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(len(doc)) - np.repeat(np.cumsum(most) - most, most) + 1
    step = np.maximum(least - period, (times - 1) * period)
    tries = -(-(sizes[doc] - period) // step)
    ends = np.cumsum(tries)
    at = 0
    while at < len(doc):
        base = ends[at] - tries[at]
        after = max(at + 1, int(np.searchsorted(ends, base + TRIES, side="right")))
        part = slice(at, after)
        which = np.repeat(np.arange(at, after), tries[part])
        k = np.arange(len(which)) + base - np.repeat(ends[part] - tries[part], tries[part])
        yield first[doc[which]] + k * step[which], period[which]
        at = after


def runs(
    docs: list[np.ndarray], least: int = LEAST, times: int = TIMES
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``doc, start, length, period`` of all runs of documents given as arrays of word ids
    (from 0), by document, start and period."""
    sizes = np.array([len(d) for d in docs], dtype=np.int64)
    none = np.empty(0, dtype=np.int64)
    if not (sizes >= least).any():
        return none, none, none, none
    top = max((int(d.max()) for d in docs if len(d)), default=0) + 1
    parts = [np.array([top], dtype=np.int64)]
    for i, doc in enumerate(docs):  # a word of its own before the first and after each
        parts += [doc, np.array([top + 1 + i], dtype=np.int64)]
    ids = np.concatenate(parts)
    first = np.cumsum(sizes + 1) - sizes
    size = len(ids)
    forward = backward = None
    found = []
    for place, period in _grid(first, sizes, least, times):
        same = ids[place] == ids[place + period]
        place, period = place[same], period[same]
        if not len(place):
            continue
        if forward is None:
            forward, backward = Extensions(ids), Extensions(ids[::-1])
        after = forward(place, place + period)
        before = backward(size - place - period, size - place)
        length = before + after + period
        keep = (length >= least) & (length >= times * period)
        found.append(np.stack([place - before, length, period])[:, keep])
    if not found:
        return none, none, none, none
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    fresh = np.ones(len(start), dtype=bool)
    fresh[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[fresh], length[fresh], period[fresh]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    doc = np.searchsorted(first, start, side="right") - 1
    return doc, start - first[doc], length, period


def _top(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exponent; of equals the first, then of smallest period."""
    best = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _chunk(texts: list[list[bytes]], least: int, times: int):
    """Runs and collapsed text of each document."""
    flat = np.empty(sum(map(len, texts)), dtype=object)
    flat[:] = [w for words in texts for w in words]
    ids = pd.factorize(flat)[0].astype(np.int64)
    ends = np.cumsum([0, *map(len, texts)])
    doc, start, length, period = runs(
        [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], least, times
    )
    cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
    for i, words in enumerate(texts):
        part = slice(cuts[i], cuts[i + 1])
        found = list(zip(
            start[part].tolist(), length[part].tolist(), period[part].tolist(), strict=True
        ))
        if found:
            depth = np.zeros(len(words) + 1, dtype=np.int64)
            for begin, size, q in found:
                depth[begin + q] += 1
                depth[begin + size] -= 1
            words = [words[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
        yield found, b" ".join(words).decode()


def _find(least: int, times: int, chunk: int):
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def named(found):
        return None if found is None else dict(zip(("start", "length", "period"), found, strict=True))

    def judged(batch: pa.RecordBatch, low: int, texts: list[list[bytes]]) -> pa.RecordBatch:
        results = list(_chunk(texts, least, times))
        part = batch.slice(low, len(texts))
        others = [c for c in part.schema.names if c != "_text"]
        return pa.RecordBatch.from_arrays(
            [
                *(part[c] for c in others),
                pa.array([len(words) for words in texts], pa.int64()),
                pa.array([[named(f) for f in found] for found, _ in results], pa.list_(run)),
                pa.array([named(_top(found)) for found, _ in results], run),
                pa.array([text for _, text in results], pa.string()),
            ],
            [*others, *RESULTS],
        )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, texts, total = 0, [], 0
            for text in batch["_text"]:
                words = (text.as_py() or "").encode().split()  # splits at ASCII white space
                if texts and total + len(words) > chunk:
                    yield judged(batch, low, texts)
                    low, texts, total = low + len(texts), [], 0
                texts.append(words)
                total += len(words)
            if texts:
                yield judged(batch, low, texts)

    return find


def collapse(
    docs: DataFrame, text: str = "text", least: int = LEAST, times: int = TIMES,
    chunk: int = CHUNK,
) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (by start, then period), ``top`` (the run with the
    greatest exponent) and ``collapsed`` (the words that stay, joined by one blank)."""
    others = [c for c in docs.columns if c not in (*RESULTS, "_text")]
    rows = docs.select(*others, F.col(text).alias("_text"))
    kept = [f for f in rows.schema.fields if f.name != "_text"]
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
        + [f"{name} {kind}" for name, kind in RESULTS.items()]
    )
    return rows.mapInArrow(_find(least, times, chunk), re.sub(r"\s+", " ", schema))
