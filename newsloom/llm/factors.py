"""Remove passages that occur before, by longest previous factors (LPF) in suffix order.

A text is its UTF-8 bytes. All strings of ``length`` bytes (windows) are judged: in suffix
order, the previous smaller position of a window tells whether the same bytes occur earlier,
the next smaller one whether they occur later. Bytes under a window that occurs earlier go
(``keep_first``), or bytes under any that occurs elsewhere.

The suffix order is made in parts that Spark deals out. Of the grams in a window (32 bytes of
200) the one with the smallest hash is its anchor. That depends on the window's bytes alone,
so equal windows have equal anchors and a window needs to be sorted only among those with its
anchor. Windows that follow each other mostly share one: such a segment, about 85 windows, is
one narrow row. An anchor that occurs once ends there. Equal segments are counted as one;
only where an anchor has several different segments, their bytes are fetched, once each, and
their windows are ranked by their first 8, 16, 32 bytes and so on up to ``length``. Among
equal windows, in order of position, the one before is the previous smaller position. Ranges
of windows go back to the texts, which are cut. (Grams whose hash is zero in its low bits come
first, so few places have to be compared for the smallest.)

Anchors with more than ``MEET`` different segments (a passage with many surroundings) do not
meet in one task: their windows are counted by hash, 64 bits beside the 64 of the anchor.

Matches do not cross documents. Positions count by document, then place; documents by
``doc_id``, null last, then by a hash of the text. Rows with the same id and text are one
document with ``keep_first`` and come back alike; else every row counts, so copies remove each
other. Null texts are empty; texts shorter than ``length`` stay whole. An empty table gives an
empty one. Other columns pass through; those named like a result (``RESULTS``) are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import drop, stage
from newsloom.session import shuffle_partitions

LENGTH = 200
GRAM = 32
#: Bytes of a text, or of segments, that are worked on at a time.
BLOCK = 1 << 18
#: Low bits that are zero in the hashes which count first as anchors.
SPARSE = 15
#: Rows handed to Spark at a time.
ROWS = 20_000
#: Different segments of an anchor that meet in one task.
MEET = 2000

RESULTS = {
    "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept": "binary",
}
#: A text: its place in the order of documents and two hashes.
OWN = ("ord", "k1", "k2")

_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(11).integers(0, 2**64, 256, dtype=np.uint64, endpoint=False)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _rolled(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` bytes, put together from those of halves, quarters, ..."""
    doubled = _BYTES[data]
    found, done, width = None, 0, 1
    while True:
        if size & width:
            if found is None:
                found = doubled
            else:
                shift = np.uint64(pow(_BASE, width, 2**64))
                least = min(len(found), len(doubled) - done)
                found = found[:least] * shift + doubled[done : done + least]
            done += width
        if 2 * width > size:
            return _mix(found[: len(data) - size + 1])
        shift = np.uint64(pow(_BASE, width, 2**64))
        doubled = doubled[:-width] * shift + doubled[width:]
        width *= 2


def _dense(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``at, start, count``: the smallest of each ``window`` hashes, of equals the first, and
    the run of windows that have it."""
    least, at = hashes, np.arange(len(hashes))
    width = 1
    while width < window:
        step = min(width, window - width)
        right = least[step:] < least[:-step]
        least = np.where(right, least[step:], least[:-step])
        at = np.where(right, at[step:], at[:-step])
        width += step
    start = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
    return at[start], start, np.diff(np.append(start, len(at)))


def _nearest(at: np.ndarray, value: np.ndarray, window: int, step: int) -> np.ndarray:
    """For each place the nearest one before it (``step`` -1) whose value is not greater, or
    after it (1) whose value is smaller, if that is less than ``window`` away; else -1."""
    found = np.full(len(at), -1)
    rows, k = np.arange(len(at)), step
    while len(rows):
        other = rows + k
        inside = (other >= 0) & (other < len(at))
        rows, other = rows[inside], other[inside]
        near = np.abs(at[other] - at[rows]) < window
        rows, other = rows[near], other[near]
        hit = value[other] <= value[rows] if step < 0 else value[other] < value[rows]
        found[rows[hit]] = other[hit]
        rows, k = rows[~hit], k + step
    return found


def _smallest(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same, where only hashes that are zero in some low bits count, one in
    ``SPARSE + 1``; windows without such a hash are left to ``_dense``."""
    last = len(hashes) - window
    at = np.flatnonzero((hashes & np.uint64(SPARSE)) == 0)
    value = hashes[at]
    start, stop = np.maximum(at - window + 1, 0), np.minimum(at, last)
    before, after = _nearest(at, value, window, -1), _nearest(at, value, window, 1)
    met = before >= 0
    start[met] = np.maximum(start[met], at[before[met]] + 1)
    met = after >= 0
    stop[met] = np.minimum(stop[met], at[after[met]] - window)
    kept = start <= stop
    found = [(at[kept], start[kept], (stop - start + 1)[kept])]
    edges = np.concatenate([[-1], at, [len(hashes)]])
    for k in np.flatnonzero(np.diff(edges) > window):
        low, high = edges[k] + 1, edges[k + 1]
        places, first, count = _dense(hashes[low:high], window)
        found.append((places + low, first + low, count))
    places, first, count = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.argsort(first) if len(found) > 1 else slice(None)
    return places[order], first[order], count[order]


def _blocks(texts: list[bytes], length: int, block: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """``text, place, piece`` in lists of about ``block`` bytes: whole texts, or pieces of a
    long one that overlap by one window less a byte."""
    held, size = [], 0
    for i, data in enumerate(texts):
        for low in range(0, len(data) - length + 1, block):
            piece = data[low : low + block + length - 1]
            held.append((i, low, piece))
            size += len(piece)
            if size >= block:
                yield held
                held, size = [], 0
    if held:
        yield held


def anchors(
    texts: list[bytes], length: int = LENGTH, gram: int = GRAM, block: int = BLOCK
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]]:
    """``text, hash, start, count, bytes`` of the segments of texts: the text's number, the
    anchor, its first window, their number, and all bytes of these windows."""
    for held in _blocks(texts, length, block):
        whole = b"".join(piece for _, _, piece in held)
        sizes = np.array([len(piece) for _, _, piece in held])
        first = np.cumsum(sizes) - sizes
        hashes = _rolled(np.frombuffer(whole, dtype=np.uint8), gram)
        at, start, count = _smallest(hashes, length - gram + 1)
        # windows that lie in one piece
        own = np.searchsorted(first, at, side="right") - 1
        stop = np.minimum(start + count, (first + sizes - length + 1)[own])
        start = np.maximum(start, first[own])
        kept = start < stop
        at, start, stop, own = at[kept], start[kept], stop[kept], own[kept]
        text, low = (np.array(c, dtype=np.int64) for c in list(zip(*held, strict=True))[:2])
        ends = (stop + length - 1).tolist()
        data = [whole[a:b] for a, b in zip(start.tolist(), ends, strict=True)]
        places = start - first[own] + low[own]
        yield text[own], hashes[at].view(np.int64), places, stop - start, data


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [text.encode() for text in batch["text"].to_pylist()]


def _anchor_hashes(length: int, gram: int):
    """The anchors alone, for counting them."""

    def found(batch: pa.RecordBatch) -> Iterator[list[np.ndarray]]:
        for _, hashes, *_ in anchors(_texts(batch), length, gram):
            yield [hashes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                yield from _gathered(found(batch), ["anchor"])

    return run


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _segments(length: int, gram: int):
    names = [*OWN, "anchor", "segment", "start", "count"]

    def found(batch: pa.RecordBatch) -> Iterator[list[np.ndarray]]:
        own = [batch[c].to_numpy(zero_copy_only=False) for c in OWN]
        for text, hashes, start, count, data in anchors(_texts(batch), length, gram):
            digests = [_signed(xxhash.xxh3_64_intdigest(d)) for d in data]
            same = [c[text] for c in own]
            yield [
                *same, hashes, np.array(digests, dtype=np.int64), start, count.astype(np.int32),
            ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                yield from _gathered(found(batch), names)

    return run


def _gathered(parts: Iterator[list[np.ndarray]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches of at least ``ROWS`` rows out of small columns."""
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        columns = [pa.array(np.concatenate(c)) for c in zip(*held, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names)

    for part in parts:
        held.append(part)
        size += len(part[-1])
        if size >= ROWS:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def ranks(data: np.ndarray, length: int) -> np.ndarray:
    """The place of the ``length`` bytes at each position in the order of all of them; equal
    strings have equal places. What lies beyond the end counts as zero."""
    first = min(8, length)
    padded = np.concatenate([data, np.zeros(length + 8, dtype=np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    words = np.ascontiguousarray(words).view(">u8")[:, 0].astype(np.uint64)
    if first < 8:
        words >>= np.uint64(8 * (8 - first))
    place = np.unique(words, return_inverse=True)[1].astype(np.int64)
    size = first
    while size < length:
        step = min(size, length - size)
        pairs = place[:-step] * (place.max() + 1) + place[step:]
        place = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        size += step
    return place[: len(data)]


def occurs(segments: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """For all windows of the segments, one after the other: do the same bytes occur in an
    earlier window (LPF of at least ``length``), and in a later one?"""
    sizes = np.array([len(s) for s in segments])
    first = np.cumsum(sizes) - sizes
    count = sizes - length + 1
    at = np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)
    place = ranks(np.frombuffer(b"".join(segments), dtype=np.uint8), length)[at]
    order = np.argsort(place, kind="stable")  # equal windows by position
    same = place[order][1:] == place[order][:-1]
    earlier, later = np.zeros(len(at), dtype=bool), np.zeros(len(at), dtype=bool)
    earlier[order[1:]] = same
    later[order[:-1]] = same
    return earlier, later


def _spans(rows: list[dict], length: int, keep_first: bool) -> pa.RecordBatch:
    """Ranges of bytes under the windows that go, of segments that all have their anchors'
    other segments among ``rows``."""
    rows.sort(key=lambda r: (r["ord"], r["k1"], r["k2"], r["start"]))
    earlier, later = occurs([r["data"] for r in rows], length)
    gone = earlier if keep_first else earlier | later
    found, base = [], 0
    for r in rows:
        count = r["count"]
        flags = gone[base : base + count]
        base += count
        if (r["n"] > 1 and not keep_first) or not flags.any():
            continue  # a segment that occurs again goes as a whole, or nothing does
        edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]])))
        for a, b in edges.reshape(-1, 2).tolist():
            found.append((*(r[c] for c in OWN), r["start"] + a, r["start"] + b + length - 1))
    columns = list(zip(*found, strict=True)) or [()] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], [*OWN, "start", "stop"]
    )


def _meet(length: int, keep_first: bool):
    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
        held = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["anchor"] != held[0]["anchor"]:
                    yield held
                    held = []
                held.append(row)
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for group in groups(batches):
            if not keep_first and all(row["n"] > 1 for row in group):
                continue  # all of these go as a whole
            held += group
            size += sum(len(row["data"]) for row in group)
            if size > BLOCK:
                yield _spans(held, length, keep_first)
                held, size = [], 0
        if held:
            yield _spans(held, length, keep_first)

    return run


def _windows(length: int):
    names = [*OWN, "anchor", "window", "start"]

    def found(batch: pa.RecordBatch) -> Iterator[list[np.ndarray]]:
        for row in batch.to_pylist():
            hashes = _rolled(np.frombuffer(row["data"], dtype=np.uint8), length)
            same = [np.full(len(hashes), row[c]) for c in (*OWN, "anchor")]
            yield [*same, hashes.view(np.int64), row["start"] + np.arange(len(hashes))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                yield from _gathered(found(batch), names)

    return run


def _fetch(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the segments that are asked of each text."""
    schema = pa.schema([
        *((c, pa.int64()) for c in (*OWN, "anchor", "start")), ("count", pa.int32()),
        ("n", pa.int64()), ("many", pa.bool_()), ("data", pa.binary()),
    ])
    for batch in batches:
        own = [batch[c] for c in OWN]
        rows, size = [], 0
        for i, (text, asked) in enumerate(zip(batch["text"], batch["asked"], strict=True)):
            data = text.as_py().encode()
            same = [c[i].as_py() for c in own]
            for a in asked.as_py():
                cut = data[a["start"] : a["start"] + a["count"] + length - 1]
                rows.append((*same, a["anchor"], a["start"], a["count"], a["n"], a["many"], cut))
                size += len(cut)
            if size > BLOCK:
                yield _batch(rows, schema)
                rows, size = [], 0
        if rows:
            yield _batch(rows, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _own(keep_first: bool) -> dict[str, Column]:
    """The columns of ``OWN``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    order = F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1)) if keep_first else F.lit(0)
    # the first argument seeds the hash of the second
    values = (order.cast("bigint"), F.xxhash64(text), F.xxhash64(F.lit(2), text))
    return dict(zip(OWN, values, strict=True))


def spans(
    docs: DataFrame, length: int = LENGTH, keep_first: bool = True, gram: int = GRAM,
    meet: int = MEET,
) -> DataFrame:
    """``ord, k1, k2, spans``: per text that loses bytes the ranges ``start, stop``, which may
    overlap. ``docs`` is read three times: stage it if it is costly."""
    own = list(OWN)
    texts = (
        docs.withColumns(_own(keep_first)).select(*own, "text")
        .where(F.octet_length("text") >= length)
    )
    if keep_first:  # rows of one document are one text
        texts = texts.dropDuplicates(own)
    found = texts.mapInArrow(
        _segments(length, gram),
        "ord bigint, k1 bigint, k2 bigint, anchor bigint, segment bigint, start bigint, count int",
    )
    # anchors that occur once are most of them
    hashes = texts.select("text").mapInArrow(_anchor_hashes(length, gram), "anchor bigint")
    again = stage(
        hashes.groupBy("anchor").agg(F.count("*").alias("_n")).where("_n > 1").select("anchor"),
        "anchors",
    )
    # a segment has one anchor; grouping by that too would keep hot anchors together
    members = stage(
        found.join(again, "anchor", "left_semi")
        .groupBy("segment", *own, "start", "count")
        .agg(F.first("anchor").alias("anchor"), F.count("*").alias("m")),
        "segments",
    )
    place = F.struct(*own, "start")
    distinct = stage(
        members.groupBy("anchor", "segment", "count")
        .agg(F.sum("m").alias("n"), F.min(place).alias("first")),
        "distinct",
    )
    drop(again)
    # segments that occur more than once go as a whole, but for the first
    repeated = distinct.where("n > 1").select("anchor", "segment", "count", "first")
    whole = (
        members.join(repeated, ["anchor", "segment", "count"])
        .where(place != F.col("first") if keep_first else F.lit(True))
        .select(*own, "start", (F.col("start") + F.col("count") + (length - 1)).alias("stop"))
    )
    # anchors with several segments: their windows are compared
    kinds = distinct.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    mixed = distinct.join(kinds, "anchor").select(
        "anchor", "count", "n", "first.*", (F.col("kinds") > meet).alias("many")
    )
    asked = mixed.groupBy(*own).agg(
        F.collect_list(F.struct("anchor", "start", "count", "n", "many")).alias("asked")
    )
    once = texts.groupBy(*own).agg(F.first("text").alias("text"))
    fetched = stage(
        once.join(asked, own).mapInArrow(
            lambda batches: _fetch(batches, length),
            "ord bigint, k1 bigint, k2 bigint, anchor bigint, start bigint, count int, n bigint, "
            "many boolean, data binary",
        ),
        "bytes",
    )
    parts = shuffle_partitions(docs.sparkSession)
    few = (
        fetched.where("NOT many").repartition(parts, "anchor").sortWithinPartitions("anchor")
        .mapInArrow(
            _meet(length, keep_first),
            "ord bigint, k1 bigint, k2 bigint, start bigint, stop bigint",
        )
    )
    windows = fetched.where("many").mapInArrow(
        _windows(length),
        "ord bigint, k1 bigint, k2 bigint, anchor bigint, window bigint, start bigint",
    )
    common = (
        windows.groupBy("anchor", "window")
        .agg(F.count("*").alias("_n"), F.min(place).alias("first")).where("_n > 1")
    )
    many = (
        windows.join(common, ["anchor", "window"])
        .where(place != F.col("first") if keep_first else F.lit(True))
        .select(*own, "start", (F.col("start") + length).alias("stop"))
    )
    gone = whole.unionByName(few).unionByName(many).distinct()
    result = stage(
        gone.groupBy(*own).agg(F.collect_list(F.struct("start", "stop")).alias("spans")), "spans"
    )
    for table in (members, distinct, fetched):
        drop(table)
    return result


def cut(data: bytes, ranges: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left of ``data`` without the ranges, the bytes that go, and the number of
    maximal ranges."""
    kept, at, removed, count = [], 0, 0, 0
    end = -1
    for start, stop in sorted(ranges):
        if start > end:
            kept.append(data[max(at, 0) : start])
            count += 1
            removed += stop - start
            end = stop
        elif stop > end:
            removed += stop - end
            end = stop
        at = end
    kept.append(data[at:])
    return b"".join(kept), removed, count


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        others = [c for c in batch.schema.names if c != "_spans"]
        sizes, removed, counts, kept = [], [], [], []
        for text, found in zip(batch["text"], batch["_spans"], strict=True):
            data = (text.as_py() or "").encode()
            ranges = [(r["start"], r["stop"]) for r in found.as_py() or ()]
            rest, lost, number = cut(data, ranges)
            sizes.append(len(data))
            removed.append(lost)
            counts.append(number)
            kept.append(rest)
        yield pa.RecordBatch.from_arrays(
            [
                *(batch[c] for c in others), pa.array(sizes, pa.int64()),
                pa.array(removed, pa.int64()), pa.array(counts, pa.int64()),
                pa.array(kept, pa.binary()),
            ],
            [*others, *RESULTS],
        )


def dedup(
    docs: DataFrame, length: int = LENGTH, keep_first: bool = True, gram: int = GRAM,
    meet: int = MEET,
) -> DataFrame:
    """``docs`` (doc_id, text and any others) with ``n_bytes``, ``n_removed``, ``n_spans``
    (maximal runs that go) and ``kept``, the bytes that stay."""
    hidden = [f"_{c}" for c in (*OWN, "spans")]
    others = [c for c in docs.columns if c not in RESULTS and c not in hidden]
    found = spans(docs.select("doc_id", "text"), length, keep_first, gram, meet).toDF(*hidden)
    keyed = docs.select(*others).withColumns({f"_{c}": v for c, v in _own(keep_first).items()})
    joined = keyed.join(found, hidden[:-1], "left").select(*others, "_spans")
    kinds = {f.name: f.dataType.simpleString() for f in joined.schema.fields}
    schema = ", ".join(
        [f"`{c}` {kinds[c]}" for c in others] + [f"{c} {kind}" for c, kind in RESULTS.items()]
    )
    return joined.mapInArrow(_cut, schema)
