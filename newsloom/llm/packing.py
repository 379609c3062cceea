"""Pack documents into token sequences by cutting stock with column generation.

A document's ids end with an end mark. It is cut into full sequences, one body of whole
units (64 ids) and a tail shorter than a unit. The bodies are the items of a cutting-stock
problem over a histogram of at most 63 lengths: a linear program over patterns (which lengths
share a sequence) whose columns a knapsack dynamic program prices. The rounded patterns are
assigned to the bodies ranked within their length. Tails are laid end to end into the room
that patterns leave, then into sequences of their own, cut where one is full; what is left
at the end fills sequences whose lengths are powers of two.

Lengths, patterns and rooms are what the driver holds: sizes that depend on the sequence
length only. Documents are tokenised once; each piece carries the checksum of its ids, and a
tail its ids, until it has its place. Ranks are running sums over ranges, so one length may
hold all rows. The order of documents is that of the staged rows.

Nulls and empty texts give the end mark alone; a null id stays null. Repeated rows are packed
each for itself. Other columns are ignored. An empty table gives no pieces.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain, pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import running_sums, stage

SEQUENCE = 4096
UNIT = 64
END = 2
CACHE = 500_000
TEXTS = 500
#: A word of letters of Latin-1 and marks after it that are a piece of their own. Quotes, which
#: begin endings like 's, and the signs of special tokens are no such marks.
PLAIN = re.compile('([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([.,;:!?#$%&*()"]*)')
#: Plain words that are encoded as one text.
TOGETHER = 200
#: Ends the last token of a piece.
SUFFIX = "</w>"


class Encoder:
    """Ids of texts as little-endian 32-bit numbers, word by word: the tokenizer never joins
    what white space parts and does not tell cases apart, so the ids of a word are the same
    wherever it stands. Words are kept in two generations of bounded size; those in use move
    to the younger one, the older one goes when that is full. New words are encoded without
    the marks after them, and many as one text if the tokenizer marks where words end."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith(SUFFIX)]] = True

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        split = [_plain(text or "").replace("\n", " ").split(" ") for text in texts]
        if len(self.known) > CACHE:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        missing = set().union(*split).difference(known)
        again = missing.intersection(older)
        known.update((word, older[word]) for word in again)
        self._learn(missing.difference(again))
        return [b"".join([known[w] for w in words]) for words in split]

    def _learn(self, words: set[str]) -> None:
        """Put the ids of words that are not known there."""
        known = self.known
        marked, stems, others = [], set(), set()
        for word in words:
            parts = PLAIN.fullmatch(word)
            if not parts:
                others.add(word)
            elif parts[2]:
                marked.append((word, parts[1], parts[2]))
                stems.add(parts[1])
                others.add(parts[2])
            else:
                stems.add(word)
        # difference asks the words that are known for each new one; difference_update goes
        # through all that are known
        known.update(self._together(list(stems.difference(known))))
        known.update(self._apart(list(others.difference(known))))
        known.update((word, known[stem] + known[marks]) for word, stem, marks in marked)

    def _apart(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(ids), dtype="<u4").tobytes()
        ends = accumulate([4 * len(i) for i in ids], initial=0)
        return zip(words, (flat[a:b] for a, b in pairwise(ends)), strict=True)

    def _together(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """The same for plain words, ``TOGETHER`` of them as one text."""
        texts = [" ".join(words[at : at + TOGETHER]) for at in range(0, len(words), TOGETHER)]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable([e.ids for e in found]), dtype="<u4")
        ends = 4 * (np.flatnonzero(self.last[ids]) + 1)
        if len(ends) != len(words) or (len(ends) and ends[-1] != 4 * len(ids)):
            return self._apart(words)  # this tokenizer has other pieces
        flat = ids.tobytes()
        return zip(words, (flat[a:b] for a, b in pairwise([0, *ends.tolist()])), strict=True)


def _plain(text: str) -> str:
    """Lower case where that is the same letter by letter in all libraries (Latin-1)."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process, kept for its next tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "units int, tail binary"
)


def _cut(path: str, end: int, sequence: int, unit: int):
    """Pieces of each document: full ones and the body with their units, the tail with 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, mark = encoder(path), np.array([end], dtype="<u4").tobytes()
        schema = pa.schema([
            ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
            ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("units", pa.int32()),
            ("tail", pa.binary()),
        ])
        parts = (b.slice(at, TEXTS) for b in batches for at in range(0, b.num_rows, TEXTS))
        for batch in parts:
            rows = []
            coded = encode(batch["text"].to_pylist())
            for doc, ids in zip(batch["doc_id"].to_pylist(), coded, strict=True):
                ids += mark
                count = len(ids) // 4
                body = count - count % unit
                for start in range(0, body, sequence):
                    stop = min(body, start + sequence)
                    crc = zlib.crc32(memoryview(ids)[4 * start : 4 * stop])
                    rows.append((doc, start, stop - start, crc, count, (stop - start) // unit, None))
                if body < count:
                    rows.append((doc, body, count - body, None, count, 0, ids[4 * body :]))
            columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema
            )

    return run


class Pattern(NamedTuple):
    counts: dict[int, int]  # how many bodies of each length in units
    copies: int


def knapsack(values: np.ndarray, lengths: list[int], room: int) -> np.ndarray:
    """How often to take each length so that the values sum highest within ``room``."""
    best, chosen = np.zeros(room + 1), np.full(room + 1, -1)
    for at in range(1, room + 1):
        best[at], chosen[at] = best[at - 1], -1
        for i, length in enumerate(lengths):
            if length <= at and best[at - length] + values[i] > best[at] + 1e-12:
                best[at], chosen[at] = best[at - length] + values[i], i
    counts, at = np.zeros(len(lengths)), room
    while at > 0:
        if chosen[at] < 0:
            at -= 1
        else:
            counts[chosen[at]] += 1
            at -= lengths[chosen[at]]
    return counts


def cutting_stock(demand: dict[int, int], room: int) -> list[Pattern]:
    """Patterns that cover ``demand`` (length in units: count) with few sequences."""
    lengths = sorted(n for n, count in demand.items() if count > 0)
    if not lengths:
        return []
    wanted = np.array([demand[n] for n in lengths], dtype=float)
    basis = np.diag([float(room // n) for n in lengths])  # columns are patterns
    for _ in range(100 * len(lengths)):
        prices = np.linalg.solve(basis.T, np.ones(len(lengths)))
        column = knapsack(prices, lengths, room)
        if prices @ column <= 1 + 1e-9:
            break
        amounts = np.linalg.solve(basis, wanted)
        rates = np.linalg.solve(basis, column)
        ratios = np.where(rates > 1e-9, amounts / np.where(rates > 1e-9, rates, 1), np.inf)
        basis[:, int(np.argmin(ratios))] = column
    amounts = np.linalg.solve(basis, wanted)
    left = {n: int(c) for n, c in zip(lengths, wanted, strict=True)}
    found: list[Pattern] = []

    def use(counts: dict[int, int], copies: int) -> None:
        if copies > 0 and counts:
            found.append(Pattern(counts, copies))
            for n, k in counts.items():
                left[n] -= k * copies

    for j in np.argsort(-amounts):
        counts = {n: int(k) for n, k in zip(lengths, basis[:, j], strict=True) if k > 0}
        most = min(left[n] // k for n, k in counts.items())
        use(counts, min(most, int(amounts[j] + 1e-6)))
    # less than one copy of each pattern is left: longest bodies first
    while any(left.values()):
        counts, free = {}, room
        for n in reversed(lengths):
            if k := min(left[n], free // n):
                counts[n], free = k, free - k * n
        use(counts, min(left[n] // k for n, k in counts.items()))
    return found


class Room(NamedTuple):
    """``count`` equal rooms for tails in successive sequences, from token ``low`` of the
    tails laid end to end: ``width`` ids from ``offset`` of sequence ``first`` on."""

    low: int
    width: int
    count: int
    first: int
    offset: int


def plan(demand: dict[int, int], tails: int, sequence: int, unit: int):
    """Slots of the bodies by units, and rooms for ``tails`` ids."""
    slots: dict[int, list[tuple[int, int, int, int, int]]] = {}
    used = dict.fromkeys(demand, 0)
    rooms: list[Room] = []
    first = low = 0
    for pattern in cutting_stock(demand, sequence // unit):
        offset = 0
        for units, count in sorted(pattern.counts.items(), reverse=True):
            # ranks from, to; bodies per sequence; first sequence; first offset
            upto = used[units] + count * pattern.copies
            slots.setdefault(units, []).append((used[units], upto, count, first, offset))
            used[units] = upto
            offset += count * units * unit
        if offset < sequence:
            rooms.append(Room(low, sequence - offset, pattern.copies, first, offset))
            low += (sequence - offset) * pattern.copies
        first += pattern.copies
    if tails > low:
        full, rest = divmod(tails - low, sequence)
        if full:
            rooms.append(Room(low, sequence, full, first, 0))
            low, first = low + sequence * full, first + full
        for bit in reversed(range(rest.bit_length())):
            if rest >> bit & 1:
                rooms.append(Room(low, 1 << bit, 1, first, 0))
                low, first = low + (1 << bit), first + 1
    return slots, rooms


PLACED = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def _place_tails(rooms: list[Room]):
    lows = np.array([r.low for r in rooms], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                at, done = row["before"], 0
                while done < row["length"]:
                    room = rooms[int(np.searchsorted(lows, at, side="right")) - 1]
                    copy, inside = divmod(at - room.low, room.width)
                    size = min(row["length"] - done, room.width - inside)
                    crc = zlib.crc32(row["tail"][4 * done : 4 * (done + size)])
                    rows.append((
                        row["doc_id"], row["start"] + done, size, crc, row["doc_tokens"],
                        room.first + copy, room.offset + inside,
                    ))
                    at, done = at + size, done + size
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return run


def pack(
    docs: DataFrame, tokenizer: str, end: int = END, sequence: int = SEQUENCE, unit: int = UNIT
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of each piece.

    ``tokenizer`` is a file of the tokenizers library that every executor has."""
    spark = docs.sparkSession
    pieces = stage(
        docs.select("doc_id", "text").mapInArrow(_cut(tokenizer, end, sequence, unit), PIECES),
        "pieces",
    )
    counted = pieces.groupBy("units").agg(F.count("*"), F.sum("length")).collect()
    demand = {units: count for units, count, _ in counted if units}
    tails = sum(total for units, _, total in counted if not units)
    slots, rooms = plan(demand, tails, sequence, unit)

    # the staged rows lie still, so their number is the same in a repeated task
    numbered = pieces.withColumns({"row": F.monotonically_increasing_id(), "one": F.lit(1)})
    names = "doc_id", "start", "length", "ids_crc32", "doc_tokens"
    bodies = running_sums(
        numbered.where("units > 0").select(*names, "units", "row", "one"),
        ["units"], ["row"], {"rank": "one"},
    )
    table = spark.createDataFrame(
        [(units, [dict(zip(("low", "high", "each", "first", "base"), s, strict=True)) for s in own])
         for units, own in slots.items()],
        "units int, slots array<struct<low:bigint, high:bigint, each:bigint, first:bigint, "
        "base:bigint>>",
    )
    slot = F.filter("slots", lambda s: (s["low"] <= F.col("rank")) & (F.col("rank") < s["high"]))
    place = F.col("rank") - F.col("slot.low")
    # at most sequence / unit rows of at most as many patterns
    placed = (
        bodies.join(F.broadcast(table), "units").withColumn("slot", F.get(slot, F.lit(0)))
        .select(
            *names,
            (F.col("slot.first") + F.floor(place / F.col("slot.each"))).alias("sequence_id"),
            (F.col("slot.base") + place % F.col("slot.each") * F.col("length")).alias("offset"),
        )
    )
    if not rooms:
        return placed
    laid = running_sums(
        numbered.where("units = 0").drop("units", "one", "ids_crc32"), [], ["row"],
        {"before": "length"},
    )
    return placed.unionByName(laid.mapInArrow(_place_tails(rooms), PLACED))
