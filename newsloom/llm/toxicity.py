"""Toxicity by a support vector machine over a gapped subsequence kernel.

Two words are as similar as the character subsequences of length 3 they share, each weighed
by ``DECAY`` to the power of the stretch it spans (Lodhi et al. 2002), so letters inserted
into an insult or left out lower the kernel a little and no more. The ends of a word are
characters too. Two sentences are as similar as their words: the sum of the word kernels to a
high power, so that chance resemblance counts for nothing. The Nystroem features of a sentence are its kernel values with
landmarks times the inverse root of the landmarks' kernel matrix; a linear SVM is
trained on them.

Training takes labelled sentences of at most ``TRAIN_TOXIC`` and ``TRAIN_CLEAN`` documents of
at most ``TRAIN_CHARS`` characters (those with the smallest hashes). Landmarks are the words
and word beginnings whose document counts tell the labels apart best and that differ from
each other. A label
belongs to a document, so the training sentence of a toxic document is the one with the most
telling words, that of a clean one the one most like the landmarks. A document scores by its
three worst sentences, through a logistic curve fitted to the training documents.

Scoring covers every whole text and moves no rows; as the margin is linear in the kernels it
needs one number per distinct word, kept in a bounded cache.

Nulls and empty texts score as a sentence without words. Without labels of both kinds every
score is 0. Of several labels of a document the highest counts. Repeated rows score alike; a
null id stays null. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

TRAIN_TOXIC = 1500
TRAIN_CLEAN = 3000
TRAIN_CHARS = 8_000
LANDMARKS = 48
ORDER = 3
DECAY = 0.7
POWER = 4
#: Word kernels below this share of a landmark's own count as nothing.
LEAST = 0.5
#: Landmarks are less alike than this.
APART = 0.6
#: How telling a landmark is: standard deviations at least, and as a share of the best one.
TELLING, TELLING_SHARE = 2.5, 0.3
BEGIN, END, STEMS = "\x02", "\x03", (4, 5, 6)
WINDOW = 24
SENTENCE = 40
#: Sentences that a document is judged by.
WORST = 3
CACHE = 400_000

_BREAK = re.compile(r"[.!?]+\s|[\n\r]+")
_SPACED = re.compile(r"(?<!\S)(?:[^\W\d_][ ]){2,}[^\W\d_](?!\S)")
_INNER = re.compile(r"[\W_]+")


def sentences(text: str | None) -> list[list[str]]:
    """Words in lower case, without punctuation; spelled-out words are put together. Long
    sentences are cut into windows that cover them."""
    low = (text or "").lower()
    low = _SPACED.sub(lambda m: m.group().replace(" ", ""), low)
    found = []
    for part in _BREAK.split(low):
        words = [w for w in (_word(w) for w in part.split()) if w]
        found += [words[i : i + SENTENCE] for i in range(0, len(words), SENTENCE)]
    return found or [[]]


def _word(raw: str) -> str:
    return raw if raw.isalnum() else _INNER.sub("", raw)


def _codes(words: list[str], width: int) -> np.ndarray:
    padded = "".join(w.ljust(width, "\0") for w in words)
    return np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(
        len(words), width
    )


def kernel(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Subsequence kernel of each row of ``one`` with the same row of ``two`` (padded codes)."""
    rows, m, n = len(one), one.shape[1], two.shape[1]
    same = [[(one[:, a] == two[:, b]) & (one[:, a] > 0) for b in range(n)] for a in range(m)]
    # before[a][b]: weight of the common subsequences so far, up to a and b
    before = np.ones((m + 1, n + 1, rows), dtype=np.float32)
    square = np.float32(DECAY * DECAY)
    for _ in range(ORDER - 1):
        after = np.zeros_like(before)
        for a in range(1, m + 1):
            line = np.zeros(rows, dtype=np.float32)
            for b in range(1, n + 1):
                line = DECAY * line + square * (before[a - 1, b - 1] * same[a - 1][b - 1])
                after[a, b] = DECAY * after[a - 1, b] + line
        before = after
    total = np.zeros(rows, dtype=np.float32)
    for a in range(m):
        for b in range(n):
            total += square * (before[a, b] * same[a][b])
    return total


def _pieces(word: str) -> list[str]:
    marked = BEGIN + word + END
    if len(marked) <= WINDOW:
        return [marked]
    return [marked[i : i + WINDOW] for i in range(0, len(marked) - WINDOW // 2, WINDOW // 2)]


def _letters(word: str) -> int:
    return sum(1 << bit for bit in {ord(c) % 61 for c in word if c not in (BEGIN, END)})


def _keys(word: str) -> list[str]:
    """The word and its beginnings, as landmarks are written."""
    return [BEGIN + word + END, *(BEGIN + word[:n] for n in STEMS if n < len(word))]


class Likeness:
    """Powers of the kernels of words with the landmarks, as shares of the landmarks' own.
    Words are given plain, landmarks with their marks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self.width = max(map(len, landmarks))
        self.codes = _codes(landmarks, self.width)
        self.own = kernel(self.codes, self.codes)
        self.masks = np.array([_letters(w) for w in landmarks], dtype=np.uint64)
        # a word that lacks more of the letters is unlike the landmark
        self.least = np.ceil(0.7 * np.bitwise_count(self.masks)).astype(np.int64)

    def __call__(self, words: list[str]) -> np.ndarray:
        values = np.zeros((len(words), len(self.landmarks)), dtype=np.float32)
        parts, owner = [], []
        for i, word in enumerate(words):
            for piece in _pieces(word):
                parts.append(piece)
                owner.append(i)
        if not parts:
            return values
        masks = np.array([_letters(p) for p in parts], dtype=np.uint64)
        shared = np.bitwise_count(masks[:, None] & self.masks[None, :])
        at, landmark = np.nonzero(shared >= self.least[None, :])
        owners, lengths = np.array(owner), np.array([len(p) for p in parts])
        for low, high in ((0, 8), (8, 12), (12, 16), (16, WINDOW)):
            chosen = (lengths[at] > low) & (lengths[at] <= high)
            rows, cols = at[chosen], landmark[chosen]
            if not len(rows):
                continue
            used, place = np.unique(rows, return_inverse=True)
            codes = _codes([parts[i] for i in used], high)
            for start in range(0, len(used), 20_000):
                own = codes[start : start + 20_000]
                mine = (place >= start) & (place < start + 20_000)
                for k in range(0, int(mine.sum()), 20_000):
                    pick = np.flatnonzero(mine)[k : k + 20_000]
                    local = place[pick] - start
                    raw = kernel(own[local], self.codes[cols[pick]])
                    alike = np.minimum(raw / self.own[cols[pick]], 1.2)
                    alike = np.where(alike >= LEAST, alike, 0) ** POWER
                    np.maximum.at(values, (owners[rows[pick]], cols[pick]), alike)
        return values


def _worst(sums: list[float]) -> list[float]:
    """The three largest sums; 0, that of a sentence without telling words, where there are
    fewer sentences."""
    return heapq.nlargest(WORST, [*sums, *[0.0] * WORST])


@dataclass
class Model:
    """Landmarks with the weight of each, the offset, and the logistic curve."""

    landmarks: list[str]
    weights: np.ndarray
    slopes: np.ndarray
    shift: float
    likeness: Likeness | None = field(default=None, repr=False)
    known: dict[str, float] = field(default_factory=dict, repr=False)

    def margins(self, texts: list[str | None]) -> np.ndarray:
        """The three largest sentence margins of each text."""
        if self.likeness is None:
            self.likeness = Likeness(self.landmarks)
        split = [sentences(t) for t in texts]
        new = list({w for doc in split for s in doc for w in s}.difference(self.known))
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
            new = list({w for doc in split for s in doc for w in s})
        values = self.likeness(new) @ self.weights
        self.known.update(zip(new, values.tolist(), strict=True))
        known = self.known
        return np.array([_worst([sum([known[w] for w in s]) for s in doc]) for doc in split])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        exponent = np.clip(self.margins(texts) @ self.slopes + self.shift, -500, 500)
        return 1 / (1 + np.exp(-exponent))


def _telling(docs: list[tuple[int, list[list[str]]]]) -> dict[str, float]:
    """Words and beginnings by how far more toxic documents hold them than clean ones would
    suggest, in standard deviations."""
    toxic, clean = Counter(), Counter()
    for label, doc in sorted(docs, key=lambda d: -d[0]):
        words = {w for s in doc for w in s if len(w) >= ORDER}
        keys = {k for w in words for k in _keys(w)}
        if label:
            toxic.update(keys)
        else:
            clean.update([k for k in keys if k in toxic])
    count = sum(label for label, _ in docs)
    share = count / max(1, len(docs) - count)
    found = {}
    for key, n in toxic.items():
        usual = clean[key] * share
        if n > 3 * usual:
            found[key] = float((n - usual) / np.sqrt(n + usual))
    least = max([TELLING, *(TELLING_SHARE * z for z in found.values())])
    return {k: z for k, z in sorted(found.items(), key=lambda x: (-x[1], -len(x[0]), x[0]))
            if z >= least}


def _landmarks(telling: dict[str, float], most: int) -> list[str]:
    """The most telling keys that are unlike each other; of a word and its beginning the more
    telling one."""
    keys = [k for k in telling if len(k) <= WINDOW][: 8 * most]
    if not keys:
        return []
    every = Likeness(keys)
    count = len(keys)
    one, two = np.repeat(np.arange(count), count), np.tile(np.arange(count), count)
    shared = np.concatenate([
        kernel(every.codes[one[i : i + 20_000]], every.codes[two[i : i + 20_000]])
        for i in range(0, len(one), 20_000)
    ]).reshape(count, count)
    alike = shared / np.minimum(every.own[:, None], every.own[None, :])
    chosen: list[int] = []
    for i in range(count):
        if len(chosen) < most and not any(alike[i, j] >= APART for j in chosen):
            chosen.append(i)
    return [keys[i] for i in chosen]


def _machine(rows: np.ndarray, labels: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Weights of a linear SVM with squared hinge loss, both labels weighing the same in all;
    Newton steps on the rows inside the margin. The offset is left to the curve."""
    signs = 2 * labels - 1
    shares = np.where(labels > 0, 0.5 / max(1, (labels > 0).sum()), 0.5 / max(1, (labels == 0).sum()))
    full = np.hstack([rows, np.ones((len(rows), 1))])
    ridge = penalty * np.eye(full.shape[1]) / 10
    weights = np.zeros(full.shape[1])
    for _ in range(50):
        inside = signs * (full @ weights) < 1
        own, share = full[inside], shares[inside]
        after = np.linalg.solve(ridge + own.T @ (own * share[:, None]), own.T @ (signs[inside] * share))
        if np.allclose(after, weights, atol=1e-9):
            break
        weights = after
    return weights[:-1]


def _curve(margins: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Slopes and shift of a logistic regression, by Newton steps."""
    full = np.hstack([margins, np.ones((len(margins), 1))])
    weights, ridge = np.zeros(full.shape[1]), 1e-3 * np.eye(full.shape[1])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(full @ weights, -30, 30)))
        slope = full.T @ (labels - chance) - ridge @ weights
        curve = full.T @ (full * (chance * (1 - chance))[:, None]) + ridge
        step = np.linalg.solve(curve, slope)
        weights = weights + step * min(1.0, 5.0 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-8:
            break
    return weights[:-1], float(weights[-1])


def fit(
    toxic: list[str], clean: list[str], landmarks: int = LANDMARKS, odds: float | None = None
) -> Model | None:
    """The model from texts of both labels, or None if they cannot be told apart. ``odds`` are
    those of a toxic document where the texts come from, if they differ from the texts'."""
    docs = [(1, sentences(t)) for t in toxic] + [(0, sentences(t)) for t in clean]
    telling = _telling(docs)
    chosen = _landmarks(telling, landmarks)
    if not chosen or not clean:
        return None
    likeness = Likeness(chosen)
    vocabulary = sorted({w for _, doc in docs for s in doc for w in s})
    place = {w: i for i, w in enumerate(vocabulary)}
    values = likeness(vocabulary)
    strength = values.sum(axis=1)
    told = [max(telling.get(k, 0.0) for k in _keys(w)) for w in vocabulary]

    def vector(sentence: list[str]) -> np.ndarray:
        return values[np.array([place[w] for w in sentence], dtype=int)].sum(axis=0)

    count = len(chosen)
    one, two = np.repeat(np.arange(count), count), np.tile(np.arange(count), count)
    norm = np.sqrt(likeness.own[one] * likeness.own[two])
    matrix = kernel(likeness.codes[one], likeness.codes[two]) / norm
    matrix = matrix.reshape(count, count).astype(float) ** POWER
    eigen, axes = np.linalg.eigh(matrix)
    root = axes @ np.diag(1 / np.sqrt(np.maximum(eigen, 1e-3))) @ axes.T
    rows = []
    for label, doc in docs:
        if label:
            picked = sorted(doc, key=lambda s: -sum(told[place[w]] for w in s))[:1]
        else:
            picked = sorted(doc, key=lambda s: -sum(strength[place[w]] for w in s))[:2]
        rows += [(float(label), root @ vector(s)) for s in picked]
    labels = np.array([label for label, _ in rows])
    weights = root @ _machine(np.array([v for _, v in rows]), labels)
    # the logistic curve, on the worst sentences of each document; it takes in the offset
    word = (values @ weights).tolist()
    margins = np.array([
        _worst([float(sum(word[place[w]] for w in s)) for s in doc]) for _, doc in docs
    ])
    slopes, shift = _curve(margins, np.array([float(label) for label, _ in docs]))
    if odds is not None:
        shift += float(np.log(odds * len(clean) / len(toxic)))
    return Model(chosen, weights, slopes, shift)


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def train(
    docs: DataFrame, labels: DataFrame, toxic: int = TRAIN_TOXIC, clean: int = TRAIN_CLEAN
) -> Model | None:
    """Fit on labelled documents that are not held out."""
    marks = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .where(~held_out())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    short = docs.select("doc_id", "text").where(F.length("text") <= TRAIN_CHARS)
    order = F.xxhash64(F.col("doc_id"), F.lit("toxicity"))
    texts = []
    for label, most in ((1, toxic), (0, clean)):
        picked = marks.where(F.col("toxic") == label).orderBy(order, "doc_id").limit(most)
        # at most ``most`` ids; their documents are found without moving the texts
        rows = short.join(F.broadcast(picked.select("doc_id")), "doc_id").select("doc_id", "text")
        texts.append([r.text for r in sorted(rows.collect(), key=lambda r: (r.doc_id, r.text))])
    if not texts[0] or not texts[1]:
        return None
    # the samples are bounded per label, so their shares are not those of the table
    counts = {
        r.toxic: r.n for r in docs.select("doc_id").join(marks, "doc_id")
        .groupBy("toxic").agg(F.count("*").alias("n")).collect()
    }
    return fit(texts[0], texts[1], odds=counts[1] / counts[0])


def _score(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = part["text"].to_pylist()
                scores = np.zeros(len(texts)) if model is None else model.scores(texts)
                yield pa.RecordBatch.from_arrays(
                    [*(part[i] for i in range(part.num_columns)), pa.array(scores)],
                    [*part.schema.names, "score"],
                )

    return run


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` (with ``text``) and ``score``, ``predicted``."""
    own = docs.drop("score", "predicted")
    schema = StructType([*own.schema.fields, StructField("score", DoubleType())])
    scored = own.mapInArrow(_score(model), schema)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
