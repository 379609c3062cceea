"""Personal data by gradient boosting over candidate spans.

Strict patterns give the base spans, which always stay. Looser generators propose more spans
of the same kinds: spelled-out or spaced addresses, numbers with other separators, phone
numbers without a country code. They may overlap. Boosted trees (pyspark.ml) score each by
its format and its context, a threshold per kind is calibrated on rows the trees have not
seen, and of overlapping spans above it the best stays.

The trees learn from the corpus itself: strict spans and disguised copies of them (their
separators written in the ways the generators look for) are positive. Negative are only
proposals that are known to be wrong (digits or ranges that do not fit, dates, ends of
sentences) and decoys made of the words and numbers around strict spans: other proposals may
be what is looked for. Equal feature vectors are one row with their number as weight. All such
rows of the table are used, none is drawn: of each kind and label every fourth one, in the order
of a hash, is held out, the trees learn from the others. A task of the training takes about
``TASK_ROWS`` rows. (Where Spark's trees may split a feature is set by a seeded draw of its own;
which split is best is counted over all rows.)

Nulls and empty texts have no spans. Repeated rows come back as given, a null id stays null.
Other columns are ignored. Without both positive and negative rows nothing is added.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import running_sums, stage

KINDS = ("email", "ip", "card", "phone")
#: Distinct feature vectors that one task of the training takes.
TASK_ROWS = 20_000
#: Share of the added spans that must be right on the held-out rows.
PRECISION = 0.98
TREES = 12
DEPTH = 4

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# loose forms; the quantifiers are bounded or possessive, so each takes linear time
_AT = r"(?:\x20?(?:@|\(at\)|\[at\]|\{at\})\x20?|\x20at\x20)"
_DOT = r"(?:\x20?(?:\.|\(dot\)|\[dot\]|\{dot\})\x20?|\x20dot\x20)"
LOOSE = {
    "email": re.compile(rf"[A-Za-z0-9._%+-]{{1,64}}{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{2,63}}){{1,4}}"),
    "ip": re.compile(r"(?<![0-9])[0-9]{1,4}(?:(?:\x20?[.,:_]\x20?|\[\.\])[0-9]{1,4}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9]{3,6}(?:[\x20._/-]{1,2}[0-9]{2,7}){1,5}(?![0-9])|(?<![0-9])[0-9]{12,19}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9])(?:00|\+)?\x20?(?:\(?[0-9]{1,4}\)?[\x20./-]{1,2}){1,4}[0-9]{3,8}(?![0-9])"),
}
_CONTEXT = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "host", "server"),
    "card": ("card", "visa", "pay"), "phone": ("tel", "phone", "call", "mobil"),
}


def luhn(digits: str) -> bool:
    odd, even = digits[::-1][::2], digits[::-1][1::2]
    total = sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of the strict patterns, by kind, then start."""
    found = [(0, s, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                found.append((1, *m.span()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *m.span()))
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                found.append((3, *m.span()))
    return found


def loose_spans(text: str) -> list[tuple[int, int, int]]:
    """Proposals of the generators; they overlap each other and the strict spans."""
    found = []
    low = text.lower()
    if "@" in text or "(at)" in low or "[at]" in low or "{at}" in low or "dot" in low:
        found += [(0, *m.span()) for m in LOOSE["email"].finditer(text)]
    if _DIGIT.search(text):
        for kind in (1, 2, 3):
            found += [(kind, *m.span()) for m in LOOSE[KINDS[kind]].finditer(text)]
    return found


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format of the span and what stands around it. Whether the strict pattern fits is not
    among them, nor is the form of the separators that tells disguised copies apart."""
    span = text[start:end]
    groups = [len(g) for g in re.findall("[0-9]+", span)]
    digits = "".join(c for c in span if "0" <= c <= "9")
    before, after = text[max(0, start - 24) : start], text[end : end + 12]
    parts = re.findall("[0-9]+", span)
    words = re.findall("[A-Za-z0-9]+", span)
    return [
        float(kind),
        float(len(digits)),
        float(len(groups)),
        float(max(groups, default=0)),
        float(min(groups, default=0)),
        float(len(set(groups))),
        float(sum(c.isalpha() for c in span)),
        float(len(words)),
        float(len(words[-1]) if words else 0),
        float(13 <= len(digits) <= 19 and luhn(digits)),
        float(len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)),
        float("@" in span or "at" in span.lower()),
        float("." in span or "dot" in span.lower()),
        float("+" in text[max(0, start - 2) : start + 1] or span.startswith("00")),
        float("(" in span),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        float(before[-1:] in "=\"'#:/_-" if before else 0),
        float(any(w in before.lower() for w in _CONTEXT[KINDS[kind]])),
        float(sum(c.isalpha() or c.isspace() for c in before) / max(1, len(before))),
    ]


def disguise(text: str, kind: int, start: int, end: int) -> list[tuple[str, int, int]]:
    """Copies of a strict span with other separators, in the same place."""
    span = text[start:end]
    if kind == 0:
        local, _, domain = span.partition("@")
        forms = [f"{local} at {domain.replace('.', ' dot ')}", f"{local}(at){domain}"]
    elif kind == 1:
        forms = [span.replace(".", " . "), span.replace(".", "[.]")]
    elif kind == 2:
        digits = re.sub("[^0-9]", "", span)
        forms = [sep.join(digits[i : i + 4] for i in range(0, len(digits), 4)) for sep in "._/"]
    else:
        bare = span.lstrip("+")
        forms = ["00" + bare, bare.split(" ", 1)[-1]]
    around = text[max(0, start - 24) : start], text[end : end + 12]
    return [
        (around[0] + form + around[1], len(around[0]), len(around[0]) + len(form))
        for form in forms
    ]


_DATE = re.compile(r"(?:19|20)[0-9]{2}[-/. ][0-9]{1,2}[-/. ][0-9]{1,2}|[0-9]{1,2}[-/. ][0-9]{1,2}[-/. ](?:19|20)[0-9]{2}")


def wrong(kind: int, span: str) -> bool:
    """Is a proposal known not to be of its kind?"""
    digits = re.sub("[^0-9]", "", span)
    if kind == 0:
        # a name and the next sentence, or a last label that no domain has
        return bool(re.search(r" at [^@]*\. ", span)) or not re.search("[A-Za-z]{2}$", span)
    if kind == 1:
        return any(len(p) > 3 or int(p) > 255 for p in re.findall("[0-9]+", span))
    if kind == 2:
        return not (13 <= len(digits) <= 19 and luhn(digits))
    return not 9 <= len(digits) <= 15 or bool(_DATE.search(span))


def decoys(text: str, kind: int, start: int, end: int) -> list[tuple[str, int, int]]:
    """What only looks like the strict span, in another place of the same text."""
    digits = re.sub("[^0-9]", "", text[start:end])
    before = text[max(0, start - 24) : start]
    words = re.findall("[A-Za-z]{2,}", before) or ["this"]
    if kind == 0:
        made = [("", f"{words[0]} at {words[-1]}. {words[0]}")]
    elif kind == 1:
        parts = text[start:end].split(".")
        made = [("", ".".join([*parts[:3], str(256 + int(parts[3]))])), ("", ", ".join(["1999", *parts[1:]]))]
    elif kind == 2:
        other = digits[:-1] + str((int(digits[-1]) + 1) % 10)
        made = [("", " ".join(other[i : i + 4] for i in range(0, len(other), 4)))]
    else:
        day = f"20{digits[-2:]}-{int(digits[-4:-2]) % 12 + 1:02}-{int(digits[-3:]) % 28 + 1:02}"
        made = [("", f"{day} {digits[-4:]}"), ("order no. ", f"{digits[:4]}-{digits[4:]}"), ("id=", f"{digits[:3]}/{digits[3:]}")]
    # with and without the words that lead up to the strict span, which alone tell nothing
    return [
        (lead + sign + form + text[end : end + 12], len(lead + sign), len(lead + sign) + len(form))
        for lead in (" ".join(words[:2])[:16] + " ", before) for sign, form in made
    ]


_SPAN = "struct<kind:int, start:bigint, end:bigint, features:array<double>>"
_ROWS = (
    "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
    f"base array<struct<kind:int, start:bigint, end:bigint>>, proposed array<{_SPAN}>, "
    "positive array<array<double>>, negative array<array<double>>"
)
_BASE_TYPE = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
_SPAN_TYPE = pa.list_(pa.struct([
    ("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
    ("features", pa.list_(pa.float64())),
]))


def _propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, bases, proposals, positives, negatives = [[], [], [], []], [], [], [], []
        for cell in batch["text"]:
            text = cell.as_py() or ""
            base = base_spans(text)
            loose = loose_spans(text)
            taken = np.zeros(0, dtype=np.int64)
            if base and loose:
                taken = np.array(sorted((s, e) for _, s, e in base))
            more, shown, others = [], [], []
            for kind, start, end in loose:
                if len(taken) and bool(np.any((taken[:, 0] < end) & (start < taken[:, 1]))):
                    continue
                more.append({
                    "kind": kind, "start": start, "end": end,
                    "features": features(text, kind, start, end),
                })
                if wrong(kind, text[start:end]):
                    others.append(more[-1]["features"])
            for kind, start, end in base:
                shown.append(features(text, kind, start, end))
                for other, s, e in disguise(text, kind, start, end):
                    shown.append(features(other, kind, s, e))
                for other, s, e in decoys(text, kind, start, end):
                    others.append(features(other, kind, s, e))
            for kind in range(4):
                counts[kind].append(sum(k == kind for k, _, _ in base))
            bases.append([{"kind": k, "start": s, "end": e} for k, s, e in base])
            proposals.append(more)
            positives.append(shown)
            negatives.append(others)
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                *(pa.array(c, pa.int64()) for c in counts),
                pa.array(bases, _BASE_TYPE),
                pa.array(proposals, _SPAN_TYPE),
                pa.array(positives, pa.list_(pa.list_(pa.float64()))),
                pa.array(negatives, pa.list_(pa.list_(pa.float64()))),
            ],
            [
                "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "proposed", "positive",
                "negative",
            ],
        )


def _spans(base: pd.Series, added: pd.Series) -> list[str]:
    rows = []
    for strict, scored in zip(base, added, strict=True):
        spans = [(s["kind"], s["start"], s["end"]) for s in strict]
        taken: list[tuple[int, int]] = []
        for s in sorted(
            [] if scored is None else list(scored),
            key=lambda s: (-s["score"], s["start"], -s["end"], s["kind"]),
        ):
            if all(s["end"] <= low or high <= s["start"] for low, high in taken):
                taken.append((s["start"], s["end"]))
                spans.append((s["kind"], s["start"], s["end"]))
        rows.append(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans)))
    return rows


def _thresholds(scored: DataFrame) -> dict[int, float]:
    """Per kind the lowest score at which held-out rows above it are right often enough."""
    levels = scored.groupBy("kind", (-F.col("score")).alias("below")).agg(
        F.sum(F.col("label") * F.col("weight")).alias("right"), F.sum("weight").alias("all")
    )
    summed = running_sums(levels, ["kind"], ["below"], {"right_before": "right", "all_before": "all"})
    share = (F.col("right_before") + F.col("right")) / (F.col("all_before") + F.col("all"))
    found = summed.where(share >= PRECISION).groupBy("kind").agg(F.max("below").alias("below"))
    # a row per kind
    return {r["kind"]: max(0.5, -r["below"] - 1e-9) for r in found.collect()}


def train(proposed: DataFrame, task_rows: int = TASK_ROWS):
    """The trees and the thresholds, or None if there is nothing to tell apart."""
    examples = proposed.select(F.explode("positive").alias("features"), F.lit(1.0).alias("label"))
    others = proposed.select(F.explode("negative").alias("features"), F.lit(0.0).alias("label"))
    distinct = (
        examples.unionByName(others)
        .groupBy("label", "features").agg(F.count("*").cast("double").alias("weight"))
        .withColumn("kind", F.get("features", F.lit(0)).cast("int"))
        .withColumns({"drawn": F.xxhash64("features", F.lit("train")), "one": F.lit(1)})
    )
    # read twice, for the ranges and by them
    ranked = running_sums(
        stage(distinct, "pii-vectors"), ["kind", "label"], ["drawn", "features"], {"before": "one"}
    )
    rows = stage(
        ranked.select(
            "label", "kind", "weight", array_to_vector("features").alias("vector"),
            (F.col("before") % 4 == 1).alias("held_out"),
        ),
        "pii-rows",
    )
    fitted = rows.where("NOT held_out")
    if fitted.select("label").distinct().count() < 2:
        return None
    tasks = -(-fitted.count() // task_rows)
    trees = GBTClassifier(
        featuresCol="vector", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7
    ).fit(fitted.repartition(max(4, tasks)))
    scored = trees.transform(rows.where("held_out"))
    limits = _thresholds(scored.withColumn("score", vector_to_array("probability")[1]))
    return (trees, limits) if limits else None


def find(docs: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added`` per row."""
    proposed = stage(docs.select("doc_id", "text").mapInArrow(_propose, _ROWS), "pii")
    numbered = proposed.withColumn("row", F.monotonically_increasing_id())
    model = train(proposed, task_rows)
    added = "array<struct<kind:int, start:bigint, end:bigint, score:double>>"
    if model is None:
        both = numbered.withColumn("added", F.array().cast(added))
    else:
        trees, limits = model
        limit = F.coalesce(F.get(
            F.array(*(F.lit(limits.get(k, 2.0)) for k in range(4))), F.col("kind")
        ), F.lit(2.0))
        single = numbered.select("row", F.inline("proposed")).withColumn(
            "vector", array_to_vector("features")
        )
        accepted = (
            trees.transform(single)
            .withColumn("score", vector_to_array("probability")[1])
            .where(F.col("score") >= limit)
            .groupBy("row")
            .agg(F.collect_list(F.struct("kind", "start", "end", "score")).alias("added"))
        )
        both = numbered.join(accepted, "row", "left")
    joined = F.pandas_udf(lambda b, a: pd.Series(_spans(b, a)), "string")
    digest = F.array_join(
        F.transform("base", lambda s: F.concat_ws(
            ":", F.get(F.array(*map(F.lit, KINDS)), s["kind"]),
            s["start"].cast("string"), s["end"].cast("string"),
        )), ",",
    )
    return both.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(digest, 256).alias("base_sha256"),
        joined("base", "added").alias("spans"),
        F.size(F.coalesce("added", F.array().cast(added))).cast("bigint").alias("n_proposed"),
    )


def redact(text: str, spans: str) -> str:
    """``text`` with each span replaced by its kind."""
    found = sorted(
        (int(a), int(b), kind) for kind, a, b in (s.split(":") for s in spans.split(",") if s)
    )
    out, at = [], 0
    for start, end, kind in found:
        if end > at:
            out += [text[at : max(at, start)], f"[{kind}]"]
            at = end
    return "".join(out) + text[at:]


def digest_of(spans: list[tuple[int, int, int]]) -> str:
    joined = ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)
    return hashlib.sha256(joined.encode()).hexdigest()
