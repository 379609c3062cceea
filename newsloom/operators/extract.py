"""The extractor plug-in: articles in, raw answers out, answers read by expressions."""

from __future__ import annotations

import json
import re
import threading
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.answers import parse_extraction
from newsloom.functions.identity import extract_payload
from newsloom.functions.text import truncate_text
from newsloom.operators.journal import AnswerJournal, payload_hash
from newsloom.operators.skew import spread_join
from newsloom.schemas import EXTRACTION
from newsloom.session import stage
from newsloom.specs import EXTRACT_MAX_CHARS

# A batch of payload texts to a batch of raw answers; None is a failure.
Extractor = Callable[[list[str]], Sequence[str | None]]

#: Payloads of one call.
BATCH_SIZE = 256


class _TimeUpError(Exception):
    """A batch was not answered within the time limit."""


def _called(fn: Extractor, payloads: list[str], seconds: float | None) -> list[str | None]:
    """``fn(payloads)``, given up after a time. The thread of a call that is given up ends
    with the worker, if not before."""
    if seconds is None:
        return list(fn(payloads))
    done: list = []

    def call() -> None:
        try:
            done.append((list(fn(payloads)), None))
        except Exception as error:  # noqa: BLE001 - raised below, in the caller's thread
            done.append((None, error))

    thread = threading.Thread(target=call, daemon=True)
    thread.start()
    thread.join(seconds)
    if not done:
        raise _TimeUpError
    found, error = done[0]
    if error is not None:
        raise error
    return found


def _answers(fn: Extractor, payloads: list[str], seconds: float | None = None) -> list[str | None]:
    """Answers of a batch. A batch that fails is tried again in halves, so one payload that
    cannot be answered costs a few calls and not one for each of the others. A batch that
    runs out of time is not tried again."""
    try:
        found = _called(fn, payloads, seconds)
        if len(found) != len(payloads):
            raise ValueError("one answer per payload expected")
        return found
    except _TimeUpError:
        return [None] * len(payloads)
    except Exception:  # noqa: BLE001 - a failing extractor must not fail the job
        if len(payloads) == 1:
            return [None]
        half = len(payloads) // 2
        return _answers(fn, payloads[:half], seconds) + _answers(fn, payloads[half:], seconds)


def ask_extractor(
    payload: Column, fn: Extractor, batch_size: int = BATCH_SIZE, seconds: float | None = None
) -> Column:
    """Raw answer per payload, ``batch_size`` payloads and at most ``seconds`` at a time; null
    ones are not asked about."""

    @F.arrow_udf("string")
    def ask(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for payloads in batches:
            asked = payloads.drop_null()
            answers = iter([
                answer
                for at in range(0, len(asked), batch_size)
                for answer in _answers(fn, asked.slice(at, batch_size).to_pylist(), seconds)
            ])
            yield pa.array(
                [next(answers) if one.is_valid else None for one in payloads], pa.string(),
                from_pandas=True,
            )

    # called once per row: the optimizer must neither repeat nor move it
    return ask.asNondeterministic()(payload)


def extract_with(
    rows: DataFrame,
    fn: Extractor | None,
    wanted: Column | None = None,
    max_chars: int | None = EXTRACT_MAX_CHARS,
    parallelism: int | None = None,
    batch_size: int = BATCH_SIZE,
    seconds: float | None = None,
    journal: AnswerJournal | None = None,
    run_id: str = "",
) -> DataFrame:
    """Add ``extraction`` to rows with ``url``, ``title`` and ``body_excerpt``.

    Rows that are not ``wanted`` cost nothing but a null. ``parallelism`` sets how many
    tasks call the extractor at once: the wanted rows are dealt out evenly, whatever their
    keys, and the others stay where they are; as that reads ``rows`` twice, stage them.
    None leaves the partitions as they are. ``seconds`` is the time limit of a batch.

    With a ``journal`` a payload that any run has answered is not asked again, equal payloads
    are asked once, and tasks are sized by the journal, not by ``parallelism``."""
    if fn is None:
        return rows.withColumn("extraction", F.lit(None).cast(EXTRACTION))
    wanted = F.lit(True) if wanted is None else wanted
    if journal is not None:
        return _journaled(rows, fn, wanted, max_chars, batch_size, seconds, journal, run_id)
    if parallelism is not None:
        asked = F.coalesce(wanted, F.lit(False))
        some = rows.where(asked).repartition(parallelism)
        rest = rows.where(~asked).withColumn("extraction", F.lit(None).cast(EXTRACTION))
        answered = extract_with(some, fn, None, max_chars, None, batch_size, seconds)
        return answered.unionByName(rest)
    asked = F.when(F.col("_wanted"), _payload(max_chars))
    return (
        rows.withColumn("_wanted", wanted)
        .withColumn("_raw", ask_extractor(asked, fn, batch_size, seconds))
        .withColumn("extraction", F.when(F.col("_wanted"), parse_extraction("_raw")))
        .drop("_wanted", "_raw")
    )


def _payload(max_chars: int | None) -> Column:
    body = F.col("body_excerpt")
    body = body if max_chars is None else truncate_text("body_excerpt", max_chars)
    return extract_payload("url", "title", body)


def _journaled(
    rows: DataFrame,
    fn: Extractor,
    wanted: Column,
    max_chars: int | None,
    batch_size: int,
    seconds: float | None,
    journal: AnswerJournal,
    run_id: str,
) -> DataFrame:
    own = F.coalesce(wanted, F.lit(False))
    marked = stage(
        rows.withColumn("_wanted", own).withColumn(
            "payload_hash", F.when(own, payload_hash(_payload(max_chars)))
        ),
        "to-answer",
    )
    payloads = marked.where("_wanted").select(_payload(max_chars).alias("payload"))
    found = journal.answer(
        payloads, lambda c: ask_extractor(F.col(c), fn, batch_size, seconds), run_id
    )
    asked = spread_join(marked.where("_wanted"), found, ["payload_hash"], "left").withColumn(
        "extraction", parse_extraction("answer")
    )
    rest = marked.where("NOT _wanted").withColumn("extraction", F.lit(None).cast(EXTRACTION))
    return asked.select(*rows.columns, "extraction").unionByName(
        rest.select(*rows.columns, "extraction")
    )


@dataclass(frozen=True)
class KeywordExtractor:
    """A deterministic extractor without a model.

    An article is relevant when its title or body holds one of ``keywords`` as a
    whole word, whatever the case. The name is what stands in the title before the
    first keyword, or else its first word; the site is the first URL of the body, the
    summary its first sentence, up to a dot before white space or the end."""

    keywords: tuple[str, ...] = ("raises", "raised", "secures", "bags", "acquires", "launches")

    def __call__(self, payloads: list[str]) -> list[str]:
        words = "|".join(re.escape(k) for k in self.keywords)
        keyword = re.compile(rf"(?i)(?:^|[^a-z])({words})(?:[^a-z]|$)")
        return [json.dumps(self._read(json.loads(p), keyword)) for p in payloads]

    @staticmethod
    def _read(article: dict, keyword: re.Pattern) -> dict:
        title, body = article["title"] or "", article["bodyExcerpt"] or ""
        if not (keyword.search(title) or keyword.search(body)):
            return {"isRelevant": False}
        hit = keyword.search(title)
        name = title[: hit.start(1)].strip() if hit else ""
        site = re.search(r"https?://[a-z0-9.-]+", body)
        sentence = re.match(r"(?s).*?\.(?=\s|\Z)", body)
        return {
            "isRelevant": True,
            "startupName": name or title.split(" ")[0],
            "startupWebsite": site.group(0) if site else None,
            "description": None,
            "newsSummary": sentence.group(0) if sentence else None,
        }
