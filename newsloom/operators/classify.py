"""The outcome of each scanned article."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.answers import is_complete_extraction
from newsloom.operators.snapshots import is_article_complete


def early_reason() -> Column:
    """Why a row ends before it gets a key; null for rows that go on."""
    return (
        F.when(F.col("url").isNull(), F.lit("invalid_url"))
        .when(
            F.col("fetch_error").startswith("article_parse: "), F.col("fetch_error")
        )
        .when(
            F.col("fetch_error").isNotNull(), F.concat(F.lit("article_fetch: "), "fetch_error")
        )
        .when(F.col("paywalled"), F.lit("login_required"))
        .when(F.coalesce(F.col("title"), F.lit("")) == "", F.lit("missing_title"))
        .when(
            ~is_article_complete("title", "body_excerpt", F.col("min_body_chars")),
            F.lit("empty_body"),
        )
    )


def to_extract(extractor_on: bool) -> Column:
    """Rows worth an extractor call: keyed, first of their key, changed."""
    return (
        F.lit(extractor_on)
        & F.col("entry_key").isNotNull()
        & ~F.col("is_duplicate")
        & (F.col("change_status") != "unchanged")
    )


def classify(rows: DataFrame, extractor_on: bool, status_mode: str = "index") -> DataFrame:
    """Add ``action`` and ``reason``: the first rule that fits decides.

    Input: ``early_reason``, ``entry_key``, ``is_duplicate``, ``change_status`` and
    ``extraction``. With ``status_mode="current"`` accepted rows are always ``new``."""
    early = F.col("early_reason")
    e = F.col("extraction")
    complete = is_complete_extraction(e["is_relevant"], e["startup_name"], e["news_summary"])
    status = (
        F.when(F.col("change_status") == "updated", F.lit("updated")).otherwise(F.lit("new"))
        if status_mode == "index"
        else F.lit("new")
    )

    def outcome(action: str | Column, reason: Column | str | None) -> Column:
        action = F.lit(action) if isinstance(action, str) else action
        if not isinstance(reason, Column):
            reason = F.lit(reason).cast("string")
        return F.struct(action.alias("action"), reason.alias("reason"))

    skipped_early = early.isin("missing_title", "empty_body")
    decided = (
        F.when(skipped_early, outcome("skipped", early))
        .when(early.isNotNull(), outcome("error", early))
        .when(F.col("is_duplicate"), outcome("skipped", "duplicate_in_run"))
        .when(F.col("change_status") == "unchanged", outcome("skipped", "unchanged_content"))
    )
    if not extractor_on:
        decided = decided.otherwise(outcome("skipped", "ai_disabled"))
    else:
        decided = (
            decided.when(
                F.coalesce(e["extraction_failed"], F.lit(True)),
                outcome("error", "extraction_failed"),
            )
            .when(~F.coalesce(e["is_relevant"], F.lit(False)), outcome("not_relevant", None))
            .when(~complete, outcome("error", "incomplete_extraction"))
            .otherwise(outcome(status, None))
        )
    return (
        rows.withColumn("_outcome", decided)
        .withColumn("action", F.col("_outcome.action"))
        .withColumn("reason", F.col("_outcome.reason"))
        .drop("_outcome")
    )


def accepted() -> Column:
    """Rows that count towards the limit of new rows."""
    return F.col("action") == "new"


def stored() -> Column:
    """Rows that go into the news table."""
    return F.col("action").isin("new", "updated")
