"""Links of listing pages as a table: merged over scroll steps and runs, with what changed.

A link of a page is kept at the place where it was first seen: run, step, position. A page
that is read again tells which of its links are new, still there, back, or gone; pages that a
run did not read keep their links as they were. Rows meet by page and URL, never by page
alone, so a page with very many links is dealt out like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.operators.skew import keep_first, spread_join

SCHEMA = (
    "section_url string, url string, first_run string, first_step int, first_pos bigint, "
    "last_run string, gone_run string"
)
KEY = ["section_url", "url"]


def found_links(steps: DataFrame) -> DataFrame:
    """Each link of a page once, at its first place. ``steps``: section_url, step, link_pos,
    url."""
    rows = steps.select(
        "section_url", "url", F.col("step").cast("int").alias("step"),
        F.col("link_pos").cast("bigint").alias("link_pos"),
    ).where(F.col("url").isNotNull())
    return keep_first(rows, KEY, ["step", "link_pos"])


def merge_link_table(
    previous: DataFrame, found: DataFrame, read: DataFrame, run_id: str
) -> DataFrame:
    """The link table after a run, and ``change``: ``new``, ``kept``, ``back`` (it had been
    gone), ``gone`` (now), ``still_gone``, or null where the page was not read.

    ``found`` comes from ``found_links``; ``read`` names the pages (section_url, distinct)
    that the run has read, those without links included."""
    now = found.select(*KEY, F.struct("step", "link_pos").alias("_now"))
    known = previous.withColumn("_known", F.lit(True))
    both = known.join(now, KEY, "full")
    pages = read.select("section_url", F.lit(True).alias("_read"))
    both = spread_join(both, pages, ["section_url"], "left")
    seen, known, gone = F.col("_now").isNotNull(), F.col("_known").isNotNull(), F.col("gone_run")
    lost = known & ~seen & F.col("_read").isNotNull()
    change = (
        F.when(seen & ~known, "new").when(seen & gone.isNotNull(), "back").when(seen, "kept")
        .when(lost & gone.isNull(), "gone").when(lost, "still_gone")
    )

    def first(name: str, value: Column) -> Column:
        return F.when(known, F.col(name)).otherwise(value).alias(name)

    return both.select(
        *KEY,
        first("first_run", F.lit(run_id)),
        first("first_step", F.col("_now.step")),
        first("first_pos", F.col("_now.link_pos")),
        F.when(seen, F.lit(run_id)).otherwise(F.col("last_run")).alias("last_run"),
        F.when(lost, F.coalesce(gone, F.lit(run_id)))
        .when(~seen, gone).alias("gone_run"),
        change.alias("change"),
    )
