"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of test tables, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import re
import time

from newsloom.catalog.queries import QUERIES
from newsloom.session import build_session

HEADLINES = (
    "canonical_urls",
    "page_links",
    "page_links_native",
    "page_articles",
    "section_changes",
    "article_join",
    "content_keys",
    "duplicate_in_run",
    "fresh_urls",
    "change_states",
    "event_caps",
    "snapshot_articles",
    "attempt_select",
    "extraction_parse",
    "rule_extraction",
    "outcomes",
    "source_counters",
    "news_upsert",
    "discover",
    "discover_all",
    "discover_snapshots",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = build_session(
        "newsloom-bench",
        master=f"local[{cpus}]",
        extra={
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    for name in ("canonical_urls", "page_links", "rule_extraction"):  # start the workers
        run(name)
    seconds = {name: round(run(name), 3) for name in HEADLINES}
    scale = re.search(r"sf([0-9.]+)/?$", folder)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
