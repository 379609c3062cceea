"""Physical plans: what is read, shuffled and run in Python."""

import os
import re

import pytest
from pyspark.sql import functions as F

from newsloom.catalog.queries import QUERIES
from newsloom.operators.articles import fetch_pages
from newsloom.operators.select import cap_items
from newsloom.schemas import PAGES

FOLDER = "/root/testdata/sf0.001"

needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_tables
@pytest.mark.parametrize(
    "name",
    ["page_links", "article_join", "duplicate_in_run", "change_states", "outcomes", "fresh_urls"],
)
def test_no_task_takes_everything(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert not re.search("CartesianProduct|NestedLoop|Exchange SinglePartition", plan)


@needs_tables
@pytest.mark.parametrize("name", ["canonical_urls", "fresh_urls", "freshness"])
def test_markup_is_not_read_for_urls(spark, name):
    schemas = re.findall(r"ReadSchema: (\S+)", plan_of(QUERIES[name](spark, FOLDER)))
    assert schemas and not any("html" in s for s in schemas)


@needs_tables
@pytest.mark.parametrize("name, calls", [("page_links", 1), ("page_articles", 1), ("article_join", 1)])
def test_each_page_is_parsed_once(spark, name, calls):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert len(re.findall("ArrowEvalPython", plan)) == calls


@needs_tables
@pytest.mark.parametrize("name", ["canonical_urls", "page_links_native", "content_keys", "outcomes"])
def test_expressions_stay_in_the_jvm(spark, name):
    assert "Python" not in plan_of(QUERIES[name](spark, FOLDER))


def test_item_limit_is_applied_before_the_shuffle(spark):
    rows = spark.range(100).select(
        F.lit("r").alias("run_id"),
        (F.col("id") % 3).alias("source_id"),
        F.lit(0).alias("section_ord"),
        F.col("id").alias("link_pos"),
    )
    plan = plan_of(cap_items(rows, 50))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_few_keys_leave_the_page_table_in_place(spark, tmp_path):
    spark.createDataFrame([], PAGES).write.parquet(str(tmp_path / "pages"))
    pages = spark.read.schema(PAGES).parquet(str(tmp_path / "pages"))
    keys = spark.createDataFrame([("https://h.com/a",)], "url string")
    plan = plan_of(fetch_pages(keys, pages, max_keys=1))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan.split("SortAggregate")[-1]
