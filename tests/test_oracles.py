"""Every registered query against its SQL counterpart, on the smallest test tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from newsloom.catalog import QUERIES
from tests.oracle_check import connect, differences

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def engine():
    return connect(FOLDER)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, engine, name):
    assert differences(queries()[name](spark, FOLDER), engine, oracle_sql()[name]) is None


def test_entry(spark):
    rows = entry(spark)
    assert rows.columns[:3] == ["run_id", "source_id", "kind"] and rows.count() > 0
