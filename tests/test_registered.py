"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import compare

import __spark_entry__ as entry
from casegauge.plans import catalog

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES
EMPTY = {"baseline_levels", "last_good_snapshot"}  # queries without rows on the smallest tables


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_same_as_sql(spark, name):
    problems = compare(spark, FOLDER, QUERIES[name], ORACLES[name])
    assert problems == (["no rows"] if name in EMPTY else [])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_has_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())
