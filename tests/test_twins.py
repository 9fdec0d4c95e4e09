"""Every registered query against its SQL twin, and the driver's entry points."""

import os

import pytest

from shelfwright.checks import all_queries
from shelfwright.checks.compare import connect, difference

FOLDER = os.environ.get("CHECK_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = all_queries()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_twin(spark, duck, name):
    assert difference(QUERIES[name](spark, FOLDER), duck, SQL[name]) is None


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())
