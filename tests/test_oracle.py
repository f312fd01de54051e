"""Every registered query against its SQL check, on the smallest tables."""

import pytest
from compare import difference, duck

import __spark_entry__ as entry
from drives import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
# Joins on these tables are empty at the smallest size.
MAY_BE_EMPTY = {"description_overflow", "removed_links"}


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_names_match():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    df = QUERIES[name](spark, FOLDER)
    assert len(set(df.columns)) == len(df.columns)
    problem = difference(df, connection, ORACLES[name])
    assert problem is None or (problem == "empty result" and name in MAY_BE_EMPTY), problem


def test_entry(spark):
    assert entry.entry(spark).count() > 0
