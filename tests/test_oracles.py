"""Every registered query against its SQL, on the smallest test data."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from tallyshelf.checks import oracles, queries
from tests.compare import duckdb_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"
QUERIES = queries.queries()
ORACLES = oracles.oracle_sql()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    found_columns, found = spark_rows(QUERIES[name](spark, SF_DIR))
    wanted_columns, wanted = duckdb_rows(SF_DIR, ORACLES[name])
    assert found_columns == wanted_columns
    assert sum(found.values()) == sum(wanted.values())
    assert not found - wanted, f"{list((found - wanted).items())[:3]} vs {list((wanted - found).items())[:3]}"


def test_entry(spark):
    assert entry_points.entry(spark).columns[:2] == ["date", "weekday_name"]
