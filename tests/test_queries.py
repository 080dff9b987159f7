"""Every query against its SQL."""

from __future__ import annotations

import pytest
from compare import duck, duck_rows, spark_rows

import __spark_entry__ as entry_points
from conform.verification.oracle import ORACLE_SQL
from conform.verification.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    with duck(FOLDER) as opened:
        yield opened


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE_SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    df = QUERIES[name](spark, FOLDER)
    columns, expected = duck_rows(connection, ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(columns)
    assert spark_rows(df) == expected


def test_entry(spark):
    assert entry_points.entry(spark).count() == 6000
