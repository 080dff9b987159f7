"""Queries of the text operators against their SQL."""

from __future__ import annotations

import pytest
from compare import duck, duck_rows, spark_rows

from conform.llm.oracle import ORACLE_SQL
from conform.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, name):
    df = QUERIES[name](spark, FOLDER)
    with duck(FOLDER) as connection:
        columns, expected = duck_rows(connection, ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(columns)
    assert spark_rows(df) == expected
