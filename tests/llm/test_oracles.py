"""Queries that SQL can express, against it."""

import os

import duckdb
import pytest

from seawarden.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, folder, name):
    connection = duckdb.connect()
    for table in os.listdir(folder):
        connection.execute(f"CREATE VIEW {table.split('.')[0]} AS SELECT * FROM '{folder}/{table}'")
    result = connection.execute(ORACLE[name])
    names = [column[0] for column in result.description]
    got = sorted(tuple(r[c] for c in names) for r in QUERIES[name](spark, folder).collect())
    assert got == sorted(result.fetchall()) and got
