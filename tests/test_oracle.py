"""Every registered query against its SQL, over the whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from seawarden.plans.oracle import ORACLE
from seawarden.plans.queries import QUERIES

# The other engine reports a coarse kind per column in some versions and the type in others.
KINDS = {
    "BIGINT": "number",
    "INTEGER": "number",
    "DOUBLE": "number",
    "NUMBER": "number",
    "VARCHAR": "string",
    "STRING": "string",
    "TIMESTAMP": "time",
    "DATETIME": "time",
    "Date": "time",
    "BOOLEAN": "boolean",
    "bool": "boolean",
}
SPARK_KINDS = {"bigint": "number", "int": "number", "double": "number", "timestamp": "time"}


@pytest.fixture(scope="module")
def other_engine(folder):
    connection = duckdb.connect()
    for name in os.listdir(folder):
        connection.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{folder}/{name}'")
    return connection


def _plain(value):
    return round(value, 9) + 0.0 if isinstance(value, float) else value


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, folder, other_engine, name):
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    result = other_engine.execute(ORACLE[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == columns
    types = {name: str(column[1]) for name, column in zip(names, result.description)}
    assert {name: KINDS.get(kind, kind) for name, kind in types.items()} == {
        name: SPARK_KINDS.get(kind, kind) for name, kind in df.dtypes
    }
    place = [names.index(column) for column in columns]
    expected = sorted((tuple(_plain(row[i]) for i in place) for row in result.fetchall()), key=repr)
    got = sorted((tuple(_plain(row[c]) for c in columns) for row in df.collect()), key=repr)
    assert got == expected
    assert got, "no rows"


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0
