"""Every registered query against its SQL, run by DuckDB on the same tables."""

import os

import duckdb
import pytest
from conftest import DATA

from tablewright.plans.queries import ORACLES, QUERIES

# Spark type names -> DuckDB type names, for the types the queries return.
TYPES = {
    "tinyint": "TINYINT",
    "smallint": "SMALLINT",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(DATA):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{file}'")
    return connection


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    found = duck.execute(ORACLES[name])
    columns = {d[0]: str(d[1]) for d in found.description}
    ours = {f: TYPES.get(t, t.upper()) for f, t in df.dtypes}
    assert ours == {c: t.replace(" ", "") for c, t in columns.items()}
    order = sorted(columns)
    expected = [dict(zip(columns, row)) for row in found.fetchall()]
    expected = sorted((tuple(row[c] for c in order) for row in expected), key=repr)
    actual = sorted((tuple(row[c] for c in order) for row in df.collect()), key=repr)
    assert expected, "the query should find something"
    assert actual == expected
