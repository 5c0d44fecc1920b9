"""Every registered query gives the rows, names and types of its SQL twin."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from comarca.queries import QUERIES, SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

# DuckDB type -> Spark type, for the types the queries return.
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def ordered(rows):
    def key(row):
        return [(value is not None, str(value)) for value in row]

    return sorted(rows, key=key)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    got = ordered([tuple(row) for row in result.select(*[f"`{c}`" for c in columns]).collect()])

    sql = f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({SQL[name]})"
    described = duck.execute(f"DESCRIBE {SQL[name]}").fetchall()
    assert sorted(row[0] for row in described) == columns
    expected_types = {row[0]: TYPES[row[1]] for row in described}
    assert dict(result.dtypes) == expected_types
    expected = ordered(duck.execute(sql).fetchall())

    assert len(got) == len(expected)
    for mine, theirs in zip(got, expected, strict=True):
        for a, b in zip(mine, theirs, strict=True):
            if isinstance(a, float) and isinstance(b, float):
                assert math.isclose(a, b, rel_tol=0, abs_tol=0) or (math.isnan(a) and math.isnan(b))
            else:
                assert a == b


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_python_workers_find_the_library(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "environment", {"PYTHONPATH": "/elsewhere"})
    driver.importable(lambda session, folder: session.range(1))(spark, SF_DIR)
    assert spark.sparkContext.environment["PYTHONPATH"] == f"{driver.HERE}{os.pathsep}/elsewhere"
