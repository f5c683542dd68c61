"""Every registered query against its SQL statement in DuckDB."""

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as driver
from lakeloom.plans.catalog import REGISTRY


@pytest.fixture(scope="module")
def db():
    if not TESTDATA.exists():
        pytest.skip("no test tables")
    connection = duckdb.connect()
    for file in TESTDATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple((type(r[i]).__name__, repr(r[i])) for i in order) for r in rows])


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(driver.oracle_sql())
    assert set(REGISTRY) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(name, spark, db):
    frame = driver.queries()[name](spark, str(TESTDATA))
    assert len(set(frame.columns)) == len(frame.columns)
    found = db.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(frame.columns)
    assert comparable(frame.columns, [tuple(r) for r in frame.collect()]) == comparable(columns, found.fetchall())


def test_entry(spark):
    assert driver.entry(spark).count() == 20
