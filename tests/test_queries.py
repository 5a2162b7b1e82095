"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, normal

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_same_rows_as_sql(spark, db, name):
    ours = entry.queries()[name](spark, SF).toPandas()
    if name not in entry.oracle_sql():
        assert len(ours) > 0
        return
    theirs = db.execute(entry.oracle_sql()[name]).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert normal(ours) == normal(theirs)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
