"""Every registered query against its SQL, on the smallest given tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import TABLES, rows_of
from workload.catalog import QUERIES
from workload.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no given tables")


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(ORACLE[name])
    want = rows_of([c[0] for c in result.description], result.fetchall())
    assert got == want
    assert got[1]


def test_entry(spark):
    assert entry(spark).count() == 30
