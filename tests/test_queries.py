"""Every registered query against its SQL in DuckDB, on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as contract
from tools.compare import TABLES, lines

DIR = "/root/testdata/sf0.001"
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    df = QUERIES[name](spark, DIR)
    rel = con.execute(SQL[name])
    columns = [c[0] for c in rel.description]
    assert lines(df.columns, df.collect()) == lines(columns, rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DIR).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 150
