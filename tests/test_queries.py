"""Every registered query against DuckDB on the given tables."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from compare import rows_of

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
          " conversations").split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(entry_module.queries()))
def test_query(name, spark, sf, duck):
    df = entry_module.queries()[name](spark, sf)
    got = df.collect()
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    result = duck.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, got) == rows_of(names, result.fetchall())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
