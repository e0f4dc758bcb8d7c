"""Every registered query with SQL gives DuckDB's rows, on the smallest tables."""

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    df = contract.queries()[name](spark, SMALL)
    cursor = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    assert sorted(df.columns) == sorted(columns)
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    assert canonical(df.columns, df.collect()) == canonical(columns, cursor.fetchall())


def test_every_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_is_the_full_feature_table(spark):
    df = contract.entry(spark)
    assert len(df.columns) == 23
    assert df.count() == 1000


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_queries_without_sql_give_rows(spark, name):
    assert contract.queries()[name](spark, SMALL).count() > 0
