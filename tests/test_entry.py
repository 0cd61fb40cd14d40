"""The registered queries, some of them against DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry

SCALE = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def tables_at(scale):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{scale}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module")
def oracle():
    return tables_at(SCALE)


def test_every_query_has_its_sql():
    assert all(name in entry.oracle_sql() for name in entry.CHECKS)


def test_entry_returns_rows(spark):
    assert not entry.entry(spark).isEmpty()


def agree(spark, connection, scale, name):
    df = entry.queries()[name](spark, scale)
    cursor = connection.execute(entry.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == sorted(df.columns)
    expected = sorted((tuple(row) for row in cursor.fetchall()), key=repr)
    assert sorted((tuple(row) for row in df.select(*names).collect()), key=repr) == expected


@pytest.mark.parametrize("name", sorted(entry.CHECKS))
def test_query_agrees_with_its_sql(spark, oracle, name):
    agree(spark, oracle, SCALE, name)


def test_running_sum_at_a_scale_of_many_blocks(spark):
    scale = "/root/testdata/sf0.1"
    agree(spark, tables_at(scale), scale, "xt_running_sum")
