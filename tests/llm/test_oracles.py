"""The registered queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from strata.llm import oracles, queries

SCALE = "/root/testdata/sf0.01"


def test_registry():
    assert oracles.SQL.keys() < queries.QUERIES.keys()
    assert [name.split("_")[0] for name in queries.QUERIES] == [f"op{n}" for n in range(1, len(queries.QUERIES) + 1)]


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_query_agrees_with_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SCALE}/{table}.parquet'")
    cursor = connection.execute(oracles.SQL[name])
    names = [column[0] for column in cursor.description]
    df = queries.QUERIES[name](spark, SCALE)
    assert sorted(names) == sorted(df.columns)
    expected = sorted((tuple(row) for row in cursor.fetchall()), key=repr)
    assert sorted((tuple(row) for row in df.select(*names).collect()), key=repr) == expected
