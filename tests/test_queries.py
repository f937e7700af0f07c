"""Every query with SQL gives the rows that DuckDB does."""

import os

import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        path = f"{SF}/{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}/*.parquet')" if os.path.isdir(path) else f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([round(float(row[i]), 6) if isinstance(row[i], float) else row[i] for i in order] for row in rows), key=str)


@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_query(spark, duck, name):
    found = __spark_entry__.queries()[name](spark, SF)
    wanted = duck.execute(__spark_entry__.oracle_sql()[name])
    names = [column[0] for column in wanted.description]
    assert sorted(names) == sorted(found.columns)
    assert plain(found.collect(), found.columns) == plain(wanted.fetchall(), names)


def test_every_query_over_games_has_sql():
    from plycask.plans import queries

    assert set(queries.QUERIES) == set(queries.SQL)


def test_flagship(spark):
    assert __spark_entry__.entry(spark).count() > 0
