"""Every registered query against its SQL on the smallest data."""

import datetime

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, ORACLE = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return value + 0.0
    return value.isoformat() if isinstance(value, datetime.datetime) else value


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLE[name])
    assert normal(df.columns, df.collect()) == normal([d[0] for d in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_without_sql(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0
