"""Every named query against its SQL twin in DuckDB."""

import os

import duckdb
import pytest

from tidemark.catalog import ORACLES, QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DATA}/{name}.parquet')")
    return connection


def key(row):
    return tuple((v is None, str(v)) for v in row)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=key)
    result = duck.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=key)
    assert got == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
