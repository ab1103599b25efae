"""Every registered query against its SQL on the smallest tables."""

import glob
import os
import sys

import duckdb
import pytest

from conftest import SF_SMALL
from releasemill import queries as registry

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_SMALL}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_its_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)


@pytest.mark.parametrize("name", registry.QUERIES)
def test_query(spark, database, name):
    frame = registry.QUERIES[name](spark, SF_SMALL)
    columns = sorted(frame.columns)
    found = sorted(repr([row[c] for c in columns]) for row in frame.collect())
    result = database.execute(registry.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = sorted(repr([row[p] for p in places]) for row in result.fetchall())
    assert found == expected


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 200
    assert set(registry.QUERIES) <= set(__spark_entry__.queries())
