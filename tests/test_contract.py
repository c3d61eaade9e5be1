"""Registered queries against their SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from millrace.plans import oracles
from millrace.plans import queries as registry

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the generated tables")

@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def ordered(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in records), key=repr)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracles.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SMALL)
    found = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert ordered(df.columns, df.collect()) == ordered(names, found.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
