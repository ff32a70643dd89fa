"""Every registered query against its SQL twin, on the smallest driver tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from gaugeloft.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = contract.queries(), contract.oracle_sql()
OWN = sorted(registry.REGISTRY)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF}/{file}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = duck.sql(SQL[name])
    assert sorted(want.columns) == columns
    theirs = want.select(*[f'"{c}"' for c in columns]).fetchall()
    mine = df.select(*[f"`{c}`" for c in columns]).collect()
    assert sorted(tuple(map(plain, r)) for r in mine) == sorted(tuple(map(plain, r)) for r in theirs)
    assert mine


def test_entry(spark):
    assert contract.entry(spark).count() > 0
