"""Compares a query with its SQL twin."""

import math
import os

import duckdb

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def against_sql(spark, query, name, sf_dir=SF):
    from gaugeloft.llm.queries import QUERIES

    duck = duckdb.connect()
    for file in os.listdir(sf_dir):
        duck.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{sf_dir}/{file}'")
    mine = query(spark, sf_dir)
    columns = sorted(mine.columns)
    want = duck.sql(QUERIES[name][1])
    assert sorted(want.columns) == columns
    theirs = want.select(*[f'"{c}"' for c in columns]).fetchall()
    rows = [tuple(plain(r[c]) for c in columns) for r in mine.collect()]
    assert sorted(rows) == sorted(tuple(map(plain, r)) for r in theirs)
    assert rows
