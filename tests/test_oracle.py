"""Registered queries against DuckDB on the smallest tables."""

import math

import duckdb
import numpy as np
import pytest

from synapark.plans import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool | np.bool_):
        return bool(v)
    if isinstance(v, int | np.integer):
        return int(v)
    return round(float(v), 7) + 0.0 if isinstance(v, float | np.floating) else v


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, FOLDER)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    found = duck.execute(catalog.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == names
    want = sorted((tuple(plain(r[columns.index(c)]) for c in names) for r in found.fetchall()), key=repr)
    assert got == want
