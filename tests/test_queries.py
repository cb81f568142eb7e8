"""Every query with SQL gives what DuckDB gives on the same tables."""

import math
from pathlib import Path

import duckdb
import pytest

from marketloom import queries

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for p in Path(DIR).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, DIR)
    want = duck.execute(queries.SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows_of(got.columns, got.collect()) == rows_of(names, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, DIR).count() > 0
