"""Each query against its SQL in DuckDB, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from hirelens.plans.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    found = duckdb.connect()
    found.sql("set timezone = 'UTC'")
    for path in Path(sf_dir).glob("*.parquet"):
        found.sql(f"create view {path.stem} as select * from '{path}'")
    return found


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v + 0.0:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, sf_dir, name):
    made, told = QUERIES[name](spark, sf_dir), con.sql(ORACLES[name])
    assert sorted(made.columns) == sorted(told.columns)
    names = sorted(made.columns)
    got = sorted(repr([plain(r[c]) for c in names]) for r in made.collect())
    at = [told.columns.index(c) for c in names]
    assert got == sorted(repr([plain(r[i]) for i in at]) for r in told.fetchall())
