"""Every query of the library against its SQL twin, at the smallest size."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb
import pytest

from urbana.queries.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def cell(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (float, Decimal)):
        v = float(v)
        return round(v, 4)
    if isinstance(v, (list, tuple)):
        return tuple(cell(x) for x in v)
    return str(v) if not isinstance(v, (int, bool, str)) else v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
