"""Every query with SQL against that SQL, on the smallest tables."""

from __future__ import annotations

import math
import os

import pytest

from annolake.plans.catalog import QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return None
    return float(x) if isinstance(x, float) else x


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name].run(spark, DATA)
    rows = sorted(repr(tuple(plain(r[c]) for c in sorted(got.columns))) for r in got.collect())
    assert rows
    if QUERIES[name].sql:
        found = duck.execute(QUERIES[name].sql)
        names = [c[0] for c in found.description]
        expected = sorted(repr(tuple(plain(x) for _, x in sorted(zip(names, r, strict=True)))) for r in found.fetchall())
        assert sorted(names) == sorted(got.columns)
        assert rows == expected
