"""Every query of the linkage engine against its SQL twin."""

import math

import duckdb
import pytest

from rillstone.plans.linkage import QUERIES
from rillstone.plans.linkage_sql import ORACLE_SQL

DATA = "/root/testdata/sf0.01"


def _plain(v):
    return f"{v:.6f}" if isinstance(v, float) and math.isfinite(v) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in "customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want, got = con.sql(ORACLE_SQL[name]), QUERIES[name](spark, DATA)
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    mine = sorted(tuple(_plain(r[c]) for c in cols) for r in got.collect())
    theirs = sorted(tuple(map(_plain, r)) for r in want.select(*(f'"{c}"' for c in cols)).fetchall())
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_others_return_rows(spark, name):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
