"""Every registered query of the climate engine against its SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
import os

import duckdb
import pytest

from aridspan.plans.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF_DIR):
        pytest.skip(f"{SF_DIR} is not there")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, dt.datetime):
        return value.date().isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    want = duck.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    rows = [tuple(plain(r[c]) for c in columns) for r in got.collect()]
    expected = [tuple(plain(v) for v in r) for r in want.project(", ".join(f'"{c}"' for c in columns)).fetchall()]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)


def test_entry_has_all(spark):
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
