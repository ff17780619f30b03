"""Every registered query against its DuckDB oracle on the smallest driver data set."""

from __future__ import annotations

import os

import duckdb
import pytest

from __spark_entry__ import entry
from ledgerlake.plans.registry import build_registry
from tools.oracle_check import TABLES, norm_frame

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = build_registry()
KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() == 150
    assert "engagement_status" in df.columns


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    got = norm_frame(QUERIES[key](spark, SF).toPandas())
    exp = norm_frame(duck.execute(ORACLE[key]).df())
    assert list(got.columns) == list(exp.columns)
    assert len(got) == len(exp)
    assert got.to_dict("records") == exp.to_dict("records")
