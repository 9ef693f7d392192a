"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import math
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import duckdb
import pytest

import __spark_entry__ as E
from sparkmine.plans import catalog
from sparkmine.plans.views import TABLES
from test_plans import assert_clean_plan

SF = os.environ.get("SPARKMINE_ORACLE_SF", "/root/testdata/sf0.01")
QUERIES, ORACLE = catalog.queries(), catalog.oracle_sql()
NAMES = sorted(ORACLE)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert_clean_plan(df, python=name.startswith("kmeans") or name == "bigrams_estimated")
    res = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(res.columns)
    rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    assert rows and rows == _rows(res.columns, res.fetchall())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF)
    assert_clean_plan(df)
    assert df.count() > 0


def test_entry_smoke(spark):
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns


HOT_PATH = ["sequence_positions", "category_stats", "refresh_stats_runs", "seq_rules"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", HOT_PATH)
def test_skew_safe_path_matches_oracle(spark, con, name):
    """Every group counts as hot: positions and visit scans take the range-split path."""
    spark.conf.set("sparkmine.scan.hotGroupRows", "10")
    try:
        df = QUERIES[name](spark, SF)
        res = con.sql(ORACLE[name])
        assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(res.columns, res.fetchall())
    finally:
        spark.conf.unset("sparkmine.scan.hotGroupRows")
