"""Plan hygiene: filters and projections reach the scans; ``assert_clean_plan`` (used
by the oracle test on every registered query) bans cartesian products, nested-loop
joins and Python evaluation."""

import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def assert_clean_plan(df, python: bool = False) -> None:
    """``python``: k-means alone runs numpy on Arrow batches."""
    plan = _plan(df)
    assert not [t for t in BANNED + (() if python else PYTHON) if t in plan]


def _jobs(spark, build) -> int:
    before = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    build()
    return spark.sparkContext._jsc.sc().dagScheduler().nextJobId() - before


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", ["item_sequences", "category_visits"])
def test_building_starts_no_job_beyond_the_schemas(spark, name):
    assert _jobs(spark, lambda: E.queries()[name](spark, SF)) <= 1


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_category_stats_takes_no_checkpoint(spark):
    assert "ExistingRDD" not in _plan(E.queries()["category_stats"](spark, SF))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_report_month_is_pushed_into_the_scan(spark):
    plan = _plan(E.queries()["monthly_revenue"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_click_report_reads_only_needed_columns(spark):
    plan = _plan(E.queries()["low_cost_sites"](spark, SF))
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in plan
    assert "TakeOrderedAndProject" in plan
