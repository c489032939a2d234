"""Plan guards for every catalogue query: no cartesian or nested-loop joins, no Python
evaluation (als_fold_in alone solves its small systems in Arrow batches), filters reach the Parquet scan, and only needed columns are read."""

import pytest

from rateflow.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas", "Generate explode(collect_list"]


_PLANS = {}


def _plan(spark, name):
    """The plan of a query; queries that store tables on the way are run for it once."""
    if name not in _PLANS:
        _PLANS[name] = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    return _PLANS[name]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_forbidden_operators(spark, name):
    plan = _plan(spark, name)
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


# Those that split the ratings by date; their base and deltas together are all ratings.
BY_DATE = {"load_delta_text", "delta_fold", "apply_delta", "apply_delta_twice", "keyword_average_after_delta", "apply_delta_stream",
           "apply_delta_stored", "keyword_averages_after_delta", "als_fold_in", "baseline_predict", "unseen_candidates", "als_predict", "als_coldstart"}


@pytest.mark.parametrize("name", ["apply_delta", "baseline_predict", "delta_fold"])
def test_shipdate_cut_is_pushed_to_parquet(spark, name):
    plan = _plan(spark, name)
    assert "PushedFilters: [IsNotNull(l_shipdate)" in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - BY_DATE))
def test_other_queries_do_not_cut_by_date(spark, name):
    plan = _plan(spark, name)
    assert "GreaterThanOrEqual(l_shipdate" not in plan and "LessThan(l_shipdate" not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_query_reads_a_table(spark, name):
    assert "FileScan" in _plan(spark, name)


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(spark, "items_per_year")
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_shipdate:timestamp_ntz>" in plan
    assert "l_extendedprice" not in plan and "l_comment" not in plan


def test_top_k_limits_before_exchange(spark):
    plan = _plan(spark, "recommend_baseline")
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "Scan parquet" in plan or "FileScan parquet" in plan


def test_aggregates_are_partial(spark):
    for name in ["items_per_year", "user_averages", "item_deviation", "delta_fold", "lsh_buckets"]:
        plan = _plan(spark, name)
        assert "partial_" in plan, name
