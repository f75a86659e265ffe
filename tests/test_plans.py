"""Plan assertions: the fact side is not shuffled, no Python UDF anywhere."""

import pytest

import __spark_entry__ as E
from wattframe import catalog

READ_ONLY_KEYS = [k for k in catalog.queries() if k not in (
    "json_roundtrip_generation", "csv_blank_join_keys", "incremental_merge", "partitioned_roundtrip",
    "incremental_daily_refresh", "stream_ingest_generation", "settlement_dates_present", "ingest_high_water_mark",
    "missing_settlement_dates_from_ledger", "incremental_merge_keyless", "county_top_source_incremental",
    "county_top_source_by_ranges", "json_array_generation", "stream_ingest_repeats")]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_360_view_joins_facts_once_without_shuffle(spark, sf_small):
    plan = _plan(E.queries()["generation_360_view"](spark, sf_small))
    assert plan.count("BroadcastHashJoin") == 1  # the unit dimension is a written table
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_as_of_join_aggregates_nothing_after_the_join(spark, sf_small):
    plan = _plan(E.queries()["capacity_as_of"](spark, sf_small))
    assert "Aggregate" not in plan[:plan.index("Join")]


def test_county_ranking_aggregates_before_the_join(spark, sf_small):
    plan = _plan(E.queries()["county_top_source"](spark, sf_small))
    join_at = plan.index("BroadcastHashJoin")
    assert "HashAggregate" in plan[join_at:]  # per-unit partial/final aggregate below the join
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("key", READ_ONLY_KEYS)
def test_no_python_evaluation_and_no_row_caps(spark, sf_small, key):
    plan = _plan(E.queries()[key](spark, sf_small))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # whole tables: no LIMIT anywhere (WindowGroupLimit is the top-1 ranking itself)
    assert not any(op in plan for op in ("GlobalLimit", "LocalLimit", "CollectLimit", "TakeOrderedAndProject"))
