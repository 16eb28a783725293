"""The physical plans that the queries should have: what is read, and what is shuffled."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as e

SF_DIR = "/root/testdata/sf0.001"


def plan_of(spark, name):
    return e.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    [
        "q_tz_date",
        "q_format_ts",
        "q_format_date",
        "q_stamp_ms",
        "q_parse_date",
        "q_cast_string",
        "q_dict_records",
        "q_contract_nulls",
        "q_incomplete_rows",
        "q_inline_rows",
        "q_csv_seed",
        "q_table_scan",
        "q_sql_scan",
    ],
)
def test_row_wise_queries_do_not_shuffle(spark, name):
    assert "Exchange hashpartitioning" not in plan_of(spark, name)


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("q_count", ""),
        ("q_dedup_exact", "l_orderkey:bigint,l_linenumber:int"),
        ("q_duplicate_report", "l_orderkey:bigint,l_linenumber:int"),
        ("q_project_narrow", "ts:timestamp_ntz,user_id:bigint,value:double"),
        ("q_high_water_mark", "ts:timestamp_ntz,user_id:bigint"),
        ("q_cast_string", "event_id:bigint,value:double"),
    ],
)
def test_scans_read_only_the_columns_they_need(spark, name, columns):
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(spark, name))) == {columns}


@pytest.mark.parametrize(
    ("name", "pushed"),
    [
        ("q_high_water_mark", "LessThan(ts,2024-01-15T00:00)"),
        ("q_range_predicate", "LessThan(ts,2024-01-25T00:00)"),
        ("q_range_predicate", "GreaterThanOrEqual(ts,2024-01-"),
        ("q_merge_upsert", "GreaterThanOrEqual(ts,2024-01-13T00:00)"),
    ],
)
def test_date_bounds_reach_the_scan(spark, name, pushed):
    assert any(pushed in p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", plan_of(spark, name)))


@pytest.mark.parametrize(
    ("name", "part"),
    [
        ("q_limit", "TakeOrderedAndProject"),
        ("q_dedup_key", "row_number(), 1, Partial"),
        ("q_duplicate_report", "partial_count"),
        ("q_high_water_mark", "partial_max"),
        ("q_advance_marks", "partial_max"),
        ("q_range_predicate", "LeftSemi"),
        ("q_merge_upsert", "LeftAnti"),
        ("q_inline_rows", "BroadcastHashJoin"),
    ],
)
def test_plans_have_the_wanted_operator(spark, name, part):
    assert part in plan_of(spark, name)


@pytest.mark.parametrize("name", ["q_worklist", "q_range_predicate", "q_merge_upsert", "q_advance_marks"])
def test_no_query_pairs_rows_without_keys(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
