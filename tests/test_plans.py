"""Physical plans: what would hurt on large tables must not appear."""

from __future__ import annotations

import re
from itertools import takewhile

import pytest

from tillstream.plans import bindings as b
from tillstream.plans import stream_queries
from tillstream.plans.registry import QUERIES

BATCH = [n for n in QUERIES if n not in stream_queries.QUERIES]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def depth(line: str) -> int:
    """How deep a plan line is nested."""
    return len(line) - len(line.lstrip(" :+-"))


@pytest.fixture
def no_small_tables(spark):
    """As if every table were too large to broadcast by size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", BATCH)
def test_no_products_and_no_broadcast_of_growing_tables(spark, sf, no_small_tables, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    # Tables under a broadcast by hint are of fixed size, or counted and cut by the policy.
    lines = text.split("\n")
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = list(takewhile(lambda x: depth(x) > depth(line), lines[i + 1:]))
            part = "\n".join([line, *below])
            tables = set(re.findall(r"/(\w+)\.parquet", part))
            counted = any(mark in part for mark in ("_hot_", "_cut_", "_carry_chunk"))
            assert tables <= {"nation", "region"} or counted, tables


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(QUERIES["order_cep_matched"](spark, sf))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in text
    detail = plan(b.table(spark, sf, "lineitem").where("l_returnflag = 'R'").select("l_partkey"))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in detail
    assert "ReadSchema: struct<l_partkey:bigint,l_returnflag:string>" in detail


def test_each_log_line_is_parsed_once_per_pass(spark, sf):
    assert plan(QUERIES["log_split_counts"](spark, sf)).count("from_json(") == 1
    assert plan(QUERIES["product_page_actions"](spark, sf)).count("from_json(") == 1


def test_sliding_windows_do_not_copy_rows(spark, sf):
    text = plan(QUERIES["hot_pages_topn"](spark, sf))
    assert "Expand" not in text
    assert text.count("ENSURE_REQUIREMENTS") <= 3


@pytest.mark.parametrize(("name", "scans"), [("running_sum", 10), ("tx_reconcile", 20), ("running_uv", 20), ("login_cep", 10), ("visitor_stats", 10)])
def test_hot_keys_are_counted_once(spark, sf, name, scans):
    assert plan(QUERIES[name](spark, sf)).count("Scan parquet") <= scans


def test_user_aggregates_shuffle_accumulators_only(spark, sf):
    text = plan(QUERIES["udaf_by_user"](spark, sf))
    assert text.count("MapInArrow") == 3 and "FlatMapGroups" not in text
    assert text.count("REPARTITION_BY_COL") == 2
