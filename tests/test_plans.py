"""What the physical plans must and must not hold."""

from __future__ import annotations

import pytest

from clickloom.registry.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
BATCH = [
    n for n in QUERIES
    if not n.endswith(("_stream", "_sliding", "_sink")) and "_job_" not in n and not n.endswith("_job")
]


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_everything_runs_in_the_jvm_without_cross_joins(spark, name):
    text = plan(spark, name)
    for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_columns_are_pruned(spark):
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>" in plan(
        spark, "news_section_pv"
    )
    clicks = plan(spark, "area_product_clicks")
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in clicks


def test_date_filters_reach_the_scan(spark):
    text = plan(spark, "news_page_pv")
    pushed = text[text.index("PushedFilters"):]
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in pushed
    assert "LessThan(ts,2024-01-16T00:00)" in pushed


@pytest.mark.parametrize("name", ["top_sessions", "area_top3_product", "ad_province_top3", "session_sample"])
def test_groups_are_cut_before_the_shuffle(spark, name):
    text = plan(spark, name)
    final, partial = text.index("Final"), text.index("Partial")
    assert "WindowGroupLimit" in text
    assert "Exchange hashpartitioning" in text[final:partial]


def test_the_global_top_list_is_merged_not_sorted(spark):
    assert "TakeOrderedAndProject(limit=10" in plan(spark, "top_categories")


def test_clicks_are_counted_before_they_meet_the_cities(spark):
    text = plan(spark, "area_product_clicks")
    join = text.index("Join [city_id")
    assert "partial_count(1)" in text[join:]
    assert "partial_count(1)" not in text[:join]


def test_the_category_list_is_broadcast_to_the_details(spark):
    text = plan(spark, "top_sessions")
    assert "BroadcastHashJoin [click_category_id" in text and "LeftSemi, BuildRight" in text


def test_hot_sessions_are_salted_only_when_there_are_any(spark):
    assert "_salt" not in plan(spark, "session_details")
    assert "_salt" in plan(spark, "skew_join")


def test_convert_rates_scan_the_actions_once(spark):
    assert plan(spark, "page_convert_rates").count("FileScan") == 1


def test_split_join_reads_its_left_side_once(spark):
    assert plan(spark, "skew_split_join").count("events.parquet") == 1
