"""Physical-plan properties that matter at scale, checked for every registered query."""

import re

import pytest

from tempora.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"
RUNS = {"events_daily_stream", "events_dedupe_stream"}       # these execute while being built
NAMES = sorted(set(REGISTRY) - RUNS)


def plan_of(spark, name):
    return REGISTRY[name][0](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_cartesian_no_row_udf_and_pruned_scans(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan                       # no row-at-a-time Python UDFs
    for schema in re.findall(r"lineitem\.parquet[^\n]*\n?.*?ReadSchema: struct<([^>]*)>", plan, re.S):
        assert len(schema.split(",")) < 11                     # never all lineitem columns


def test_time_ranges_reach_the_scan(spark):
    for name in ["avg_temp_after_2000", "avg_temp_before_2000", "avg_yearly_temp", "stg_weather"]:
        plan = plan_of(spark, name)
        assert re.search(r"PushedFilters: \[[^\]]*l_shipdate", plan), name


def test_questions_about_some_months_read_those_months(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    for name in ["macro_weather_range", "macro_weather_range_city", "climate_extremes", "compare_city_climates"]:
        pushed = re.search(r"PushedFilters: \[([^\]]*l_shipdate[^\]]*)", plan_of(spark, name)).group(1)
        assert "GreaterThanOrEqual(l_shipdate,199" in pushed and "LessThan(l_shipdate," in pushed, name
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_one_pass_over_the_readings(spark):
    for name in ["avg_temp_before_after_2000", "data_freshness", "new_locations"]:
        assert plan_of(spark, name).count("lineitem.parquet") <= 1, name


def test_dedupe_limits_before_the_shuffle(spark):
    plan = REGISTRY["dedupe_latest"][0](spark, SF)._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    # a row_number() = 1 limit runs on each map task, below (after, in the text) the shuffle
    assert re.search(r"WindowGroupLimit \[[^\n]*Partial", plan[shuffle:])


def test_topn_is_distributed(spark):
    for name in ["hottest_years", "rainiest_years", "latest_weather", "climate_extremes"]:
        assert "TakeOrderedAndProject" in plan_of(spark, name), name


def test_merges_join_without_a_full_outer_join_and_without_rows_in_python(spark):
    for name in ["upsert_last_wins", "incremental_merge", "new_locations"]:
        plan = plan_of(spark, name)
        assert "FullOuter" not in plan and "BatchEvalPython" not in plan, name


def test_merges_read_the_target_twice_and_the_written_delivery_apart(spark):
    for name in ["upsert_last_wins", "insert_ignore", "incremental_merge"]:
        assert plan_of(spark, name).count("lineitem.parquet") <= 2, name
