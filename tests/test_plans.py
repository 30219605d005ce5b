"""Properties of the physical plans that matter on a large cluster."""

import re

import pytest

from fieldseason.plans import queries as registered
from fieldseason.operators import bronze, gold, present, silver
from fieldseason.schemas import OBSERVATIONS
from fieldseason.sources import fixtures, tables

QUERIES = registered.registry()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("obs") / "table")
    tables.write_layer(fixtures.observations(spark, sf), path, ["stationId"])
    return tables.read_table(spark, path, OBSERVATIONS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_cross_join_no_single_partition_window(spark, sf, name):
    plan = plan_of(QUERIES[name](spark, sf))
    for unwanted in ("PythonUDF", "EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan
    # Only a global aggregate may gather rows in one partition, and it gets partial ones.
    assert not gathers_for_a_window(plan)


def gathers_for_a_window(plan: str) -> bool:
    """Whether a window's rows come from an exchange to a single partition."""
    lines = [line.strip(" :+-*()0123456789") for line in plan.splitlines()]
    for at, line in enumerate(lines):
        if line.startswith("Window ["):
            below = next((x for x in lines[at + 1:] if not x.startswith(("Sort", "Project", "InputAdapter"))), "")
            if "SinglePartition" in below:
                return True
    return False


def test_a_window_over_one_partition_is_seen(spark):
    whole = spark.range(10).selectExpr("sum(id) over (order by id) as s")
    assert gathers_for_a_window(plan_of(whole))
    assert gathers_for_a_window(plan_of(spark.range(10).selectExpr("sum(id) over () as s")))
    assert not gathers_for_a_window(plan_of(spark.range(10).selectExpr("sum(id) over (partition by id) as s")))


def test_date_ranges_reach_the_scan(spark, stored, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    path = str(tmp_path / "daily")
    tables.write_layer(silver.silver_weather(stored, fixtures.ANCHOR), path)
    daily = tables.read_table(spark, path)
    for frame in (present.daily_drilldown(daily, None, 1997), present.slice_daily(daily, 1997, 1998),
                  present.choose_grain(daily, 1997, 1998)):
        assert "GreaterThanOrEqual(date,1997-01-01)" in plan_of(frame)
    assert "LessThan(date,1999-01-01)" in plan_of(present.slice_daily(daily, 1997, 1998))
    stations = fixtures.stations(spark, "/root/testdata/sf0.001")
    assert "GreaterThanOrEqual(date,1995)" in plan_of(bronze.station_inventory(stored, stations, 1995, 2002))


def test_station_filter_prunes_partitions(stored):
    plan = plan_of(silver.pivot_supplemental(stored, fixtures.SUPPLEMENTAL))
    assert re.search(r"PartitionFilters: \[.*stationId.*ST3", plan)
    assert "attributes" not in re.search(r"ReadSchema: (\S+)", plan).group(1)


def test_trim_and_delete_are_pushed_to_the_scan(stored):
    assert "LessThanOrEqual(date,1999-09-30)" in plan_of(bronze.trim_after(stored, "1999-09-30"))
    assert "StringStartsWith(date,1997-05)" in plan_of(bronze.delete_month(stored, "1997-05"))


def test_medians_read_three_columns(stored):
    schema = re.search(r"ReadSchema: (\S+)", plan_of(silver.pool_medians(stored))).group(1)
    assert schema == "struct<date:string,dataType:string,value:double>"


def test_daily_table_shuffles_observations_once_per_grouping(stored):
    assert plan_of(silver.day_wide(stored)).count("Exchange hashpartitioning") == 1
    assert plan_of(silver.pool_medians(stored)).count("Exchange hashpartitioning") == 2


def test_season_shuffles_partial_totals_and_then_stations(spark, sf, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    path = str(tmp_path / "daily")
    tables.write_layer(silver.silver_weather(fixtures.observations(spark, sf)), path)
    days = gold.qualified_days(tables.read_table(spark, path))
    long = plan_of(gold.season_long(days))
    assert long.count("Exchange") == 2 and "partial_sum" in long
    # The wide table needs no further exchange.
    assert plan_of(gold.season_wide(gold.season_long(days))).count("Exchange") == 2


def test_report_scans_once(stored):
    assert plan_of(bronze.bronze_report(stored)).count("FileScan") == 1
