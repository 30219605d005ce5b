"""What sorted files and buckets spare."""

import pathlib

import pyarrow.parquet as pq
import pytest

from fieldseason.plans import queries as registered
from fieldseason.schemas import OBSERVATIONS
from fieldseason.sources import fixtures, layouts, tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def row_groups(path, station):
    """Row groups of a table, and those whose statistics may hold the station."""
    total = hit = 0
    for file in pathlib.Path(path).rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        place = [meta.row_group(0).column(i).path_in_schema for i in range(meta.num_columns)].index("stationId")
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(place).statistics
            total, hit = total + 1, hit + (stats.min <= station <= stats.max)
    return total, hit


def test_a_station_filter_reads_a_fraction_of_the_row_groups(spark, tmp_path):
    obs = fixtures.observations(spark, "/root/testdata/sf0.01")
    plain, sorted_ = str(tmp_path / "plain"), str(tmp_path / "sorted")
    tables.write_layer(obs, plain, ["year"])
    layouts.write_clustered(obs, sorted_, row_group=16 << 10)
    total, hit = row_groups(plain, "GHCND:ST1")
    assert hit == total
    total, hit = row_groups(sorted_, "GHCND:ST1")
    assert total > 20 and hit < 0.45 * total  # four stations: a quarter, and the groups at their ends
    stored = tables.read_partitioned(spark, sorted_, OBSERVATIONS, ["year"])
    one = stored.filter("stationId = 'GHCND:ST1'")
    assert "EqualTo(stationId,GHCND:ST1)" in plan_of(one)
    assert one.count() == obs.filter("stationId = 'GHCND:ST1'").count()


@pytest.mark.parametrize("buckets", [4, 24])
def test_buckets_need_no_exchange(spark, sf, tmp_path, buckets):
    obs = fixtures.observations(spark, sf)
    name = f"bucketed_{buckets}_{tmp_path.name.replace('-', '_')}"
    stored = layouts.write_bucketed(obs, name, str(tmp_path / "t"), buckets)
    assert "Exchange" not in plan_of(layouts.bucketed_duplicates(stored))
    new = obs.filter("date >= '2001-01-01'").selectExpr("stationId", "date", "dataType", "value + 1 as value", "attributes")
    plan = plan_of(layouts.upsert_bucketed(stored, new, buckets))
    lines = plan.splitlines()
    for at, line in enumerate(lines):  # no exchange above a scan of the stored table
        if "FileScan" in line and "Bucketed: true" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            for above in reversed(lines[:at]):
                if (d := len(above) - len(above.lstrip(" :+-"))) < depth:
                    depth = d
                    assert "Exchange hashpartitioning" not in above
    again = layouts.attach_bucketed(
        spark, f"{name}_again", str(tmp_path / "t"), "stationId string, date string, dataType string, value double, attributes string", buckets)
    assert "Exchange" not in plan_of(layouts.bucketed_duplicates(again)) and again.count() == obs.count()


def test_the_bucketed_queries_are_registered():
    assert {"duplicate_keys_bucketed", "upsert_bucketed", "clustered_station"} <= set(registered.registry())
