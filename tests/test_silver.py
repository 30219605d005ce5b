import random
from datetime import date

import pytest

from fieldseason.operators import silver
from fieldseason.plans import layers
from fieldseason.schemas import DAILY
from fieldseason.sources import fixtures


def by_date(df):
    return {str(r["date"]): r for r in df.collect()}


def test_quality_order_missing_before_suspect(obs):
    df = obs(
        ("A", "2000-01-01", "TMAX", None, ",X,S"), ("A", "2000-01-02", "TMAX", 1.0, ",X,S"),
        ("A", "2000-01-02", "TMIN", 1.0, ",,S"), ("A", "2000-01-03", "TMAX", 1.0, None),
    )
    flags = {d: r["qualityFlag"] for d, r in by_date(silver.day_quality(df)).items()}
    assert flags == {"2000-01-01": "MISSING", "2000-01-02": "SUSPECT", "2000-01-03": "OK"}


def test_day_wide_equals_pivot_joined_with_quality(spark, sf):
    df = fixtures.observations(spark, sf)
    joined = silver.pivot_elements(df).join(silver.day_quality(df), ["stationId", "date"])
    wide = silver.day_wide(df)
    assert sorted(wide.collect()) == sorted(joined.select(*wide.columns).collect())


def lower_median(values):
    return sorted(values)[(len(values) - 1) // 2] if values else None


@pytest.mark.parametrize("exclude", [(), ("S1",)])
def test_pool_median_is_the_lower_median_of_all_readings(obs, exclude):
    random.seed(7)
    rows = [
        (f"S{random.randrange(4)}", f"2000-01-{random.randrange(1, 6):02d}",
         random.choice(["TMAX", "TMIN", "PRCP"]), random.choice([None, 1.0, 2.5, -3.0, 40.0, 7.0]))
        for _ in range(200)
    ] + [("S1", "2000-02-01", "TMAX", 5.0), ("S2", "2000-02-02", "PRCP", 5.0)]
    exact = by_date(silver.pool_medians(obs(*rows), exclude))
    assert set(exact) == {r[1] for r in rows}
    for day, row in exact.items():
        for element in ("TMAX", "TMIN"):
            readings = [
                v for s, d, e, v in rows
                if d == day and e == element and v is not None and s not in exclude
            ]
            assert row[f"pool{element}"] == lower_median(readings)


def test_pool_median_of_a_date_that_holds_most_rows(spark):
    df = spark.range(50001).selectExpr(
        "concat('S', id) as stationId", "if(id % 3 = 0, '2000-01-02', '2000-01-01') as date",
        "'TMAX' as dataType", "cast(id % 701 as double) / 10 as value",
        "cast(null as string) as attributes",
    )
    found = by_date(silver.pool_medians(df))
    for day, rest in (("2000-01-02", (0,)), ("2000-01-01", (1, 2))):
        readings = [(i % 701) / 10 for i in range(50001) if i % 3 in rest]
        assert found[day]["poolTMAX"] == lower_median(readings)


def test_element_names_are_quoted(obs):
    wide = silver.pivot_elements(obs(("A", "2000-01-01", "T'X", 1.0)), ["T'X"])
    assert wide.first()["T'X"] == 1.0


def test_tiers(obs):
    df = obs(
        ("A", "2000-01-01", "TMAX", 10.0), ("A", "2000-01-01", "TMIN", 0.0),
        ("A", "2000-01-02", "PRCP", 1.0), ("B", "2000-01-02", "TMAX", 20.0), ("B", "2000-01-02", "TMIN", 2.0),
        ("A", "2000-01-03", "PRCP", 1.0), ("S", "2000-01-03", "TMAX", 30.0), ("S", "2000-01-03", "TMIN", 3.0),
        ("A", "2000-01-04", "PRCP", 1.0),
        ("A", "2000-01-05", "TMAX", 11.0), ("B", "2000-01-05", "TMAX", 20.0), ("B", "2000-01-05", "TMIN", 4.0),
        ("A", "2000-01-06", "PRCP", 1.0), ("B", "2000-01-06", "TMAX", 12.0), ("S", "2000-01-06", "TMIN", 5.0),
        ("B", "2000-01-07", "TMAX", 12.0),
    )
    daily = by_date(silver.silver_weather(df, "A", "S", "Anchor", "Supp", exclude=["A", "S"]))
    assert set(daily) == {f"2000-01-0{d}" for d in range(1, 7)}
    found = {
        d[-1]: (r["tempMaxF"], r["tempMinF"], r["tempSource"], r["tempStationId"], r["tempStationName"])
        for d, r in daily.items()
    }
    assert found == {
        "1": (50.0, 32.0, "anchor", "A", "Anchor"),
        "2": (68.0, 35.6, "pool", "pool_median", "Pool Median"),
        "3": (86.0, 37.4, "supplemental", "S", "Supp"),
        "4": (None, None, "mixed", None, None),
        "5": (51.8, 39.2, "pool", "A", "Anchor"),
        "6": (53.6, 41.0, "mixed", "pool_median", "Pool Median"),
    }
    assert daily["2000-01-03"]["tempAvgF"] == 33.0 / 2 * 9 / 5 + 32
    assert daily["2000-01-02"]["precipIn"] == 1.0 / 25.4


def test_the_pool_holds_the_supplemental_station_by_default(obs):
    df = obs(
        ("A", "2000-01-03", "PRCP", 1.0), ("S", "2000-01-03", "TMAX", 30.0), ("S", "2000-01-03", "TMIN", 3.0)
    )
    assert silver.silver_weather(df, "A", "S").first()["tempSource"] == "pool"


def test_rows_without_a_date_are_dropped_and_bad_dates_are_null(obs):
    df = obs(("A", None, "TMAX", 1.0), ("A", "2000-13-01", "TMAX", 1.0), ("A", "2000-12-01", "TMAX", 1.0))
    dates = [r["date"] for r in silver.silver_weather(df, "A").collect()]
    assert sorted(dates, key=str) == [date(2000, 12, 1), None]


def test_daily_schema(spark, sf):
    daily = silver.silver_weather(fixtures.observations(spark, sf), fixtures.ANCHOR)
    assert [(f.name, f.dataType) for f in daily.schema] == [(f.name, f.dataType) for f in DAILY]


def test_daily_rows_are_the_anchor_dates(spark, sf):
    df = fixtures.observations(spark, sf)
    daily = silver.silver_weather(df, fixtures.ANCHOR, fixtures.SUPPLEMENTAL)
    dates = df.filter(df.stationId == fixtures.ANCHOR).select("date").distinct().count()
    assert daily.count() == dates


def test_every_station_is_its_own_anchor(spark, sf):
    df = fixtures.observations(spark, sf)
    everyone = layers.all_stations_silver(df, fixtures.stations(spark, sf), fixtures.SUPPLEMENTAL)
    one = silver.silver_weather(df, "GHCND:ST1", fixtures.SUPPLEMENTAL, "Station 1")
    own = everyone.filter("stationId = 'GHCND:ST1'")
    assert sorted(map(repr, own.collect())) == sorted(map(repr, one.collect()))


def test_validation_alerts_text(spark):
    validation = spark.createDataFrame(
        [(2000, 100, 366, 27.3, "SPARSE", 1), (2001, 365, 365, 100.0, "OK", 0), (2002, 365, 365, 100.0, "OK", 73)],
        "year int, totalRows bigint, expectedDays int, coveragePct double, coverageStatus string,"
        " nullTempRows bigint",
    )
    assert sorted(map(tuple, silver.validation_alerts(validation).collect())) == [
        (2000, "100/366 days (27.3%) [SPARSE]; 1/100 rows with null tempAvgF (1.0%)"),
        (2002, "73/365 rows with null tempAvgF (20.0%)"),
    ]
