from collections import defaultdict
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest

from fieldseason.functions.calendar import WINDOWS, CalendarWindow
from fieldseason.operators import gold, silver
from fieldseason.sources import fixtures

DAYS = "stationId string, date date, tempMaxF double, tempMinF double, tempAvgF double, precipIn double, snowIn double"


@pytest.fixture
def days(spark):
    def make(*rows):
        return spark.createDataFrame(
            [(s, d, hi, lo, (hi + lo) / 2, p, n) for s, d, hi, lo, p, n in rows], DAYS
        )

    return make


def synthetic():
    """Days on all window edges, in a leap year and others, with missing stretches."""
    rows = []
    for station, year in [("A", 1999), ("A", 2000), ("A", 2001), ("B", 2000)]:
        day = date(year, 1, 1)
        while day.year == year:
            n = day.timetuple().tm_yday
            if (n + year) % 5 and not (year == 2001 and day.month in (2, 7)):
                high = 32.0 + (n * 7 + year) % 71
                low = high - 5.0 - n % 30
                rain = None if n % 4 == 0 else (n % 13) / 8.0
                rows.append((station, day, high, low, rain, None if n % 3 else n / 16.0))
            day += timedelta(days=1)
    return rows


def half_up(value: Fraction, digits: int) -> float:
    scaled = Decimal(value.numerator) / Decimal(value.denominator)
    return float(scaled.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def brute_force(rows):
    years = {(s, d.year) for s, d, *_ in rows}
    found = {}
    for station, year in years:
        for window in WINDOWS:
            inside = [
                r for r in rows
                if r[0] == station and r[1].year == year and window.holds(r[1].month * 100 + r[1].day)
            ]
            gdd = sum(
                max(Fraction(0), (Fraction(min(hi, 86.0)) + Fraction(max(lo, 50.0))) / 2 - 50)
                for _, _, hi, lo, _, _ in inside
            )
            mean = (
                sum(Fraction((hi + lo) / 2) for _, _, hi, lo, _, _ in inside) / len(inside)
                if inside else Fraction(0)
            )
            found[station, year, window.key] = {
                "gdd": half_up(Fraction(gdd), 1),
                "precipIn": half_up(sum((Fraction(r[4] or 0.0) for r in inside), Fraction(0)), 2),
                "snowIn": half_up(sum((Fraction(r[5] or 0.0) for r in inside), Fraction(0)), 2),
                "frostFreeDays": sum(r[3] > 32.0 for r in inside),
                "heatStressDays": sum(r[2] > 95.0 for r in inside),
                "avgTempF": half_up(mean, 1),
            }
    totals = defaultdict(list)
    for (station, _, window), metrics in found.items():
        totals[station, window].append(round(metrics["precipIn"] * 100))
    for (station, _, window), metrics in found.items():
        series = totals[station, window]
        mean = Fraction(sum(series), len(series))
        metrics["droughtIndex"] = (
            half_up((round(metrics["precipIn"] * 100) - mean) / mean, 4) if mean else None
        )
    return found


def test_season_long_equals_brute_force(days):
    rows = synthetic()
    expected = brute_force(rows)
    found = {
        (r["stationId"], r["year"], r["window"]): {m: r[m] for m in gold.METRICS}
        for r in gold.season_long(days(*rows)).collect()
    }
    assert found == {k: {m: v[m] for m in gold.METRICS} for k, v in expected.items()}


def test_result_does_not_depend_on_row_order(days):
    rows = synthetic()
    forward, backward = gold.season_long(days(*rows)), gold.season_long(days(*rows[::-1]).repartition(7))
    assert sorted(map(repr, forward.collect())) == sorted(map(repr, backward.collect()))


def test_a_year_has_all_windows_and_empty_ones_are_zero(days):
    found = {r["window"]: r for r in gold.season_long(days(("A", date(2000, 7, 4), 90.0, 60.0, None, None))).collect()}
    assert len(found) == 22
    assert found["jan"]["gdd"] == 0.0 and found["jan"]["avgTempF"] == 0.0
    assert found["jan"]["droughtIndex"] is None
    assert found["jul"]["gdd"] == 23.0 and found["all"]["avgTempF"] == 75.0


def test_a_null_date_forms_a_year_of_zeros(days):
    found = gold.season_long(days(("A", None, 90.0, 60.0, 1.0, 1.0))).collect()
    assert len(found) == 22
    assert {r["year"] for r in found} == {None} and {r["gdd"] for r in found} == {0.0}


def test_own_windows_and_thresholds(days):
    rows = [("A", date(2000, 12, 31), 90.0, 40.0, 1.0, 0.0), ("A", date(2000, 1, 1), 80.0, 45.0, 2.0, 0.0)]
    turn = CalendarWindow("turn", 1220, 110)
    row = gold.season_long(days(*rows), [turn], base=40.0, cap=100.0, frost=42.0, heat=85.0).first()
    assert (row["gdd"], row["precipIn"]) == (25.0 + 22.5, 3.0)
    assert (row["frostFreeDays"], row["heatStressDays"]) == (1, 1)


def test_wide_has_every_window_and_metric(days):
    rows = synthetic()
    long = {
        (r["stationId"], r["year"], r["window"]): r for r in gold.season_long(days(*rows)).collect()
    }
    wide = gold.season_wide(gold.season_long(days(*rows)))
    assert len(wide.columns) == 2 + 22 * 7
    for row in wide.collect():
        for window in WINDOWS:
            for metric in gold.METRICS:
                expected = long[row["stationId"], row["year"], window.key][metric]
                assert row[gold.wide_column(window.key, metric)] == expected


def test_season_table_of_a_station_has_157_columns(spark, sf):
    daily = silver.silver_weather(fixtures.observations(spark, sf), fixtures.ANCHOR)
    table = gold.season_weather(daily, "001", "NE", fixtures.ANCHOR)
    assert len(table.columns) == 157
    assert table.columns[:3] == ["year", "countyFips", "stateCode"]
    rows = table.collect()
    assert {(r["countyFips"], r["stateCode"]) for r in rows} == {("001", "NE")}
    assert all(r["growingDegreeDays"] is not None and r["frostFreeDays"] is not None for r in rows)


def test_windows_add_up(days):
    found = {(r["year"], r["window"]): r for r in gold.season_long(days(*synthetic())).filter("stationId = 'A'").collect()}
    months = [w.key for w in WINDOWS[-12:]]
    for year in (1999, 2000, 2001):
        growing = sum(found[year, m]["frostFreeDays"] for m in months[4:9])
        assert found[year, "cornGrowing"]["frostFreeDays"] == growing
        season = sum(found[year, m]["heatStressDays"] for m in months[3:11])
        assert found[year, "all"]["heatStressDays"] == season
    for window in WINDOWS:
        indices = [found[y, window.key]["droughtIndex"] for y in (1999, 2000, 2001)]
        assert abs(sum(indices)) < 3e-4


def test_totals_are_not_quantised(spark):
    daily = spark.range(204).selectExpr(
        "'A' as stationId", "date_add(date '2001-04-01', cast(id as int)) as date", "60D as tempMaxF", "50D as tempMinF",
        "55D as tempAvgF", "2.7D / 25.4D as precipIn", "0D as snowIn")
    season = {r["window"]: r for r in gold.season_long(daily).collect()}
    assert season["all"]["precipIn"] == 21.69
    assert season["all"]["gdd"] == 204 * 5.0


def test_a_countys_first_station_speaks_for_it(spark):
    daily = spark.sql("""select stationId, date'2001-06-01' as date, 60D as tempMaxF, 50D as tempMinF, 55D as tempAvgF,
        precip as precipIn, 0D as snowIn from values ('A', 1D), ('B', 2D), ('C', 3D) v(stationId, precip)""")
    counties = spark.createDataFrame([("A", "001", "NE"), ("B", "001", "NE")], "stationId string, countyFips string, stateCode string")
    found = gold.county_seasons(daily, counties).collect()
    assert [(r["year"], r["countyFips"], r["stationId"], r["totalPrecipIn"]) for r in found] == [(2001, "001", "A", 1.0)]
    twice = counties.union(spark.createDataFrame([("A", "002", "NE")], counties.schema))
    with pytest.raises(Exception, match="several counties for A"):
        gold.county_seasons(daily, twice).collect()


def test_close_to_plain_double_arithmetic(spark, sf):
    daily = gold.qualified_days(silver.silver_weather(fixtures.observations(spark, sf), fixtures.ANCHOR))
    plain = gold.with_gdd(daily).groupBy("stationId", daily.date.substr(1, 4).cast("int").alias("year")).agg(
        *gold.named(
            gdd="round(sum(cast(case when month between 4 and 11 then gdd else 0 end as decimal(24, 12))), 1)",
            precip="round(sum(cast(case when wheatGrowing then coalesce(precipIn, 0) else 0 end as decimal(24, 12))), 2)",
        )
    )
    table = gold.season_wide(gold.season_long(daily)).join(plain, ["stationId", "year"])
    for row in table.collect():
        assert row["growingDegreeDays"] == float(row["gdd"])
        assert row["wheatGrowingPrecipIn"] == float(row["precip"])


def test_qualified_days(spark):
    daily = spark.createDataFrame(
        [("A", "OK", 1.0, 1.0), ("A", "SUSPECT", 1.0, 1.0), ("A", "MISSING", 1.0, 1.0),
         ("A", "OK", None, 1.0), ("A", "OK", 1.0, None), ("B", "OK", 1.0, 1.0)],
        "stationId string, qualityFlag string, tempMaxF double, tempMinF double",
    )
    assert sorted(r["qualityFlag"] for r in gold.qualified_days(daily, "A").collect()) == ["MISSING", "OK"]
    assert gold.qualified_days(daily).count() == 3


def test_temp_availability_marks_years_without_temperatures(spark):
    daily = spark.createDataFrame(
        [(date(2000, 1, d), 1.0 if d == 1 else None, 1.0) for d in range(1, 9)]
        + [(date(2001, 1, 1), None, None)],
        "date date, tempMaxF double, tempMinF double",
    )
    assert [tuple(r) for r in gold.temp_availability(daily).collect()] == [
        (2000, 8, 1, "13%", ""), (2001, 1, 0, "0%", "NO TEMPERATURE DATA"),
    ]


def test_absurd_readings_stop_no_job_and_depend_on_no_order(spark, days):
    rows = [("A", date(2001, 5, d), 1e9 + d / 7, 40.0 + d / 3, 1e9 / d, 0.1 * d) for d in range(1, 29)]
    rows += [("A", date(2001, 6, 1), 80.0, 60.0, 1e300, 1e13), ("A", date(2002, 6, 1), 80.0, 60.0, 1e11, 5.0)]
    found = [
        sorted(map(repr, gold.season_long(days(*order).repartition(n)).collect()))
        for n, order in ((1, rows), (7, rows[::-1]), (3, rows[5:] + rows[:5]))
    ]
    assert found[0] == found[1] == found[2]
    long = {(r["year"], r["window"]): r for r in gold.season_long(days(*rows)).collect()}
    may = [r for r in rows if r[1].month == 5]
    assert long[2001, "may"]["precipIn"] == half_up(sum(Fraction(r[4]) for r in may), 2)
    assert long[2001, "may"]["avgTempF"] == half_up(sum(Fraction((r[2] + r[3]) / 2) for r in may) / len(may), 1)
    assert long[2001, "jun"]["precipIn"] == 0.0 and long[2001, "jun"]["snowIn"] == 0.0  # no measures
    assert long[2002, "jun"]["precipIn"] == 1e11 and long[2002, "jun"]["droughtIndex"] == 1.0
    wide = gold.season_wide(gold.season_long(days(*rows))).collect()
    assert len(wide) == 2
