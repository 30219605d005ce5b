import json
import random
from datetime import date
from fractions import Fraction

import pytest

from fieldseason.operators import gold, present, silver
from fieldseason.plans import queries
from fieldseason.sources import fixtures

LONG = (
    "stationId string, year int, window string, gdd double, precipIn double, frostFreeDays int,"
    " heatStressDays int, droughtIndex double, avgTempF double, snowIn double"
)


def test_latest_reading(spark):
    daily = spark.createDataFrame(
        [("A", date(2020, 1, 5), 50.25), ("A", date(2020, 1, 6), None), ("A", date(2020, 1, 4), 60.0),
         ("B", date(2020, 1, 4), None)],
        "stationId string, date date, tempAvgF double",
    )
    found = {r["stationId"]: r for r in present.latest_reading(daily).collect()}
    assert (found["A"]["temperature"], found["A"]["day"]) == ("50.3°F", "Sunday, Jan 5, 2020")
    assert (found["B"]["temperature"], found["B"]["day"]) == ("--", "--")
    absent = present.latest_reading(daily, "C").collect()
    assert [(r["stationId"], r["temperature"], r["day"]) for r in absent] == [("C", "--", "--")]


def test_season_table_text(spark):
    long = spark.createDataFrame(
        [("A", 2000, "all", 1234.5, 12.25, 100, 21, -0.0005, 60.0, 0.0),
         ("A", 2001, "all", 0.0, 12.35, 100, 0, 0.0, 60.1, 1.05),
         ("A", 2002, "all", 1.0, 0.0, 1, 0, None, 0.0, 0.0), ("A", 2001, "jan", 1.0, 0.0, 1, 0, 1.0, 0.0, 0.0)],
        LONG,
    )
    rows = [tuple(r)[1:] for r in present.season_table(long).collect()]
    assert rows == [
        (2002, "1", "0.0", "0.0", "0.0", 1, 0, "—", "Normal"),
        (2001, "0", "12.3", "60.1", "1.1", 100, 0, "+0.000", "Normal"),
        (2000, "1235", "12.3", "60.0", "0.0", 100, 21, "-0.001", "Stress"),
    ]


def test_melt_is_the_long_form(spark, sf):
    days = gold.qualified_days(silver.silver_weather(fixtures.observations(spark, sf), fixtures.ANCHOR))
    long = gold.season_long(days)
    melted = present.melt_metrics(gold.season_wide(long))
    assert melted.columns == ["stationId", "year", "window", "metric", "value"]
    expected = {
        (r["year"], r["window"], m): r[m] for r in long.collect() for m in gold.METRICS
    }
    assert {(r["year"], r["window"], r["metric"]): r["value"] for r in melted.collect()} == expected


def test_summary_skips_null_and_nan(spark):
    melted = spark.createDataFrame(
        [("all", "gdd", 1.0), ("all", "gdd", 3.0), ("all", "gdd", None), ("all", "gdd", float("nan"))],
        "window string, metric string, value double",
    )
    row = present.summary_stats(melted).first()
    assert (row["avgValue"], row["minValue"], row["maxValue"], row["stddevValue"]) == (2.0, 1.0, 3.0, 1.0)


def test_slices(spark, sf):
    daily = queries.daily_of(spark, sf)
    july = present.slice_daily(daily, 1997, 1998, "jul").collect()
    assert {r["date"].month for r in july} == {7} and {r["date"].year for r in july} == {1997, 1998}
    wheat = present.slice_daily(daily, 1997, 1997, "wheatGrowing").collect()
    assert all(r["wheatGrowing"] for r in wheat)
    with pytest.raises(ValueError):
        present.slice_daily(daily, 1997, 1998, "other")


def test_grain(spark, sf):
    daily = queries.daily_of(spark, sf)
    grain = [present.choose_grain(daily, a, b).first()["grain"] for a, b in [(1996, 2000), (1996, 2001), (2050, 2051)]]
    assert grain == ["daily", "annual", "annual"]


def test_drilldown_keeps_days_without_temperatures(spark):
    daily = spark.createDataFrame(
        [("A", date(2000, 1, 1), "OK", None, None), ("A", date(2000, 1, 2), "SUSPECT", 90.0, 60.0),
         ("A", date(2000, 1, 3), "MISSING", 96.0, 33.0), ("A", date(1999, 1, 3), "OK", 96.0, 33.0)],
        "stationId string, date date, qualityFlag string, tempMaxF double, tempMinF double",
    )
    rows = present.daily_drilldown(daily, "A", 2000).orderBy("date").collect()
    assert [(r["dailyGdd"], r["frostFreeFlag"], r["heatStressFlag"]) for r in rows] == [(None, 0, 0), (18.0, 1, 1)]


def test_exports_are_valid_json_with_nulls(spark, sf):
    annual = queries.gold_of(spark, sf)
    for row in present.export_annual(annual).collect():
        assert len(json.loads(row["json"])) == 1 + 22 * 7
    days = present.daily_drilldown(queries.daily_of(spark, sf), fixtures.ANCHOR, 1995)
    exported = [json.loads(r["json"]) for r in present.export_daily(days).collect()]
    assert all(list(e) == list(present.DAY_FIELDS) for e in exported)
    assert any(e["precipIn"] is None for e in exported)


def test_preview_and_sample(spark):
    df = spark.range(150).selectExpr("149 - id as id")
    assert [r["id"] for r in present.preview(df, "id").collect()] == list(range(100))
    sample = present.sample_table(df, "id").collect()
    assert [r["id"] for r in sample] == list(range(20)) and {r["tableRows"] for r in sample} == {150}


def test_moments_have_the_same_digits_however_rows_are_dealt(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b"]), "m", rng.choice([rng.gauss(60, 20), rng.random() / 25.4, 0.1, None, float("nan")])) for _ in range(4000)]
    rows += [("flat", "m", 0.3)] * 50 + [("huge", "m", 3e5), ("huge", "m", 1.0)]
    melted = spark.createDataFrame(rows, "window string, metric string, value double")
    found = [sorted(map(repr, present.summary_stats(frame).collect())) for frame in (
        melted, melted.repartition(1), melted.repartition(7), melted.orderBy("value"))]
    assert all(f == found[0] for f in found)
    by = {r["window"]: r for r in present.summary_stats(melted).collect()}
    for window in ("a", "b"):
        values = [Fraction(v) for w, _, v in rows if w == window and v is not None and v == v]
        mean = sum(values) / len(values)
        assert by[window]["avgValue"] == pytest.approx(float(mean), abs=1e-8)
        assert by[window]["stddevValue"] == pytest.approx(float(sum((v - mean) ** 2 for v in values) / len(values)) ** 0.5, abs=1e-8)
    assert (by["flat"]["avgValue"], by["flat"]["stddevValue"]) == (0.3, 0.0)
    assert (by["huge"]["avgValue"], by["huge"]["stddevValue"]) == (150000.5, 149999.5)


def test_moments_of_parts_add_up(spark):
    melted = spark.createDataFrame([("w", "m", i / 3) for i in range(100)], "window string, metric string, value double")
    whole = present.moments(melted, ("window", "metric")).first()
    parts = [present.moments(p, ("window", "metric")).first() for p in (melted.filter("value < 10"), melted.filter("value >= 10"))]
    for name in ("n", "fitting", "total", "squares"):
        assert whole[name] == parts[0][name] + parts[1][name]
