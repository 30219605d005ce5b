import random
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest

from fieldseason.functions import calendar, crops, numeric, weather
from fieldseason.functions.calendar import CalendarWindow, YearSegments

YEAR_DAYS = [date(2000, 1, 1) + timedelta(days=n) for n in range(366)]


def test_season_and_phase_edges(spark):
    from fieldseason.operators.silver import classify_days

    days = [date(2001, m, d) for m, d in [
        (3, 19), (3, 20), (6, 20), (6, 21), (9, 22), (9, 23), (12, 20), (12, 21),
        (9, 19), (9, 20), (6, 30), (7, 1), (7, 10), (7, 11), (4, 19), (4, 20), (5, 15), (5, 16),
    ]]
    rows = {
        (r["date"].month, r["date"].day): r
        for r in classify_days(spark.createDataFrame([(d,) for d in days], "date date")).collect()
    }
    assert [rows[k]["season"] for k in [
        (3, 19), (3, 20), (6, 20), (6, 21), (9, 22), (9, 23), (12, 20), (12, 21)
    ]] == ["Winter", "Spring", "Spring", "Summer", "Summer", "Autumn", "Autumn", "Winter"]
    assert not rows[9, 19]["wheatGrowing"] and rows[9, 20]["wheatGrowing"]
    assert rows[6, 30]["wheatGrowing"] and not rows[7, 1]["wheatGrowing"]
    assert rows[7, 10]["wheatHarvest"] and not rows[7, 11]["wheatHarvest"]
    assert not rows[4, 19]["cornPlanting"] and rows[4, 20]["cornPlanting"]
    assert rows[5, 15]["cornPlanting"] and not rows[5, 16]["cornPlanting"]


def test_null_day_is_winter_without_phases(spark):
    from fieldseason.operators.silver import classify_days

    row = classify_days(spark.createDataFrame([(None,)], "date date")).first()
    assert row["season"] == "Winter" and row["month"] is None and row["cornGrowing"] is None


@pytest.mark.parametrize("windows", [
    calendar.WINDOWS,
    (CalendarWindow("wrap", 1115, 228), CalendarWindow("leap", 229, 229)),
    (CalendarWindow("year", 101, 1231),),
])
def test_segments_rebuild_every_window(windows):
    segments = YearSegments.of(windows)
    starts = (101, *segments.cuts)
    for day in YEAR_DAYS:
        mmdd = day.month * 100 + day.day
        start = max(s for s in starts if s <= mmdd)
        for window in windows:
            assert window.holds(start) == window.holds(mmdd), (window, day)


def test_segment_expression(spark):
    segments = YearSegments.of(calendar.WINDOWS)
    days = spark.createDataFrame([(d.month * 100 + d.day,) for d in YEAR_DAYS], "mmdd int")
    for row in days.selectExpr("mmdd", f"{segments.segment('mmdd')} as s").collect():
        assert row["s"] == sum(cut <= row["mmdd"] for cut in segments.cuts)


@pytest.mark.parametrize("year,days", [(1900, 365), (2000, 366), (2004, 366), (2001, 365)])
def test_expected_days(evaluate, year, days):
    assert evaluate(calendar.expected_days("y"), y=str(year)) == days


@pytest.mark.parametrize("text,day", [
    ("'2000-02-29'", date(2000, 2, 29)), ("'2001-02-29'", None), ("'2020-13-40'", None),
    ("''", None), ("'2020-1-01'", None), ("cast(null as string)", None),
])
def test_parse_day(evaluate, text, day):
    assert evaluate(calendar.parse_day("t"), t=text) == day


@pytest.mark.parametrize("days,expected,status", [
    (50, 100, "INCOMPLETE"), (49, 100, "SPARSE"), (89, 100, "INCOMPLETE"), (90, 100, "OK"),
])
def test_coverage_status_at_its_limits(evaluate, days, expected, status):
    assert evaluate(calendar.coverage_status("d", "e"), d=str(days), e=str(expected)) == status


def test_round_ratio_is_exact(spark):
    pairs = [
        (n, d) for n in (-12345, -1005, -5, -1, 0, 1, 5, 15, 25, 1005, 12345, 98765432)
        for d in (-7, -2, 1, 2, 3, 10, 16, 366, 1000)
    ]
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    for digits in (0, 1, 2, 4):
        text = numeric.round_ratio("n", "d", digits)
        for row in df.selectExpr("*", f"{text} as r").collect():
            exact = abs(Fraction(row["n"], row["d"])) * 10**digits
            rounded = int(exact + Fraction(1, 2))
            sign = -1 if row["n"] * row["d"] < 0 else 1
            assert row["r"] == sign * rounded, (row, digits)


def test_round_ratio_of_zero_denominator(evaluate):
    assert evaluate(numeric.round_ratio("n", "d", 2), n="5L", d="0L") is None


def test_whole_and_parts(evaluate):
    both = lambda v: (evaluate(numeric.whole("v"), v=v), evaluate(numeric.parts("v"), v=v))
    assert both("0.1D + 0.2D") == (0, 300_000_000_000)
    assert both("-3.25D") == (-4, 750_000_000_000)
    assert both("1e9D") == (10**9, 0)
    for nothing in ("cast(null as double)", "double('NaN')", "double('Infinity')", "-1e12D", "1e300D"):
        assert both(nothing) == (None, None)


def test_round_total_against_fractions(spark):
    rng, rows = random.Random(8), []
    for _ in range(3000):
        units = rng.choice([0, rng.randrange(-500, 500), rng.randrange(-10**14, 10**14)])
        rest = rng.choice([0, rng.randrange(0, 400 * 10**12), 5 * 10**rng.randrange(6, 12), 10**12 - 1])
        rows.append((units, rest, rng.choice([1, 2, 7, 366, 100_000])))
    rows.append((5, 1, 0))
    df = spark.createDataFrame(rows, "units long, rest long, by long")
    for digits in (1, 2):
        for row in df.selectExpr("*", f"{numeric.round_total('units', 'rest', digits, 'by')} as r").collect():
            if not row["by"]:
                assert row["r"] is None
                continue
            exact = Fraction(row["units"] * 10**12 + row["rest"], 10**12 * row["by"]) * 10**digits
            size = abs(exact)
            rounded = int(size) + (size - int(size) >= Fraction(1, 2))
            assert row["r"] == (-rounded if exact < 0 else rounded), (row, digits)


def test_to_fixed_follows_the_binary_value(spark):
    values = [0.5, 1.5, 2.5, -2.5, 12.25, 12.35, 0.15, 1.005, -0.04, 1234567.875, 0.0625, -0.0005]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 1, 3):
        for row in df.selectExpr("v", f"{numeric.to_fixed('v', digits)} as t").collect():
            exact = Decimal(row["v"]).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)
            assert row["t"] == f"{exact:.{digits}f}", (row, digits)


@pytest.mark.parametrize("attributes,flag", [
    ("cast(null as string)", False), ("''", False), ("'a'", False), ("',,S'", False),
    ("', ,S'", False), ("',X,S'", True), ("',X'", True), ("'a,b'", True),
])
def test_suspect(evaluate, attributes, flag):
    assert evaluate(weather.suspect("a"), a=attributes) is flag


@pytest.mark.parametrize("tmax,tmin,gdd", [
    (86.0, 50.0, 18.0), (100.0, 40.0, 18.0), (40.0, 30.0, 0.0), (70.0, 60.0, 15.0), (90.0, 90.0, 38.0),
])
def test_growing_degrees(evaluate, tmax, tmin, gdd):
    assert evaluate(weather.growing_degrees("x", "n"), x=f"{tmax}D", n=f"{tmin}D") == gdd


def test_growing_degrees_needs_both_temperatures(evaluate):
    null = "cast(null as double)"
    assert evaluate(weather.growing_degrees("x", "n"), x="90D", n=null) is None
    assert evaluate(weather.growing_degrees("x", "n"), x=null, n="60D") is None


def test_day_thresholds_are_strict(evaluate):
    assert evaluate(weather.frost_free("t"), t="32D") == 0
    assert evaluate(weather.frost_free("t"), t="32.1D") == 1
    assert evaluate(weather.heat_stress("t"), t="95D") == 0
    assert evaluate(weather.heat_stress("t"), t="95.1D") == 1
    assert evaluate(weather.frost_free("t"), t="cast(null as double)") == 0


@pytest.mark.parametrize("drought,heat,tag", [
    ("-0.21D", "0", "Stress"), ("-0.2D", "0", "Watch"), ("0D", "21", "Stress"), ("0D", "20", "Watch"),
    ("0D", "10", "Normal"), ("cast(null as double)", "0", "Normal"), ("-0.01D", "0", "Watch"),
])
def test_condition(evaluate, drought, heat, tag):
    assert evaluate(weather.condition("d", "h"), d=drought, h=heat) == tag


@pytest.mark.parametrize("name,crop", [
    ("CORN", "Corn"), ("corn", "Corn"), ("SOYBEANS", "Soybeans"), ("SOYBEAN", "Soybeans"),
    ("WHEAT", "Wheat"), (" wheat ", "Wheat"), ("COTTON", None), ("", None),
])
def test_normalise_crop(evaluate, name, crop):
    assert evaluate(crops.normalise_crop("n"), n=f"'{name}'") == crop


@pytest.mark.parametrize("text,value", [
    ("'(D)'", None), ("' (Z) '", None), ("'(NA)'", None), ("''", None), ("cast(null as string)", None),
    ("'1,234.5'", 1234.5), ("'56.8'", 56.8), ("' 56.8 '", 56.8), ("'1,234,567'", 1234567.0), ("'x'", None),
])
def test_parse_statistic(evaluate, text, value):
    assert evaluate(crops.parse_statistic("t"), t=text) == value
