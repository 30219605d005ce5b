import pytest

from fieldseason.operators import crops
from fieldseason.schemas import CROP_STATISTICS


@pytest.fixture
def raw(spark):
    def make(*rows):
        """(year, state, county, commodity, statistic, value)"""
        return spark.createDataFrame(
            [(y, s, "name", c, k, t, "BU", v) for y, s, c, k, t, v in rows], CROP_STATISTICS
        )

    return make


def test_records_pivot_and_parse(raw):
    df = raw(
        ("2012", "NE", "067", "CORN", "YIELD", "180.0"), ("2012", "NE", "067", "CORN", "PRICE RECEIVED", " 4.50"),
        ("2012", "NE", "067", "CORN", "AREA HARVESTED", "1,234"), ("2012", "NE", "067", "WHEAT", "YIELD", "(D)"),
        ("2012", "NE", None, "CORN", "YIELD", "1"), ("2012", None, "067", "CORN", "YIELD", "1"),
        ("2012", "NE", "067", None, "YIELD", "1"), ("2012", "NE", "067", "CORN", None, "1"),
        ("", "NE", "067", "CORN", "YIELD", "7"),
    )
    assert sorted(map(repr, map(tuple, crops.crop_records(df).collect()))) == sorted(map(repr, [
        (2012, "NE", "067", "CORN", 180.0, 4.5, 1234.0), (2012, "NE", "067", "WHEAT", None, None, None),
        (None, "NE", "067", "CORN", 7.0, None, None),
    ]))


def test_revenue_needs_yield_and_price(raw):
    df = raw(
        ("2012", "NE", "067", "CORN", "YIELD", "180.0"), ("2012", "NE", "067", "CORN", "PRICE RECEIVED", "4.50"),
        ("2012", "NE", "067", "WHEAT", "PRICE RECEIVED", "4.50"),
    )
    profit = {r["crop"]: r["revenueUsdAcre"] for r in crops.crop_profitability(crops.crop_records(df)).collect()}
    assert profit == {"Corn": 810.0, "Wheat": None}


def test_optimal_mix(spark):
    profit = spark.createDataFrame(
        [(2012, "067", "NE", "Corn", 300.0), (2012, "067", "NE", "Soybeans", 100.0), (2012, "067", "NE", "Wheat", None),
         (2013, "067", "NE", "Soybeans", 50.0), (2013, "067", "NE", "Corn", 50.0), (2013, "067", "NE", None, 999.0),
         (2014, "067", "NE", "Corn", None)],
        "year int, countyFips string, stateCode string, crop string, revenueUsdAcre double",
    )
    annual = spark.createDataFrame(
        [(2012, "067", "NE", 2000.0)], "year int, countyFips string, stateCode string, growingDegreeDays double"
    )
    found = {r["year"]: r for r in crops.optimal_mix(profit, annual).collect()}
    assert (found[2012]["recommendedCrop"], found[2012]["topCropRevenue"]) == ("Corn", 300.0)
    assert (found[2012]["cornScore"], found[2012]["soybeanScore"], found[2012]["wheatScore"]) == (0.75, 0.25, 0.0)
    assert found[2012]["weatherSummary"]["growingDegreeDays"] == 2000.0
    assert (found[2013]["recommendedCrop"], found[2013]["cornScore"]) == ("Corn", 0.5)
    assert found[2013]["weatherSummary"] is None
    assert found[2014]["recommendedCrop"] is None and found[2014]["cornScore"] is None


def test_require_rows(raw):
    df = raw(("2012", "NE", "067", "CORN", "YIELD", "1"))
    assert crops.require_rows(df, "none") is df
    with pytest.raises(ValueError, match="none"):
        crops.require_rows(df.filter("false"), "none")
