import pytest
from pyspark.sql import functions as F

from fieldseason.operators import bronze
from fieldseason.schemas import OBSERVATIONS
from fieldseason.sources import fixtures


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=repr)


def test_coverage_counts_days_not_rows(obs):
    df = obs(
        ("A", "2000-01-01", "TMAX", 1.0), ("A", "2000-01-01", "TMIN", None),
        ("A", "2000-01-02", "TMAX", 1.0), ("A", "bad", "TMAX", 1.0),
    )
    found = {r["year"]: r for r in bronze.coverage(df).collect()}
    assert found[2000]["activeDays"] == 2 and found[2000]["expectedDays"] == 366
    assert found[2000]["coveragePct"] == 0.5 and found[2000]["coverageStatus"] == "SPARSE"
    unknown = found[None]
    assert (unknown["activeDays"], unknown["expectedDays"], unknown["coverageStatus"]) == (1, None, "OK")


def test_inversions_need_both_values(obs):
    df = obs(
        ("A", "2000-01-01", "TMAX", 1.0), ("A", "2000-01-01", "TMIN", 2.0),
        ("A", "2000-01-02", "TMAX", 1.0), ("A", "2000-01-02", "TMIN", None),
        ("A", "2000-01-03", "TMAX", 2.0), ("A", "2000-01-03", "TMIN", 2.0),
    )
    assert rows(bronze.temp_inversions(df)) == [("A", 2000, 1)]


def test_extreme_limits_are_strict(obs):
    df = obs(
        ("A", "2000-01-01", "TMAX", 55.0), ("A", "2000-01-02", "TMAX", 55.1),
        ("A", "2000-01-03", "TMIN", -55.1), ("A", "2000-01-04", "PRCP", 250.0),
        ("A", "2000-01-05", "PRCP", 251.0), ("A", "2000-01-06", "SNOW", 9999.0),
    )
    assert rows(bronze.extreme_values(df)) == [("A", 2000, 3)]


def test_report_agrees_with_its_single_checks(spark, sf, obs):
    limits = (("TMAX", -3.0, 44.0), ("TMIN", -9.0, 14.0), ("PRCP", None, 45.0))
    odd = obs(
        ("A", "bad", "TMAX", -40.0), ("A", "bad", "TMIN", 40.0), ("A", None, "TMAX", 99.0),
        (None, "2000-01-01", "TMAX", 99.0),
    )
    df = fixtures.observations(spark, sf).unionByName(odd)
    keys = ["stationId", "year"]
    joined = (
        bronze.coverage(df)
        .join(bronze.temp_inversions(df), keys, "left")
        .join(bronze.extreme_values(df, limits), keys, "left")
        .fillna(0, ["inversions", "extremeVals"])
    )
    report = bronze.bronze_report(df, limits)
    assert rows(report) == rows(joined.select(*report.columns))


def test_issues_list_only_what_is_wrong(spark):
    report = spark.createDataFrame(
        [("A", 2000, 49.9, "SPARSE", 0, 2), ("A", 2001, 100.0, "OK", 3, 0), ("A", 2002, 95.0, "OK", 0, 0)],
        "stationId string, year int, coveragePct double, coverageStatus string,"
        " inversions bigint, extremeVals bigint",
    )
    assert rows(bronze.bronze_issues(report)) == [
        ("A", 2000, "coverage=49.9% [SPARSE]; 2 extreme outlier values"),
        ("A", 2001, "3 TMAX<TMIN inversions"),
    ]
    assert bronze.issue_count(report).first()["issueCount"] == 2


def test_gap_ranges_cut_at_new_year(spark):
    marked = spark.createDataFrame(
        [("A", "1999-12-31"), ("B", "2001-02-03"), ("C", "2001-02-04")],
        "stationId string, maxDate string",
    )
    assert rows(bronze.gap_ranges(marked, "2001-02-03")) == [
        ("A", 1999, "1999-12-31", "1999-12-31"),
        ("A", 2000, "2000-01-01", "2000-12-31"),
        ("A", 2001, "2001-01-01", "2001-02-03"),
        ("B", 2001, "2001-02-03", "2001-02-03"),
    ]


def test_year_ranges(spark):
    stations = spark.createDataFrame([("A",)], "stationId string")
    assert rows(bronze.year_ranges(stations, 2000, 2001)) == [
        ("A", 2000, "2000-01-01", "2000-12-31"), ("A", 2001, "2001-01-01", "2001-12-31"),
    ]


def test_upsert_leaves_no_duplicate_and_is_repeatable(obs):
    old = obs(("A", "2000-01-01", "TMAX", 1.0), ("A", "2000-01-02", "TMAX", 2.0))
    new = obs(("A", "2000-01-02", "TMAX", 5.0), ("A", "2000-01-03", "TMAX", 3.0))
    once = bronze.upsert(old, new)
    assert rows(once, "date", "value") == [("2000-01-01", 1.0), ("2000-01-02", 5.0), ("2000-01-03", 3.0)]
    assert rows(bronze.upsert(once, new)) == rows(once)
    assert bronze.duplicate_count(once).first()["duplicateKeys"] == 0
    kept = bronze.upsert(old, new, on_conflict="keep")
    assert rows(kept, "date", "value") == [("2000-01-01", 1.0), ("2000-01-02", 2.0), ("2000-01-03", 3.0)]
    appended = bronze.upsert(old, new, on_conflict="append")
    assert bronze.duplicate_count(appended).first()["duplicateKeys"] == 1
    with pytest.raises(ValueError):
        bronze.upsert(old, new, on_conflict="other")


@pytest.mark.parametrize("mode", ["replace", "keep"])
def test_upsert_keeps_earlier_and_undated_rows(obs, mode):
    old = obs(("A", None, "TMAX", 1.0), ("A", "1999-01-01", "TMAX", 2.0), ("A", "2000-01-02", "TMAX", 3.0))
    new = obs(("A", "2000-01-02", "TMIN", 4.0), ("A", None, "TMAX", 5.0))
    found = bronze.upsert(old, new, on_conflict=mode)
    assert sorted(r["value"] for r in found.collect()) == [1.0, 2.0, 3.0, 4.0, 5.0]
    nothing = bronze.upsert(old, new.filter("false"), on_conflict=mode)
    assert sorted(r["value"] for r in nothing.collect()) == [1.0, 2.0, 3.0]
    undated = bronze.upsert(old, new.filter("date is null"), on_conflict=mode)
    assert sorted(r["value"] for r in undated.collect()) == [1.0, 2.0, 3.0, 5.0]


@pytest.mark.parametrize("mode", ["replace", "keep"])
def test_upsert_null_neither_blocks_nor_displaces_a_reading(obs, mode):
    old = obs(("A", "2000-01-01", "TMAX", None), ("A", "2000-01-02", "TMAX", 9.0), ("A", "2000-01-03", "TMAX", None))
    new = obs(("A", "2000-01-01", "TMAX", 9.0), ("A", "2000-01-02", "TMAX", None), ("A", "2000-01-03", "TMAX", None),
              ("A", "2000-01-04", "TMAX", None), ("A", "2000-01-04", "TMAX", None))
    found = rows(bronze.upsert(old, new, on_conflict=mode), "date", "value")
    assert {(d, v) for d, v in found if v is not None} == {("2000-01-01", 9.0), ("2000-01-02", 9.0)}
    assert [d for d, v in found if v is None and d > "2000-01-02"] == ["2000-01-03", "2000-01-04"]


@pytest.mark.parametrize("mode", ["replace", "keep"])
def test_upsert_takes_one_row_of_a_repeated_new_key(obs, mode):
    new = obs(("A", "2000-01-01", "TMAX", 1.0), ("A", "2000-01-01", "TMAX", 3.0), ("A", "2000-01-01", "TMAX", None))
    old = obs(("B", "2000-01-01", "TMAX", 2.0))
    assert rows(bronze.upsert(old, new, on_conflict=mode), "value") == [(2.0,), (3.0,)]


def test_replacing_a_station_by_nothing_is_an_error(obs):
    old = obs(("A", "2000-01-01", "TMAX", 1.0))
    with pytest.raises(ValueError):
        bronze.replace_station(old, old.filter("false"), "A")


def test_upsert_on_other_keys(obs):
    old = obs(("A", "2000-01-01", "TMAX", 1.0), ("B", "2000-01-01", "TMAX", 2.0))
    new = obs(("A", "2001-01-01", "TMAX", 3.0))
    assert rows(bronze.upsert(old, new, ["stationId"]), "value") == [(2.0,), (3.0,)]
    assert rows(bronze.upsert(old, new, ["stationId"], "keep"), "value") == [(1.0,), (2.0,)]


def test_upsert_with_a_key_that_holds_a_third_of_the_rows(spark):
    hot = spark.range(30000).selectExpr(
        "if(id % 3 = 0, 'H', concat('S', id)) as stationId", "'2000-01-01' as date",
        "'TMAX' as dataType", "cast(id as double) as value", "cast(null as string) as attributes",
    )
    new = spark.createDataFrame(
        [("H", "2000-01-01", "TMAX", -1.0, None), ("N", "2000-01-01", "TMAX", -2.0, None)], OBSERVATIONS
    )
    assert bronze.upsert(hot, new).count() == 20002
    assert bronze.upsert(hot, new, on_conflict="keep").count() == 30001


def test_deletes_keep_rows_without_a_date(obs):
    df = obs(
        ("A", "2000-05-01", "TMAX", 1.0), ("A", "2000-06-01", "TMAX", 1.0), ("A", None, "TMAX", 1.0)
    )
    assert rows(bronze.delete_month(df, "2000-05").select(F.coalesce("date", F.lit("")))) == [
        ("",), ("2000-06-01",)
    ]
    assert rows(bronze.delete_month_counts(df, "2000-05")) == [(3, 1, 2)]
    assert rows(bronze.trim_after(df, "2000-05-01").select(F.coalesce("date", F.lit("")))) == [
        ("",), ("2000-05-01",)
    ]
    assert rows(bronze.trim_after_counts(df, "2000-05-01")) == [(3, 1, 2)]


@pytest.mark.parametrize("month", ["2000-5", "2000-05-01", "", "2000-05' or '1'='1"])
def test_delete_month_checks_its_argument(obs, month):
    with pytest.raises(ValueError):
        bronze.delete_month(obs(("A", "2000-05-01", "TMAX", 1.0)), month)


def test_replace_station_is_repeatable_and_rejects_others(obs):
    df = obs(("A", "2000-01-01", "TMAX", 1.0), ("B", "2000-01-01", "TMAX", 2.0))
    new = obs(("A", "2000-02-01", "TMAX", 9.0))
    once = bronze.replace_station(df, new, "A")
    assert rows(once, "stationId", "value") == [("A", 9.0), ("B", 2.0)]
    assert rows(bronze.replace_station(once, new, "A")) == rows(once)
    with pytest.raises(Exception, match="expected only A, found B"):
        bronze.replace_station(df, obs(("B", "2000-02-01", "TMAX", 9.0)), "A").collect()


def test_value_counts_show_zero(obs):
    df = obs(("A", "2000-01-01", "TMAX", 1.0), ("A", "2000-01-01", "PRCP", None))
    assert rows(bronze.value_counts_wide(df)) == [("A", "2000", 1, 0, 0, 0, 0)]


def test_inventory_fills_the_range(obs, spark):
    stations = spark.createDataFrame(
        [("A", "a", 1.0, 2.0), ("B", "b", 1.0, 2.0)],
        "id string, name string, latitude double, longitude double",
    )
    df = obs(("A", "2000-01-01", "TMAX", 1.0), ("A", "2000-01-01", "TMIN", 1.0),
             ("A", "2001-01-01", "TMIN", 1.0), ("A", "1999-01-01", "TMIN", 1.0))
    assert rows(bronze.station_inventory(df, stations, 2000, 2001), "id", "year", "rowCount", "stationTotal") == [
        ("A", 2000, 1, 2), ("A", 2001, 1, 2), ("B", 2000, 0, 0), ("B", 2001, 0, 0),
    ]
