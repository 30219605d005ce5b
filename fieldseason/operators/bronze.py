"""Long observation table: incremental logic, deletes and quality checks."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldseason.functions.calendar import coverage_pct, coverage_status, expected_days
from fieldseason.functions.columns import named, quoted
from fieldseason.schemas import ELEMENTS

OBSERVATION_KEY = ("stationId", "date", "dataType")

# Fixed values: (element, low, high) in °C and mm; a value outside is implausible.
EXTREME_LIMITS = (("TMAX", -45.0, 55.0), ("TMIN", -55.0, 45.0), ("PRCP", None, 250.0))

YEAR_TEXT = "substring(date, 1, 4)"
YEAR_NUMBER = f"try_cast({YEAR_TEXT} as int)"


# --- incremental update -------------------------------------------------------


def high_water_mark(obs: DataFrame, by: str | None = None) -> DataFrame:
    """Latest date of the table, or of every ``by`` group."""
    return (obs.groupBy(by) if by else obs.groupBy()).agg(F.max("date").alias("maxDate"))


def mark_stations(stations: DataFrame, marks: DataFrame) -> DataFrame:
    """Stations with their mark: per station when the marks are, else the one mark.

    A station that is listed twice has one row. One without any row has no mark of its own; it needs :func:`year_ranges`.
    """
    stations = stations.dropDuplicates(["stationId"])
    if "stationId" in marks.columns:
        return stations.join(marks, "stationId", "left")
    return stations.withColumn("maxDate", marks.select("maxDate").scalar())


def gap_ranges(marked: DataFrame, today: str) -> DataFrame:
    """Date ranges from each station's ``maxDate`` to ``today``, cut at new year.

    Both ends are included. A station whose mark is after ``today`` has no range.
    """
    start, end = "to_date(maxDate)", f"date {quoted(today)}"
    return (
        marked.filter(f"{start} <= {end}")
        .selectExpr("*", f"explode(sequence(year({start}), year({end}))) as year")
        .selectExpr(
            "*",
            f"cast(greatest({start}, make_date(year, 1, 1)) as string) as rangeStart",
            f"cast(least({end}, make_date(year, 12, 31)) as string) as rangeEnd",
        )
        .drop("maxDate")
    )


def year_ranges(stations: DataFrame, first: int, last: int) -> DataFrame:
    """Whole calendar years per station, each station once."""
    return stations.dropDuplicates(["stationId"]).selectExpr("*", f"explode(sequence({first}, {last})) as year").selectExpr(
        "*", "concat(year, '-01-01') as rangeStart", "concat(year, '-12-31') as rangeEnd"
    )


def upsert(
    obs: DataFrame,
    new: DataFrame,
    keys: Sequence[str] = OBSERVATION_KEY,
    on_conflict: str = "replace",
) -> DataFrame:
    """Add rows to a table that may already hold some of their keys.

    ``replace`` lets the new rows win, ``keep`` the stored ones, and ``append`` adds
    everything without looking at keys. Under the first two ``new`` is reduced to one row
    per key, and a null value is no reading: it neither displaces nor blocks one. So a
    reading is added where only nulls are stored, and a null where nothing is. Where the
    date is a key, rows before the first new date cannot conflict and pass by the
    comparison, which then shuffles only the end of a long table.
    """
    if on_conflict == "append":
        return obs.unionByName(new)
    dated = "date" in keys
    if on_conflict == "keep":
        contested = from_first_date(obs, new) if dated else obs
        return obs.unionByName(absent_rows(contested, new, keys))
    if on_conflict == "replace":
        single = one_per_key(new, keys)
        readings, nulls = single.filter("value is not null"), single.filter("value is null")
        contested = from_first_date(obs, new) if dated else obs
        kept = _without_keys(contested, readings, keys)
        if dated:
            kept = before_first_date(obs, new).unionByName(kept)
        return kept.unionByName(readings).unionByName(absent_rows(contested, nulls, keys))
    raise ValueError(f"unknown on_conflict: {on_conflict}")


def one_per_key(new: DataFrame, keys: Sequence[str] = OBSERVATION_KEY) -> DataFrame:
    """One row per key: the largest value that is known, and of equal ones the largest attributes."""
    rest = [c for c in new.columns if c not in keys]
    first = [c for c in ("value", "attributes") if c in rest]
    largest = F.max(F.struct(*first, *[c for c in rest if c not in first])).alias("_largest")
    return new.groupBy(*keys).agg(largest).select(*keys, "_largest.*").select(*new.columns)


def _without_keys(obs: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    return obs.join(new.select(*keys), list(keys), "left_anti").select(*obs.columns)


def _first_date(new: DataFrame) -> Column:
    return new.agg(F.min("date")).scalar()


def from_first_date(obs: DataFrame, new: DataFrame) -> DataFrame:
    """Rows not before the first date of ``new``."""
    return obs.filter(F.col("date") >= _first_date(new))


def before_first_date(obs: DataFrame, new: DataFrame) -> DataFrame:
    """The other rows: also those without a date, and all when ``new`` has none."""
    first, date = _first_date(new), F.col("date")
    return obs.filter((date < first) | date.isNull() | first.isNull())


def absent_rows(
    obs: DataFrame, new: DataFrame, keys: Sequence[str] = OBSERVATION_KEY
) -> DataFrame:
    """Rows of ``new``, one per key, that ``obs`` lacks: readings without a stored reading,
    and nulls without any stored row.

    The stored keys are counted first: that is partial before the shuffle, so a key that
    is stored very often arrives once per task.
    """
    stored = obs.groupBy(*keys).agg(F.count("value").alias("_readings"))
    found = one_per_key(new, keys).join(stored, list(keys), "left")
    return found.filter(
        "_readings is null or (value is not null and _readings = 0)"
    ).select(*new.columns)


def replace_station(obs: DataFrame, new: DataFrame, station_id: str) -> DataFrame:
    """The table with one station's rows replaced; other stations in ``new``, or no row, are an error."""
    require_new(new, station_id)
    return obs.filter(~F.col("stationId").eqNullSafe(station_id)).unionByName(
        only_station(new, station_id)
    )


def require_new(new: DataFrame, station_id: str) -> None:
    """Reads until the first row of ``new``; a replacement by nothing is an error."""
    if new.isEmpty():
        raise ValueError(f"no rows to replace {station_id} with")


def only_station(new: DataFrame, station_id: str) -> DataFrame:
    """``new`` unchanged, failing at run time on a row of another station."""
    foreign = F.concat(F.lit(f"expected only {station_id}, found "), F.col("stationId"))
    checked = F.when(F.col("stationId").eqNullSafe(station_id), F.col("stationId")).otherwise(
        F.raise_error(F.coalesce(foreign, F.lit("station id is null"))).cast("string")
    )
    return new.withColumn("stationId", checked)


# --- deletes ------------------------------------------------------------------


def _outside_month(year_month: str) -> str:
    if not re.fullmatch(r"\d{4}-\d{2}", year_month):
        raise ValueError(f"expected YYYY-MM, got {year_month!r}")
    return f"(date is null or not startswith(date, '{year_month}'))"


def _until(cutoff: str) -> str:
    return f"(date is null or date <= {quoted(cutoff)})"


def _delete_counts(obs: DataFrame, kept: str) -> DataFrame:
    return obs.agg(*named(
        rowsBefore="count(*)", rowsDeleted=f"count_if(not {kept})", rowsRemaining=f"count_if({kept})"
    ))


def delete_month(obs: DataFrame, year_month: str) -> DataFrame:
    """The table without a month's rows. A row without a date stays."""
    return obs.filter(_outside_month(year_month))


def delete_month_counts(obs: DataFrame, year_month: str) -> DataFrame:
    return _delete_counts(obs, _outside_month(year_month))


def trim_after(obs: DataFrame, cutoff: str) -> DataFrame:
    """The table without rows after a date. A row without a date stays."""
    return obs.filter(_until(cutoff))


def trim_after_counts(obs: DataFrame, cutoff: str) -> DataFrame:
    return _delete_counts(obs, _until(cutoff))


# --- quality checks -----------------------------------------------------------


def value_counts_wide(obs: DataFrame, elements: Sequence[str] = ELEMENTS) -> DataFrame:
    """Non-null values per station, year and element, 0 where there are none."""
    return (
        obs.groupBy("stationId", F.expr(YEAR_TEXT).alias("year"))
        .agg(*named(**{e: f"count(case when dataType = {quoted(e)} then value end)" for e in elements}))
        .orderBy("stationId", "year")
    )


def _with_coverage(counted: DataFrame) -> DataFrame:
    expected = expected_days("year")
    return counted.selectExpr(
        "*",
        f"{expected} as expectedDays",
        f"{coverage_pct('activeDays', expected)} as coveragePct",
        f"{coverage_status('activeDays', expected)} as coverageStatus",
    )


def coverage(obs: DataFrame) -> DataFrame:
    """Days with any observation per station and year, against the calendar."""
    return _with_coverage(
        obs.groupBy("stationId", F.expr(YEAR_NUMBER).alias("year")).agg(
            F.count_distinct("date").alias("activeDays")
        )
    )


_DAY_EXTREMES = {
    "tmax": "max(case when dataType = 'TMAX' then value end)",
    "tmin": "max(case when dataType = 'TMIN' then value end)",
}


def temp_inversions(obs: DataFrame) -> DataFrame:
    """Days per station and year whose high is below their low."""
    return (
        obs.filter("dataType in ('TMAX', 'TMIN') and value is not null")
        .groupBy("stationId", "date")
        .agg(*named(**_DAY_EXTREMES))
        .filter("tmax < tmin")
        .groupBy("stationId", F.expr(YEAR_NUMBER).alias("year"))
        .agg(F.count("*").alias("inversions"))
    )


def is_extreme(limits=EXTREME_LIMITS) -> str:
    """A value outside its element's limits, as an expression; false for a null value."""
    cases = []
    for element, low, high in limits:
        outside = [f"value < {low}D"] if low is not None else []
        outside += [f"value > {high}D"] if high is not None else []
        cases.append(f"dataType = {quoted(element)} and ({' or '.join(outside)})")
    return f"coalesce({' or '.join(f'({c})' for c in cases)}, false)"


def extreme_values(obs: DataFrame, limits=EXTREME_LIMITS) -> DataFrame:
    """Values outside their element's limits, per station and year."""
    return (
        obs.filter(is_extreme(limits))
        .groupBy("stationId", F.expr(YEAR_NUMBER).alias("year"))
        .agg(F.count("*").alias("extremeVals"))
    )


def duplicate_keys(obs: DataFrame, keys: Sequence[str] = OBSERVATION_KEY) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return obs.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def duplicate_count(obs: DataFrame, keys: Sequence[str] = OBSERVATION_KEY) -> DataFrame:
    return duplicate_keys(obs, keys).agg(F.count("*").alias("duplicateKeys"))


def bronze_report(obs: DataFrame, limits=EXTREME_LIMITS) -> DataFrame:
    """Coverage, inversions and extreme values, one row per station and year.

    All three checks count days or rows of a station-day, so one pass that first
    reduces to station-days replaces three scans and two joins. Like those joins, it
    finds nothing for rows without a station or a year.
    """
    keyed = "stationId is not null and year is not null"
    days = (
        obs.groupBy("stationId", "date")
        .agg(*named(**_DAY_EXTREMES, extremes=f"count_if({is_extreme(limits)})"))
        .selectExpr("*", f"{YEAR_NUMBER} as year")
    )
    return _with_coverage(
        days.groupBy("stationId", "year").agg(*named(
            activeDays="count(date)",
            inversions=f"count_if({keyed} and tmax < tmin)",
            extremeVals=f"sum(case when {keyed} then extremes else 0 end)",
        ))
    ).select(
        "stationId", "year", "activeDays", "expectedDays", "coveragePct", "coverageStatus",
        "inversions", "extremeVals",
    ).orderBy("stationId", "year")


def bronze_issues(report: DataFrame) -> DataFrame:
    """Report rows with a problem, and the problems in words.

    Fixed values: the texts of the problems.
    """
    sparse, inverted, extreme = "coverageStatus != 'OK'", "inversions > 0", "extremeVals > 0"
    return report.filter(f"{sparse} or {inverted} or {extreme}").selectExpr(
        "stationId", "year",
        f"""concat_ws('; ',
            case when {sparse}
                then concat('coverage=', coveragePct, '% [', coverageStatus, ']') end,
            case when {inverted} then concat(inversions, ' TMAX<TMIN inversions') end,
            case when {extreme} then concat(extremeVals, ' extreme outlier values') end
        ) as issues""",
    )


def issue_count(report: DataFrame) -> DataFrame:
    return bronze_issues(report).agg(F.count("*").alias("issueCount"))


def station_inventory(obs: DataFrame, stations: DataFrame, first: int, last: int) -> DataFrame:
    """Observed days per station and year of the whole range, and the station's total.

    A station that is listed twice has its first name, by order, and the place listed with it.
    """
    places = F.min(F.struct("name", "latitude", "longitude")).alias("place")
    stations = stations.groupBy("id").agg(places).select("id", "place.*")
    counted = (
        # The bounds of the text reach a stored table's scan; the number decides.
        obs.filter(f"date >= '{first}' and date < '{last + 1}' and {YEAR_NUMBER} between {first} and {last}")
        .groupBy(F.col("stationId").alias("id"), F.expr(YEAR_NUMBER).alias("year"))
        .agg(F.count_distinct("date").alias("observed"))
    )
    return (
        stations.selectExpr("*", f"explode(sequence({first}, {last})) as year")
        .join(counted, ["id", "year"], "left")
        .selectExpr(
            "id", "name", "latitude", "longitude", "year",
            "coalesce(observed, 0) as rowCount",
            "coalesce(sum(observed) over (partition by id), 0) as stationTotal",
        )
    )
