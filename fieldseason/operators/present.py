"""Slices, statistics and rows of the season report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldseason.functions.calendar import GROWING_SEASON, MONTHS, PHASES, WINDOWS, CalendarWindow
from fieldseason.functions.columns import named
from fieldseason.functions.numeric import to_fixed
from fieldseason.functions.weather import condition, frost_free, growing_degrees, heat_stress
from fieldseason.operators.gold import METRICS, wide_column

# Metric -> the daily field it is taken from on the daily grain; drought has none.
DAILY_METRICS = {
    "gdd": "dailyGdd",
    "precipIn": "precipIn",
    "frostFreeDays": "frostFreeFlag",
    "heatStressDays": "heatStressFlag",
    "avgTempF": "tempAvgF",
    "snowIn": "snowIn",
}

NO_READING = "--"


def latest_reading(daily: DataFrame, station: str | None = None) -> DataFrame:
    """Newest day with a temperature: one row for a station, or one row per station."""
    newest = F.expr("max(case when tempAvgF is not null then struct(date, tempAvgF) end)")
    if station is None:
        found = daily.groupBy("stationId").agg(newest.alias("newest"))
    else:
        own = daily.filter(F.col("stationId") == station)
        found = own.agg(newest.alias("newest")).withColumn("stationId", F.lit(station))
    return found.selectExpr(
        "stationId",
        "newest.date as date",
        "newest.tempAvgF as tempAvgF",
        f"""case when newest is null then '{NO_READING}'
                 else format_string('%.1f°F', newest.tempAvgF) end as temperature""",
        f"coalesce(date_format(newest.date, 'EEEE, MMM d, yyyy'), '{NO_READING}') as day",
    )


def _years(first: int, last: int | None = None) -> str:
    """Whole calendar years as bounds of the date itself, which reach a stored table's scan."""
    until = "" if last is None else f" and date < make_date({last + 1}, 1, 1)"
    return f"date >= make_date({first}, 1, 1){until}"


def daily_drilldown(daily: DataFrame, station: str | None, from_year: int) -> DataFrame:
    """Days from a year on that are not suspect, with degree days and day flags.

    Days without temperatures stay, for their precipitation and snow.
    """
    own = daily if station is None else daily.filter(F.col("stationId") == station)
    return own.filter(f"qualityFlag != 'SUSPECT' and {_years(from_year)}").selectExpr(
        "*",
        f"{growing_degrees('tempMaxF', 'tempMinF')} as dailyGdd",
        f"{frost_free('tempMinF')} as frostFreeFlag",
        f"{heat_stress('tempMaxF')} as heatStressFlag",
    )


def drop_empty_years(annual: DataFrame) -> DataFrame:
    """Years with any frost-free day, degree day or precipitation in the growing season."""
    return annual.filter("frostFreeDays > 0 or growingDegreeDays > 0 or totalPrecipIn > 0")


def melt_metrics(annual: DataFrame, windows: Sequence[CalendarWindow] = WINDOWS) -> DataFrame:
    """A stored yearly table with a row per window and metric; see ``melt_long`` for rows still long."""
    ids = [c for c in ("stationId", "year") if c in annual.columns]
    cells = [
        f"'{w.key}', '{metric}', cast({wide_column(w.key, metric)} as double)"
        for w in windows
        for metric in METRICS
    ]
    return annual.selectExpr(
        *ids, f"stack({len(cells)}, {', '.join(cells)}) as (window, metric, value)"
    )


def melt_long(long: DataFrame) -> DataFrame:
    """Season rows, any windows, with a row per metric: no detour over the wide table."""
    return _melted(long, ["stationId", "year", "window"], {m: m for m in METRICS})


def melt_daily(drilldown: DataFrame) -> DataFrame:
    """Drill-down days with a row per metric that a day has."""
    return _melted(drilldown, ["stationId", "date"], DAILY_METRICS)


def _melted(df: DataFrame, ids: Sequence[str], metrics: dict[str, str]) -> DataFrame:
    cells = ", ".join(f"'{metric}', cast({column} as double)" for metric, column in metrics.items())
    return df.selectExpr(*ids, f"stack({len(metrics)}, {cells}) as (metric, value)")


def slice_daily(daily: DataFrame, first: int, last: int, window: str = GROWING_SEASON.key) -> DataFrame:
    """Days of a range of years, of one month or crop phase if named."""
    days = daily.filter(_years(first, last))
    if window == GROWING_SEASON.key:
        return days
    months = [w.key for w in MONTHS]
    if window in months:
        return days.filter(f"month = {months.index(window) + 1}")
    if window not in [w.key for w in PHASES]:
        raise ValueError(f"unknown window: {window}")
    return days.filter(window)


def slice_annual(annual: DataFrame, first: int, last: int) -> DataFrame:
    return annual.filter(f"year between {first} and {last}")


def choose_grain(drilldown: DataFrame, first: int, last: int, max_years: int = 5) -> DataFrame:
    """One row: ``daily`` for at most ``max_years`` years of which drill-down days exist, else ``annual``."""
    found = drilldown.filter(_years(first, last)).limit(1)
    short = str(last - first < max_years).lower()
    return found.agg(F.count("*").alias("n")).selectExpr(
        f"{first} as firstYear",
        f"{last} as lastYear",
        f"case when {short} and n > 0 then 'daily' else 'annual' end as grain",
    )


#: Fixed point in which moments are added up, and the size up to which values fit into it.
_STEPS, _FITS = 10**8, 1e5


def moments(melted: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """``n``, sum and sum of squares of each group's values as integers, in steps of ``10 ** -8``.

    Moments of parts of a table add up to those of the whole, whatever the parts and their order;
    null and NaN are skipped. ``plain`` holds the groups' mean and deviation in doubles for groups
    with a value of 100,000 or more, which has no place in the fixed point.
    """
    steps = f"cast(rint(value * {_STEPS}D) as bigint)"
    fits = f"case when abs(value) < {_FITS:.0f}D then {steps} end"
    return melted.filter("value is not null and not isnan(value)").selectExpr(*by, "value", f"{fits} as u").groupBy(*by).agg(*named(
        n="count(*)",
        fitting="count(u)",
        total="sum(cast(u as decimal(18, 0)))",
        squares="sum(cast(cast(u as decimal(18, 0)) * cast(u as decimal(18, 0)) as decimal(28, 0)))",
        minValue="min(value)",
        maxValue="max(value)",
        plain="named_struct('mean', avg(value), 'deviation', stddev_pop(value))",
    ))


def summary_stats(melted: DataFrame, by: tuple[str, ...] = ("window", "metric")) -> DataFrame:
    """Mean, extremes and population deviation of each metric; null and NaN are skipped.

    From integer moments with one division at the end, so the digits do not depend on how rows
    are dealt (but in groups with values of 100,000 or more).
    """
    # Squares about the whole part of the mean, which leaves nothing to cancel.
    centre = "cast(total div n as decimal(20, 0))"
    about = f"(squares - 2 * {centre} * total + {centre} * {centre} * n)"
    rest = f"cast(total - {centre} * n as double)"
    deviation = f"sqrt(greatest(cast({about} as double) - {rest} * {rest} / n, 0D) / n) / {_STEPS}D"
    wide = [f"cast({c} as decimal(38, 0)) as {c}" for c in ("total", "squares", "n")]
    return moments(melted, by).selectExpr(*by, "minValue", "maxValue", "plain", "fitting = n as exact", *wide).selectExpr(
        *by,
        f"case when exact then cast(total as double) / cast(n as double) / {_STEPS}D else plain.mean end as avgValue",
        "minValue", "maxValue",
        f"case when exact then {deviation} else plain.deviation end as stddevValue",
    )


_CONDITION = f"{condition('droughtIndex', 'heatStressDays')} as condition"


def condition_tags(long: DataFrame) -> DataFrame:
    """A tag per station, year and window."""
    return long.selectExpr(
        "stationId", "year", "window", "droughtIndex", "heatStressDays", _CONDITION
    )


def season_table(long: DataFrame, window: str = GROWING_SEASON.key) -> DataFrame:
    """Display rows of one window, newest year first."""
    def shown(metric: str, digits: int) -> str:
        return f"coalesce({to_fixed(metric, digits)}, '—')"

    return (
        long.filter(F.col("window") == window)
        .selectExpr(
            "stationId", "year",
            f"{shown('gdd', 0)} as gdd",
            f"{shown('precipIn', 1)} as precipIn",
            f"{shown('avgTempF', 1)} as avgTempF",
            f"{shown('snowIn', 1)} as snowIn",
            "frostFreeDays", "heatStressDays",
            f"""concat(case when droughtIndex >= 0 then '+' else '' end,
                       {shown('droughtIndex', 3)}) as droughtIndex""",
            _CONDITION,
        )
        .orderBy(F.col("year").desc(), "stationId")
    )


# --- exports ------------------------------------------------------------------


def export_annual(annual: DataFrame, windows: Sequence[CalendarWindow] = WINDOWS) -> DataFrame:
    """One JSON object per yearly row, nulls kept, and its station where the table has one."""
    metrics = [wide_column(w.key, m) for w in windows for m in METRICS]
    ids = [c for c in ("stationId", "year") if c in annual.columns]
    return annual.selectExpr(*ids, _json([*ids, *metrics]))


# Fields of an exported day.
DAY_FIELDS = (
    "date", "tempAvgF", "precipIn", "snowIn", "dailyGdd", "frostFreeFlag", "heatStressFlag",
    "month", *(w.key for w in PHASES),
)


def export_daily(drilldown: DataFrame) -> DataFrame:
    """One JSON object per drill-down day; an unknown phase flag is written as false.

    The rows, not the objects, name the station.
    """
    known = drilldown.fillna(False, subset=[w.key for w in PHASES])
    return known.selectExpr("stationId", "date", _json(DAY_FIELDS))


def _json(columns: Sequence[str]) -> str:
    return f"to_json(struct({', '.join(columns)}), map('ignoreNullFields', 'false')) as json"


def preview(df: DataFrame, *order_by: str, n: int = 100) -> DataFrame:
    """First rows by key."""
    return df.orderBy(*order_by).limit(n)


def sample_table(df: DataFrame, *order_by: str, n: int = 20) -> DataFrame:
    """First rows by key, each with the row count of the whole table."""
    total = df.agg(F.count("*").alias("tableRows"))
    return preview(df, *order_by, n=n).withColumn("tableRows", total.scalar())
