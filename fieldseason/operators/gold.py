"""Season aggregates per station, year and calendar window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldseason.functions.calendar import (
    GROWING_SEASON,
    WINDOWS,
    CalendarWindow,
    YearSegments,
    month_day,
)
from fieldseason.functions.columns import named
from fieldseason.functions.numeric import decimal_value, measured, parts, round_ratio, round_total, whole
from fieldseason.functions.weather import (
    FROST_F,
    GDD_BASE_F,
    GDD_CAP_F,
    HEAT_F,
    frost_free,
    growing_degrees,
    heat_stress,
)

# Metric of the long form -> suffix in the wide table.
METRICS = {
    "gdd": "Gdd",
    "precipIn": "PrecipIn",
    "frostFreeDays": "FrostFreeDays",
    "heatStressDays": "HeatStressDays",
    "droughtIndex": "DroughtIndex",
    "avgTempF": "AvgTempF",
    "snowIn": "SnowIn",
}

# Wide names of the growing season window, which follow no suffix rule.
SEASON_COLUMNS = {
    "gdd": "growingDegreeDays",
    "precipIn": "totalPrecipIn",
    "frostFreeDays": "frostFreeDays",
    "heatStressDays": "extremeHeatDays",
    "droughtIndex": "droughtIndex",
    "avgTempF": "avgTempF",
    "snowIn": "totalSnowIn",
}

BOTH_TEMPERATURES = "tempMaxF is not null and tempMinF is not null"


def wide_column(window: str, metric: str) -> str:
    if window == GROWING_SEASON.key:
        return SEASON_COLUMNS[metric]
    return window + METRICS[metric]


def temp_availability(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Days per year, and how many of them have both temperatures."""
    return (
        daily.groupBy(*by, F.year("date").alias("year"))
        .agg(*named(totalDays="count(*)", tempDays=f"count_if({BOTH_TEMPERATURES})"))
        .selectExpr(
            "*",
            "format_string('%.0f%%', tempDays * 100D / totalDays) as pct",
            # Fixed value: the text of the warning.
            "case when tempDays = 0 then 'NO TEMPERATURE DATA' else '' end as warning",
        )
        .orderBy(*by, "year")
    )


def qualified_days(daily: DataFrame, station: str | None = None) -> DataFrame:
    """Days that are not suspect and have both temperatures."""
    own = daily if station is None else daily.filter(F.col("stationId") == station)
    return own.filter(f"qualityFlag != 'SUSPECT' and {BOTH_TEMPERATURES}")


def with_gdd(daily: DataFrame, base: float = GDD_BASE_F, cap: float = GDD_CAP_F) -> DataFrame:
    return daily.selectExpr("*", f"{growing_degrees('tempMaxF', 'tempMinF', base, cap)} as gdd")


def segment_totals(
    days: DataFrame,
    segments: YearSegments,
    base: float = GDD_BASE_F,
    cap: float = GDD_CAP_F,
    frost: float = FROST_F,
    heat: float = HEAT_F,
) -> DataFrame:
    """Totals per station, year and segment of the year.

    A day is read once however many windows it lies in. Sums are partial before the
    shuffle, so a station with a large share of the days sends a few rows per year
    and task.
    """
    placed = days.selectExpr(
        "stationId", "year(date) as year", f"{month_day('date')} as mmdd", "tempMinF", "tempMaxF",
        f"{growing_degrees('tempMaxF', 'tempMinF', base, cap)} as gdd",
        "coalesce(precipIn, 0D) as precip", "coalesce(snowIn, 0D) as snow", "tempAvgF as temp",
    )
    return placed.groupBy("stationId", "year", F.expr(segments.segment("mmdd")).alias("segment")).agg(
        *named(
            **{name: f"sum({part(m)})" for m in MEASURES for name, part in ((m, whole), (f"{m}Parts", parts))},
            frostFree=f"sum({frost_free('tempMinF', frost)})",
            heat=f"sum({heat_stress('tempMaxF', heat)})",
            tempDays=f"count({measured('temp')})",
        )
    )


#: Measures that are summed: whole units under the name itself, the rest under ``Parts``.
MEASURES = ("gdd", "precip", "snow", "temp")
_SUMMED = (*MEASURES, *(f"{m}Parts" for m in MEASURES), "frostFree", "heat", "tempDays")


def season_long(
    days: DataFrame, windows: Sequence[CalendarWindow] = WINDOWS, **thresholds: float
) -> DataFrame:
    """Metrics per station, year and window, all windows present in every year.

    ``days`` are the qualified days; they give the years. Windows may overlap and a
    wrapping window takes both of its ends from the same calendar year. An empty
    window gives zeros.
    """
    return season_of_totals(segment_totals(days, YearSegments.of(windows), **thresholds), windows)


def season_of_totals(totals: DataFrame, windows: Sequence[CalendarWindow] = WINDOWS) -> DataFrame:
    """``season_long`` from totals per station, year and segment, one row or more of each."""
    segments = YearSegments.of(windows)
    # One exchange by station serves all that follows, also the yearly mean in
    # drought_index: a station has at most (years x segments) rows by now. The first
    # segment of a year lists every window, so that empty ones appear.
    first = "row_number() over (partition by stationId, year order by segment) = 1"
    placed = (
        totals.repartition("stationId")
        .selectExpr("*", f"{first} as opening")
        .selectExpr("*", f"inline({segments.windows_of('segment', 'opening')})")
    )
    summed = placed.groupBy("stationId", "year", "window").agg(*named(**{
        c: f"sum(coalesce({c}, 0) * inside)" for c in _SUMMED
    }))
    rounded = summed.selectExpr("*", f"{_rounded('precip', 2)} as precipCents")
    return drought_index(rounded).selectExpr(
        "stationId", "year", "window",
        f"{decimal_value(_rounded('gdd', 1), 1)} as gdd",
        f"{decimal_value('precipCents', 2)} as precipIn",
        "cast(frostFree as int) as frostFreeDays",
        "cast(heat as int) as heatStressDays",
        f"coalesce({decimal_value(_rounded('temp', 1, 'tempDays'), 1)}, 0D) as avgTempF",
        f"{decimal_value(_rounded('snow', 2), 2)} as snowIn",
        "droughtIndex",
    )


def _rounded(measure: str, digits: int, by: str = "1") -> str:
    return round_total(measure, f"{measure}Parts", digits, by)


def drought_index(
    df: DataFrame, amount: str = "precipCents", by: Sequence[str] = ("stationId", "window")
) -> DataFrame:
    """Relative distance of an integer amount from its mean over the group's rows.

    ``(x - mean) / mean`` to four decimals, as ``(n * x - sum) / sum`` in integers;
    null when the mean is zero. A group holds one row per year. Decimals have room for
    any amount; there are few rows by now.
    """
    group = f"over (partition by {', '.join(by)})"
    wide = "cast({} as decimal(24, 0))".format
    index = decimal_value(round_ratio(f"({wide('_rows * ' + amount)} - {wide('_sum')})", wide("_sum"), 4), 4)
    return df.selectExpr(
        "*", f"sum({amount}) {group} as _sum", f"count({amount}) {group} as _rows"
    ).selectExpr("*", f"{index} as droughtIndex").drop("_sum", "_rows")


def season_wide(
    long: DataFrame, windows: Sequence[CalendarWindow] = WINDOWS
) -> DataFrame:
    """One row per station and year with a column per window and metric.

    The windows of a year are packed into one map of fixed size, because 154
    conditional aggregates would leave generated code.
    """
    entry = f"struct(window, struct({', '.join(METRICS)}))"
    packed = long.groupBy("stationId", "year").agg(
        F.expr(f"map_from_entries(collect_list({entry}))").alias("m")
    )
    by_window = packed.selectExpr(
        "stationId", "year", *[f"m['{w.key}'] as {_packed(w)}" for w in windows]
    )
    return by_window.selectExpr("stationId", "year", *[
        f"{_packed(w)}.{metric} as {wide_column(w.key, metric)}"
        for w in windows
        for metric in METRICS
    ])


def _packed(window: CalendarWindow) -> str:
    return f"w_{window.key}"


def season_weather(
    daily: DataFrame,
    county_fips: str,
    state: str,
    station: str | None = None,
    windows: Sequence[CalendarWindow] = WINDOWS,
) -> DataFrame:
    """The yearly table. With a ``station`` it has one row per year and no station id."""
    wide = season_wide(season_long(qualified_days(daily, station), windows), windows)
    ids = ["stationId", "year"] if station is None else ["year"]
    marked = wide.withColumns({"countyFips": F.lit(county_fips), "stateCode": F.lit(state)})
    return marked.selectExpr(*ids, "countyFips", "stateCode", *wide.columns[2:])


def county_seasons(
    days: DataFrame, counties: DataFrame, windows: Sequence[CalendarWindow] = WINDOWS
) -> DataFrame:
    """The yearly table of every county that has a station, one row per county-year.

    ``counties`` maps ``stationId`` to ``countyFips`` and ``stateCode``, each station once.
    Of a county's stations the one with the smallest id that has the year speaks for it.
    """
    wide = season_wide(season_long(days, windows), windows)
    single = counties.groupBy("stationId").agg(
        F.min(F.struct("countyFips", "stateCode")).alias("c"), F.count("*").alias("n"))
    twice = F.raise_error(F.concat(F.lit("several counties for "), F.col("stationId")))
    mapped = single.select("stationId", F.when(F.col("n") == 1, F.col("c")).otherwise(twice).alias("c"))
    # The first by rank: ranks are cut before the rows are dealt, and wide rows are not aggregated.
    rank = F.row_number().over(Window.partitionBy("year", "c.countyFips", "c.stateCode").orderBy("stationId"))
    placed = wide.join(mapped, "stationId").withColumn("_rank", rank).filter("_rank = 1")
    return placed.select("year", "c.countyFips", "c.stateCode", "stationId", *wide.columns[2:])
