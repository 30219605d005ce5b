"""Daily station table: quality, gap filling, provenance, phases and validation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldseason.functions.calendar import (
    PHASES,
    coverage_pct,
    coverage_status,
    expected_days,
    month_day,
    parse_day,
    season_name,
)
from fieldseason.functions.columns import named, quoted
from fieldseason.functions.weather import fahrenheit, inches, quality_flag, suspect
from fieldseason.schemas import ELEMENTS, TEMPERATURES

# Provenance texts.
POOL_ID, POOL_NAME = "pool_median", "Pool Median"

_QUALITY = {"anySuspect": f"max({suspect('attributes')})", "presentCount": "count(value)"}
_QUALITY_FLAG = f"{quality_flag('anySuspect', 'presentCount')} as qualityFlag"


def _element_values(elements: Sequence[str], prefix: str = "") -> dict[str, str]:
    # max, not first: equal for unique keys and independent of row order otherwise.
    return {prefix + e: f"max(case when dataType = {quoted(e)} then value end)" for e in elements}


def flag_suspect(obs: DataFrame) -> DataFrame:
    return obs.selectExpr("*", f"{suspect('attributes')} as suspect")


def day_quality(obs: DataFrame) -> DataFrame:
    """Suspect flag, number of readings and quality flag per station-day."""
    return (
        obs.groupBy("stationId", "date").agg(*named(**_QUALITY)).selectExpr("*", _QUALITY_FLAG)
    )


def pivot_elements(obs: DataFrame, elements: Sequence[str] = ELEMENTS) -> DataFrame:
    """One row per station-day with a column per element."""
    return obs.groupBy("stationId", "date").agg(*named(**_element_values(elements)))


def day_wide(obs: DataFrame, elements: Sequence[str] = ELEMENTS) -> DataFrame:
    """Elements and quality together: one shuffle, and no join of the two."""
    return (
        obs.filter("stationId is not null and date is not null")
        .groupBy("stationId", "date")
        .agg(*named(**_element_values(elements), **_QUALITY))
        .selectExpr("stationId", "date", *elements, _QUALITY_FLAG)
    )


def pivot_supplemental(obs: DataFrame, station_id: str) -> DataFrame:
    """Temperatures of one station by date, as ``suppTMAX`` and ``suppTMIN``."""
    return (
        obs.filter(F.col("stationId") == station_id)
        .groupBy("date")
        .agg(*named(**_element_values(TEMPERATURES, "supp")))
    )


def has_station(obs: DataFrame, station_id: str) -> DataFrame:
    """One row telling whether the station has any observation."""
    return (
        obs.filter(F.col("stationId") == station_id)
        .limit(1)
        .agg((F.count("*") > 0).alias("present"))
        .select(F.lit(station_id).alias("stationId"), "present")
    )


# --- gap filling --------------------------------------------------------------


_IS_TEMPERATURE = f"dataType in ({', '.join(map(quoted, TEMPERATURES))}) and value is not null"


def _pooled(exclude: Sequence[str]) -> str:
    return f"stationId not in ({', '.join(map(quoted, exclude))})" if exclude else "true"


def _temperature_histogram(
    obs: DataFrame, exclude: Sequence[str], supplemental: str | None
) -> DataFrame:
    """Readings counted per (date, element, value).

    The partial counts are made before the shuffle, so a date that holds a large
    share of all rows arrives as its distinct readings: at the tenth of a degree in
    which the elements are reported, at most some thousands.
    """
    return obs.groupBy(
        "date",
        *named(
            element=f"case when {_IS_TEMPERATURE} then dataType end",
            reading=f"case when {_IS_TEMPERATURE} then value end",
        ),
    ).agg(*named(
        n=f"count_if({_pooled(exclude)})",
        supp=f"max(stationId <=> {quoted(supplemental)})",
    ))


def _by_date(histogram: DataFrame, supplemental: bool) -> DataFrame:
    tiers = {"pool": ("min", "n > 0 and below * 2 >= total")}
    if supplemental:
        tiers["supp"] = ("max", "supp")
    return (
        # The windows and the final grouping all accept a distribution by date.
        histogram.repartition("date")
        .selectExpr(
            "*",
            "sum(n) over (partition by date, element order by reading"
            " rows between unbounded preceding and current row) as below",
            "sum(n) over (partition by date, element) as total",
        )
        .groupBy("date")
        .agg(*named(**{
            f"{tier}{e}": f"{best}(case when element = '{e}' and {chosen} then reading end)"
            for tier, (best, chosen) in tiers.items()
            for e in TEMPERATURES
        }))
    )


def pool_medians(obs: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Lower median of each temperature per date over all stations but ``exclude``.

    Every date of the table has a row; without readings its medians are null. Equal
    readings are counted first, so a date's task holds its different readings only.
    """
    return _by_date(_temperature_histogram(obs, exclude, None), supplemental=False)


def temperature_counts(obs: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """``date, element, reading, n``: how often each temperature was read on each date.

    Counts of two tables add up, and rows taken away count negative, so the counts of a table
    can be kept up to date without reading it again.
    """
    return obs.filter(f"{_IS_TEMPERATURE} and {_pooled(exclude)}").groupBy(
        "date", *named(element="dataType", reading="value")).agg(F.count("*").alias("n"))


def merged_counts(*counts: DataFrame) -> DataFrame:
    """The sum of counts; what is not read any more is left out."""
    return reduce(DataFrame.unionByName, counts).groupBy("date", "element", "reading").agg(
        F.sum("n").alias("n")).filter("n > 0")


def medians_of_counts(counts: DataFrame) -> DataFrame:
    """``pool_medians`` from counted readings, for the dates that have any."""
    return _by_date(counts, supplemental=False)


def fallback_of_counts(counts: DataFrame, obs: DataFrame, supplemental: str | None) -> DataFrame:
    """``fallback_temperatures`` from counted readings and the supplemental station's own rows."""
    supp = pivot_supplemental(obs, supplemental) if supplemental is not None else pivot_supplemental(obs.filter("false"), "")
    return medians_of_counts(counts).join(supp, "date", "full")


def fallback_temperatures(
    obs: DataFrame, supplemental: str | None = None, exclude: Sequence[str] = ()
) -> DataFrame:
    """Pool medians and the supplemental station's readings by date, in one scan.

    One small row per date. A caller that fills a very large table writes this one
    first (see ``plans.layers``), so that the join knows its real size.
    """
    histogram = _temperature_histogram(obs.filter(_IS_TEMPERATURE), exclude, supplemental)
    return _by_date(histogram, supplemental=True)


def fill_temperature(wide: DataFrame, fallback: DataFrame) -> DataFrame:
    """Left join by date: every station-day stays, and no date is added.

    ``maxC`` and ``minC`` take the station's own reading, else the pool's, else the
    supplemental one. Precipitation and snow are never filled.
    """
    return wide.join(fallback, "date", "left").selectExpr(
        "*",
        "coalesce(TMAX, poolTMAX, suppTMAX) as maxC",
        "coalesce(TMIN, poolTMIN, suppTMIN) as minC",
    )


def temp_provenance(
    filled: DataFrame,
    anchor_name: str | None = None,
    supplemental: str | None = None,
    supplemental_name: str | None = None,
) -> DataFrame:
    """Which tier gave the temperatures.

    ``tempSource`` asks for both readings of a tier and is ``mixed`` when no tier
    has both; the station id and name follow the high alone. The anchor's own name is
    taken from an ``anchorName`` column where there is one.
    """
    def by_high(own: str, pool: str, supp: str | None) -> str:
        return (
            f"case when TMAX is not null then {own} when poolTMAX is not null then {quoted(pool)}"
            f" when suppTMAX is not null then {quoted(supp)} end"
        )

    name = "anchorName" if "anchorName" in filled.columns else quoted(anchor_name)
    return filled.selectExpr(
        "*",
        """case when TMAX is not null and TMIN is not null then 'anchor'
                when poolTMAX is not null and poolTMIN is not null then 'pool'
                when suppTMAX is not null and suppTMIN is not null then 'supplemental'
                else 'mixed' end as tempSource""",
        f"{by_high('stationId', POOL_ID, supplemental)} as tempStationId",
        f"{by_high(name, POOL_NAME, supplemental_name)} as tempStationName",
    )


# --- the daily table ----------------------------------------------------------


def to_us_units(filled: DataFrame) -> DataFrame:
    """°F and inches from °C and mm; the average needs both temperatures."""
    return filled.selectExpr(
        "*",
        f"{fahrenheit('maxC')} as tempMaxF",
        f"{fahrenheit('minC')} as tempMinF",
        f"{fahrenheit('(maxC + minC) / 2D')} as tempAvgF",
        f"{inches('PRCP')} as precipIn",
        f"{inches('SNOW')} as snowIn",
        f"{inches('SNWD')} as snowDepthIn",
    )


def classify_days(df: DataFrame) -> DataFrame:
    """Month, season and crop phase flags of a ``date`` column."""
    return df.selectExpr("*", f"{month_day('date')} as mmdd").selectExpr(
        *df.columns,
        "month(date) as month",
        f"{season_name('mmdd')} as season",
        *[f"{w.contains('mmdd')} as {w.key}" for w in PHASES],
    )


def silver_weather(
    obs: DataFrame,
    anchor: str | None = None,
    supplemental: str | None = None,
    anchor_name: str | None = None,
    supplemental_name: str | None = None,
    exclude: Sequence[str] = (),
    fallback: DataFrame | None = None,
    stations: DataFrame | None = None,
) -> DataFrame:
    """The daily table of one anchor station, or of every station when none is given.

    ``fallback`` takes the result of :func:`fallback_temperatures` if it is stored.
    ``stations`` (id, name) gives the anchors' names where there are many of them.
    """
    if fallback is None:
        fallback = fallback_temperatures(obs, supplemental, exclude)
    own = obs if anchor is None else obs.filter(F.col("stationId") == anchor)
    wide = day_wide(own)
    if stations is not None:
        # A station may be listed on several pages: one name each, or its days would multiply.
        names = stations.groupBy(F.col("id").alias("stationId")).agg(F.min("name").alias("anchorName"))
        wide = wide.join(names, "stationId", "left")
    filled = fill_temperature(wide, fallback)
    sourced = temp_provenance(filled, anchor_name, supplemental, supplemental_name)
    return classify_days(to_us_units(sourced).selectExpr(
        "stationId", f"{parse_day('date')} as date",
        "tempMaxF", "tempMinF", "tempAvgF", "precipIn", "snowIn", "snowDepthIn",
        "qualityFlag", "tempSource", "tempStationId", "tempStationName",
    ))


# --- reports ------------------------------------------------------------------


def rows_per_year(df: DataFrame) -> DataFrame:
    """Rows per year of a daily table, or of a season table by its ``year``."""
    year = F.year("date") if "date" in df.columns else F.col("year")
    return (
        df.groupBy(year.alias("year")).agg(F.count("*").alias("rowCount")).orderBy("year")
    )


def silver_validation(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Yearly counts of gaps, sources, flags and implausible values, in one scan.

    ``by`` adds keys, such as the station, in front of the year.
    """
    expected = expected_days("year")
    return (
        daily.groupBy(*by, F.year("date").alias("year"))
        .agg(*named(
            totalRows="count(*)",
            nullTempRows="count_if(tempAvgF is null)",
            srcAnchor="count_if(tempSource = 'anchor')",
            srcPool="count_if(tempSource = 'pool')",
            srcSupplemental="count_if(tempSource = 'supplemental')",
            qfOk="count_if(qualityFlag = 'OK')",
            qfSuspect="count_if(qualityFlag = 'SUSPECT')",
            qfMissing="count_if(qualityFlag = 'MISSING')",
            outInversion="count_if(tempMaxF < tempMinF)",
            outTempMaxHigh="count_if(tempMaxF > 115D)",
            outTempMinLow="count_if(tempMinF < -40D)",
            outPrecipHigh="count_if(precipIn > 6D)",
        ))
        .selectExpr(
            "*",
            f"{expected} as expectedDays",
            f"{coverage_pct('totalRows', expected)} as coveragePct",
            f"{coverage_status('totalRows', expected)} as coverageStatus",
        )
        .orderBy(*by, "year")
    )


# Totals reported over the whole table.
_TOTALS = (
    "totalRows", "nullTempRows", "qfSuspect", "qfMissing",
    "outInversion", "outTempMaxHigh", "outTempMinLow", "outPrecipHigh",
)


def validation_totals(validation: DataFrame) -> DataFrame:
    return validation.agg(*named(**{c: f"coalesce(sum({c}), 0)" for c in _TOTALS}))


def validation_alerts(validation: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Years with low coverage or without temperatures, and what is wrong in words."""
    uncovered, unknown = "coverageStatus != 'OK'", "nullTempRows > 0"
    return validation.filter(f"{uncovered} or {unknown}").selectExpr(
        *by, "year",
        f"""concat_ws('; ',
            case when {uncovered} then concat(
                totalRows, '/', expectedDays, ' days (', coveragePct, '%) [', coverageStatus, ']') end,
            case when {unknown} then format_string(
                '%d/%d rows with null tempAvgF (%.1f%%)',
                nullTempRows, totalRows, nullTempRows * 100D / totalRows) end
        ) as alerts""",
    )
