"""Layer compositions. Any layer can start from stored input: each takes DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fieldseason.operators.bronze import trim_after, upsert
from fieldseason.operators.gold import season_weather
from fieldseason.operators.silver import fallback_temperatures, silver_weather
from fieldseason.schemas import OBSERVATIONS
from fieldseason.sources.tables import materialize, read_table, upsert_stored, write_layer


@dataclass(frozen=True)
class Site:
    """The station a season table is made for."""

    station: str
    name: str
    county_fips: str
    state: str
    supplemental: str | None = None
    supplemental_name: str | None = None


def silver_for(obs: DataFrame, site: Site, fallback: DataFrame | None = None) -> DataFrame:
    return silver_weather(
        obs, site.station, site.supplemental, site.name, site.supplemental_name, fallback=fallback
    )


def gold_for(daily: DataFrame, site: Site) -> DataFrame:
    return season_weather(daily, site.county_fips, site.state, site.station)


def refresh(obs: DataFrame, new: DataFrame, site: Site, on_conflict: str = "replace") -> DataFrame:
    """Incremental rows applied by ``upsert``'s rule, then the season table.

    The updated rows are written once, where the daily rows and the medians would each make them.
    """
    return gold_for(silver_for(materialize(upsert(obs, new, on_conflict=on_conflict), "updated"), site), site)


def refresh_stored(
    spark: SparkSession, path: str, new: DataFrame, site: Site, on_conflict: str = "replace",
    partition_by: Sequence[str] = ("stationId",),
) -> DataFrame:
    """The same over a stored table, by the same rule: it is brought up to date, then read again.

    The later layers read files, where ``refresh`` would apply the new rows once for the
    daily rows and once for the medians. Runs its writes when called.
    """
    upsert_stored(new, path, on_conflict, partition_by)
    return gold_for(silver_for(read_table(spark, path, OBSERVATIONS), site), site)


def rebuild(obs: DataFrame, cutoff: str, site: Site) -> DataFrame:
    """The season table as of a date."""
    return gold_for(silver_for(trim_after(obs, cutoff), site), site)


def all_stations_silver(
    obs: DataFrame,
    stations: DataFrame | None = None,
    supplemental: str | None = None,
    supplemental_name: str | None = None,
) -> DataFrame:
    """The daily table with every station as its own anchor.

    The fallback temperatures, one row per date, are written first: the join then
    broadcasts them if their stored size allows it and shuffles both sides if not.
    """
    fallback = materialize(fallback_temperatures(obs, supplemental), "fallback")
    return silver_weather(
        obs, supplemental=supplemental, supplemental_name=supplemental_name,
        fallback=fallback, stations=stations,
    )


def store_layers(
    spark: SparkSession, obs: DataFrame, root: str, county_fips: str, state: str,
    stations: DataFrame | None = None, supplemental: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Write the daily and the season table of all stations, each read back for the next."""
    write_layer(all_stations_silver(obs, stations, supplemental), f"{root}/silver/daily")
    daily = read_table(spark, f"{root}/silver/daily")
    write_layer(season_weather(daily, county_fips, state), f"{root}/gold/season")
    return daily, read_table(spark, f"{root}/gold/season")
