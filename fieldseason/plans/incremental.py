"""Stored layers that are kept up to date by what changed.

A ``Store`` is a folder with four tables, each partitioned by the month of the day:

- ``bronze``: the observations;
- ``counts``: how often each temperature was read on each date, from which pool medians follow;
- ``silver``: the daily table of all stations;
- ``totals``: season totals per station, year and segment of the year. Segments end with months.

An update goes through them key by key. New rows change some observations; what was taken away and
added changes the counts; dates whose medians (or supplemental readings) come out different change
the station-days that lack a reading of their own; changed station-days change their months'
totals. Each table is read and rewritten in the touched months alone. The season table, whose
drought index compares all years of a station, is made from the totals when it is read.

All new partitions are written aside before any is put in place, and a journal tells which update
is ready and which is in place. ``apply_update`` first completes what an interrupted one left, and
putting in place can be repeated, so the tables never stay between two states.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldseason.functions.calendar import WINDOWS, YearSegments, parse_day
from fieldseason.operators.bronze import OBSERVATION_KEY, upsert
from fieldseason.operators.gold import qualified_days, season_of_totals, season_wide, segment_totals
from fieldseason.operators.silver import (
    fallback_of_counts,
    medians_of_counts,
    merged_counts,
    silver_weather,
    temperature_counts,
)
from fieldseason.schemas import COUNTS, DAILY, JOURNAL, OBSERVATIONS, SEGMENT_TOTALS
from fieldseason.sources.tables import (
    append_layer,
    find_table,
    in_partitions,
    materialize,
    overwrite_partitions,
    partition_values,
    placed,
    read_partitioned,
    write_layer,
)

MONTH = ("yearMonth",)
_SCHEMAS = {"bronze": OBSERVATIONS, "counts": COUNTS, "silver": DAILY, "totals": SEGMENT_TOTALS}
_DAY = f"{parse_day('date')} as day"


@dataclass(frozen=True)
class Store:
    """Where the layers are, and how gaps in temperatures are filled."""

    root: str
    supplemental: str | None = None
    supplemental_name: str | None = None
    exclude: tuple[str, ...] = ()

    def path(self, layer: str) -> str:
        return f"{self.root}/{layer}"

    def read(self, spark: SparkSession, layer: str, months: Sequence[tuple] | None = None) -> DataFrame:
        """A layer, or its rows of some months: those partitions alone are read."""
        table = read_partitioned(spark, self.path(layer), _SCHEMAS[layer], MONTH)
        return table if months is None else in_partitions(table, months, MONTH)


def _silver(store: Store, obs: DataFrame, fallback: DataFrame, stations: DataFrame | None) -> DataFrame:
    return silver_weather(obs, supplemental=store.supplemental, supplemental_name=store.supplemental_name,
                          fallback=fallback, stations=stations)


def _by_month(daily: DataFrame) -> DataFrame:
    return daily.withColumn("yearMonth", F.date_format("date", "yyyy-MM"))


def _totals(daily: DataFrame) -> DataFrame:
    """Totals of the qualified days, and a row without days for each station-month.

    The latter keeps a month's partition in being when its last qualified day goes.
    """
    segments = YearSegments.of(WINDOWS)
    found = segment_totals(qualified_days(daily), segments).withColumn("days", F.lit(1))
    months = daily.select("stationId", "yearMonth").distinct()
    # A segment lies in one month, so the month follows from the segment.
    starts = (101, *segments.cuts)
    month = F.expr("case " + " ".join(f"when segment = {n} then {start // 100}" for n, start in enumerate(starts)) + " end")
    found = found.withColumn("yearMonth", F.when(month.isNotNull(), F.format_string("%04d-%02d", "year", month)))
    return found.unionByName(months.withColumn("days", F.lit(0)), allowMissingColumns=True).select(
        *SEGMENT_TOTALS.names, "yearMonth")


def create(spark: SparkSession, store: Store, obs: DataFrame, stations: DataFrame | None = None) -> None:
    """All layers from all observations. Needs an unused folder."""
    write_layer(obs.select(*OBSERVATIONS.names), store.path("bronze"), MONTH)
    bronze = store.read(spark, "bronze")
    write_layer(temperature_counts(bronze, store.exclude), store.path("counts"), MONTH)
    fallback = materialize(fallback_of_counts(store.read(spark, "counts"), bronze, store.supplemental), "fallback")
    write_layer(_by_month(_silver(store, bronze, fallback, stations)), store.path("silver"), MONTH)
    write_layer(_totals(store.read(spark, "silver")), store.path("totals"), MONTH)


def changed_rows(store: Store, spark: SparkSession, new: DataFrame, on_conflict: str) -> tuple[DataFrame, DataFrame]:
    """The rows that have a key of ``new`` once it is applied, and what that adds (``n`` above 0) or takes away."""
    months = partition_values(placed(new, MONTH), MONTH)
    keys = materialize(new.select(*OBSERVATION_KEY).distinct(), "keys")
    before = store.read(spark, "bronze", months).join(keys, list(OBSERVATION_KEY), "left_semi").select(*OBSERVATIONS.names)
    before = materialize(before, "contested")
    after = materialize(upsert(before, new.select(*OBSERVATIONS.names), on_conflict=on_conflict), "merged")
    both = before.withColumn("n", F.lit(-1)).unionByName(after.withColumn("n", F.lit(1)))
    changes = both.groupBy(*OBSERVATIONS.names).agg(F.sum("n").alias("n")).filter("n <> 0")
    return after, materialize(changes, "changes")


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list:
    return [left[k].eqNullSafe(right[k]) for k in keys]


def changed_dates(store: Store, before: DataFrame, after: DataFrame, changes: DataFrame) -> DataFrame:
    """The dates whose pool medians, or whose supplemental readings, are not what they were."""
    dates = changes.filter("dataType in ('TMAX', 'TMIN')").select("date").distinct()
    old, new = (medians_of_counts(c.join(dates, "date", "left_semi")) for c in (before, after))
    old = old.select("date", F.col("poolTMAX").alias("a"), F.col("poolTMIN").alias("b"))
    other = old.join(new, "date", "full").filter("not (a <=> poolTMAX and b <=> poolTMIN)").select("date")
    supp = changes.filter(F.col("stationId") == F.lit(store.supplemental)).filter("dataType in ('TMAX', 'TMIN')")
    return other.union(supp.select("date")).distinct()


def apply_update(
    spark: SparkSession, store: Store, new: DataFrame, on_conflict: str = "replace", stations: DataFrame | None = None,
) -> dict[str, list[str | None]]:
    """``new`` applied by ``bronze.upsert``'s rule, and all that follows from it. Returns the months rewritten, layer by layer."""
    recover(spark, store)
    after, changes = changed_rows(store, spark, new, on_conflict)
    months = partition_values(placed(changes, MONTH), MONTH)
    if not months:
        return {layer: [] for layer in _SCHEMAS}
    update = uuid.uuid4().hex
    aside = Store(f"{store.root}/updates/{update}", store.supplemental, store.supplemental_name, store.exclude)

    # Observations: rows without a key of the new ones stay as they are.
    keys = new.select(*OBSERVATION_KEY).distinct()
    rest = store.read(spark, "bronze", months).select(*OBSERVATIONS.names).join(keys, list(OBSERVATION_KEY), "left_anti")
    merged = placed(rest.select(*OBSERVATIONS.names).unionByName(after), MONTH)
    write_layer(in_partitions(merged, months, MONTH), aside.path("bronze"), MONTH)
    bronze = aside.read(spark, "bronze")

    # Counts: added to, never made again from the observations.
    pooled = changes.filter("value is not null and dataType in ('TMAX', 'TMIN')")
    if store.exclude:
        pooled = pooled.filter(~F.col("stationId").isin(*store.exclude))
    delta = pooled.select("date", F.col("dataType").alias("element"), F.col("value").alias("reading"), "n")
    before = store.read(spark, "counts", months).select(*COUNTS.names)
    write_layer(merged_counts(before, delta), aside.path("counts"), MONTH)
    counts = aside.read(spark, "counts")

    # Station-days: the changed ones, and those that take a temperature from a date's pool that changed.
    dates = changed_dates(store, before, counts.select(*COUNTS.names), changes).selectExpr(_DAY).distinct()
    silver = store.read(spark, "silver", months)
    lacking = silver.filter("tempSource <> 'anchor'").selectExpr("stationId", "date as day")
    lacking = lacking.join(dates, lacking["day"].eqNullSafe(dates["day"]), "left_semi")
    own = changes.filter("stationId is not null and date is not null").selectExpr("stationId", _DAY)
    touched = materialize(own.union(lacking).distinct(), "days")
    read_again = bronze.selectExpr("*", _DAY)
    read_again = read_again.join(touched, _same(read_again, touched, ("stationId", "day")), "left_semi")
    fallback = fallback_of_counts(counts.select(*COUNTS.names), bronze, store.supplemental)
    made = _by_month(_silver(store, read_again.select(*OBSERVATIONS.names), fallback, stations))
    kept = silver.join(touched, [silver["stationId"] == touched["stationId"], silver["date"].eqNullSafe(touched["day"])], "left_anti")
    write_layer(kept.unionByName(made), aside.path("silver"), MONTH)

    # Totals of the station-months that hold those days.
    daily, totals = aside.read(spark, "silver"), store.read(spark, "totals", months)
    held = touched.select("stationId", F.date_format("day", "yyyy-MM").alias("yearMonth")).distinct()
    again = daily.join(held, _same(daily, held, ("stationId", "yearMonth")), "left_semi")
    kept = totals.join(held, _same(totals, held, ("stationId", "yearMonth")), "left_anti")
    write_layer(kept.unionByName(_totals(again)), aside.path("totals"), MONTH)

    written = {layer: [m for m, in partition_values(aside.read(spark, layer), MONTH)] for layer in _SCHEMAS}
    _note(spark, store, update, "ready")
    _publish(spark, store, update)
    return written


def _note(spark: SparkSession, store: Store, update: str, state: str) -> None:
    append_layer(spark.createDataFrame([(update, state)], JOURNAL).coalesce(1), store.path("journal"))


def _publish(spark: SparkSession, store: Store, update: str) -> None:
    aside = Store(f"{store.root}/updates/{update}")
    for layer in _SCHEMAS:
        overwrite_partitions(aside.read(spark, layer), store.path(layer), MONTH)
    _note(spark, store, update, "done")


def recover(spark: SparkSession, store: Store) -> list[str]:
    """Put in place what an interrupted update had ready; its name, if there was one."""
    journal = find_table(spark, store.path("journal"), JOURNAL)
    if journal is None:
        return []
    # A row or two for each update there was.
    states = journal.groupBy("update").agg(F.max((F.col("state") == "done").cast("int")).alias("done"))
    open_ = sorted(r["update"] for r in states.filter("done = 0").collect())
    for update in open_:
        _publish(spark, store, update)
    return open_


def daily(spark: SparkSession, store: Store) -> DataFrame:
    """The daily table of all stations."""
    return store.read(spark, "silver").select(*DAILY.names)


def pool_medians(spark: SparkSession, store: Store) -> DataFrame:
    """Pool medians from the stored counts; no observation is read."""
    return medians_of_counts(store.read(spark, "counts").select(*COUNTS.names))


def season_long(spark: SparkSession, store: Store) -> DataFrame:
    """The season table in long form, from the stored totals."""
    return season_of_totals(store.read(spark, "totals").filter("days > 0").drop("days", "yearMonth"))


def season_weather(spark: SparkSession, store: Store, county_fips: str, state: str) -> DataFrame:
    """The yearly table of all stations, as ``gold.season_weather`` makes it."""
    wide = season_wide(season_long(spark, store))
    marked = wide.withColumns({"countyFips": F.lit(county_fips), "stateCode": F.lit(state)})
    return marked.select("stationId", "year", "countyFips", "stateCode", *wide.columns[2:])
