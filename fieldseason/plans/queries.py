"""The registered queries: one per operator, over the whole derived tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldseason.functions.calendar import expected_days
from fieldseason.functions.crops import normalise_crop
from fieldseason.operators import bronze, crops, gold, present, silver
from fieldseason.plans import incremental, layers
from fieldseason.schemas import CROP_RECORDS, ELEMENTS, OBSERVATIONS
from fieldseason.sources import fixtures, landed, layouts, reports, tables
from fieldseason.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

SITE = layers.Site(
    fixtures.ANCHOR, fixtures.ANCHOR_NAME, "001", "NE",
    fixtures.SUPPLEMENTAL, fixtures.SUPPLEMENTAL_NAME,
)
# Limits at which the derived observations have hits; the defaults are beyond their range.
LIMITS = (("TMAX", -3.0, 44.0), ("TMIN", -9.0, 14.0), ("PRCP", None, 45.0))
DELETED_MONTH, CUTOFF, TODAY = "1997-05", "1999-09-30", "2003-06-15"
OLD_UNTIL, NEW_FROM = "2001-06-30", "2001-06-01"
FIRST_YEAR, LAST_YEAR = 1997, 2000

_REGISTRY: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


obs_of = fixtures.observations


def daily_of(spark: SparkSession, sf: str) -> DataFrame:
    """Daily table of the anchor."""
    return layers.silver_for(obs_of(spark, sf), SITE)


def daily_all_of(spark: SparkSession, sf: str) -> DataFrame:
    """Daily table of all stations, as one lazy plan."""
    return silver.silver_weather(
        obs_of(spark, sf), supplemental=SITE.supplemental,
        supplemental_name=SITE.supplemental_name, stations=fixtures.stations(spark, sf),
    )


def long_of(daily: DataFrame) -> DataFrame:
    return gold.season_long(gold.qualified_days(daily))


def gold_of(spark: SparkSession, sf: str) -> DataFrame:
    return layers.gold_for(daily_of(spark, sf), SITE)


# --- sources and tables -------------------------------------------------------


def _table_profile(obs: DataFrame) -> DataFrame:
    """Whole rows, and how often each occurs, as the derived table has repeated ones."""
    return obs.groupBy(*OBSERVATIONS.names).agg(F.count("*").alias("n"))


@_query
def stored_table(spark: SparkSession, sf: str) -> DataFrame:
    """Full overwrite, append, and scan of a table partitioned by station."""
    obs = obs_of(spark, sf)
    path = tables.scratch_path(spark, "observations")
    tables.write_layer(obs.filter(F.col("date") <= CUTOFF), path, ["stationId"])
    tables.append_layer(obs.filter(F.col("date") > CUTOFF), path, ["stationId"])
    return _table_profile(tables.read_table(spark, path, OBSERVATIONS))


@_query
def overwrite_station(spark: SparkSession, sf: str) -> DataFrame:
    """One station's partition replaced by its rows up to the cutoff."""
    obs = obs_of(spark, sf)
    path = tables.scratch_path(spark, "observations")
    tables.write_layer(obs, path, ["stationId"])
    newer = obs.filter((F.col("stationId") == "GHCND:ST2") & (F.col("date") <= CUTOFF))
    tables.overwrite_station(newer, path, "GHCND:ST2")
    return _table_profile(tables.read_table(spark, path, OBSERVATIONS))


@_query
def overwrite_station_by_year(spark: SparkSession, sf: str) -> DataFrame:
    """The same over a table partitioned by year, of which only the station's years are rewritten."""
    obs = obs_of(spark, sf)
    path = tables.scratch_path(spark, "observations")
    tables.write_layer(obs, path, ["year"])
    newer = obs.filter((F.col("stationId") == "GHCND:ST2") & (F.col("date") <= CUTOFF))
    tables.overwrite_station(newer, path, "GHCND:ST2", ["year"])
    return _table_profile(tables.read_table(spark, path, OBSERVATIONS))


@_query
def clustered_station(spark: SparkSession, sf: str) -> DataFrame:
    """One station's readings from year partitions that are sorted by station and date."""
    path = tables.scratch_path(spark, "clustered")
    layouts.write_clustered(obs_of(spark, sf), path)
    stored = tables.read_partitioned(spark, path, OBSERVATIONS, ["year"])
    return stored.filter(F.col("stationId") == SITE.supplemental).groupBy("year", "dataType").agg(
        F.count("value").alias("readings"), F.min("date").alias("firstDate"), F.max("date").alias("lastDate"))


def _bucketed(spark: SparkSession, obs: DataFrame, buckets: int = 16) -> DataFrame:
    path = tables.scratch_path(spark, "bucketed")
    return layouts.write_bucketed(obs, path.rsplit("/", 1)[-1].replace("-", "_"), path, buckets)


@_query
def duplicate_keys_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The duplicate check over a table bucketed by key, which needs no exchange."""
    return layouts.bucketed_duplicates(_bucketed(spark, obs_of(spark, sf)))


@_query
def upsert_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The update of a table bucketed by key: the new rows come to its buckets."""
    obs = obs_of(spark, sf)
    stored = _bucketed(spark, obs.filter(F.col("date") <= OLD_UNTIL))
    return _counted(layouts.upsert_bucketed(stored, _newer(obs), 16))


@_query
def append_absent(spark: SparkSession, sf: str) -> DataFrame:
    """The stored form of the incremental update."""
    obs = obs_of(spark, sf)
    path = tables.scratch_path(spark, "observations")
    tables.write_layer(obs.filter(F.col("date") <= OLD_UNTIL), path, ["stationId"])
    tables.append_absent(_newer(obs), path)
    return _table_profile(tables.read_table(spark, path, OBSERVATIONS))


@_query
def replace_station(spark: SparkSession, sf: str) -> DataFrame:
    obs = obs_of(spark, sf)
    newer = obs.filter((F.col("stationId") == "GHCND:ST2") & (F.col("date") <= CUTOFF))
    return _table_profile(bronze.replace_station(obs, newer, "GHCND:ST2"))


@_query
def read_or_seed(spark: SparkSession, sf: str) -> DataFrame:
    """No table yet, so the seed is read."""
    path = tables.scratch_path(spark, "absent")
    return _table_profile(tables.read_or_seed(spark, path, lambda: obs_of(spark, sf)))


@_query
def daily_json_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    """Daily summaries landed as JSON, read and unpivoted.

    Each element is a number on some days and a numeric string on others.
    """
    wide = silver.pivot_elements(obs_of(spark, sf))
    as_text = F.substring("date", 10, 1).isin("1", "4", "7")
    summary = F.struct(
        F.when(as_text, F.col("stationId"))
        .otherwise(F.replace(F.col("stationId"), F.lit(landed.STATION_PREFIX), F.lit("")))
        .alias("STATION"),
        F.concat("date", F.lit("T00:00:00")).alias("DATE"),
        *ELEMENTS,
    )
    text = F.struct(
        summary["STATION"].alias("STATION"), summary["DATE"].alias("DATE"),
        *[F.col(e).cast("string").alias(e) for e in ELEMENTS],
    )
    path = tables.scratch_path(spark, "daily-json")
    rows = wide.select(F.when(as_text, F.to_json(text)).otherwise(F.to_json(summary)).alias("json"))
    reports.write_json_rows(rows, path)
    return landed.unpivot_daily_json(landed.read_daily_json(spark, path, multi_line=False))


def _responses(spark: SparkSession, sf: str) -> str:
    """A response per station-day, a line of JSON; some are errors, pages or cut off."""
    wide = silver.pivot_elements(obs_of(spark, sf))
    summary = F.to_json(F.struct(F.col("stationId").alias("STATION"), F.col("date").alias("DATE"), *ELEMENTS))
    error = F.to_json(F.struct(F.lit("invalid").alias("errorCode"), F.col("date").alias("errorMessage")))
    path = tables.scratch_path(spark, "responses")
    day = F.substring("date", 9, 2)
    reports.write_json_rows(wide.select(F.explode(F.array(
        summary,
        F.when(day == "05", error),
        F.when(day == "06", F.concat(F.lit("<html>"), F.col("date"), F.lit("</html>"))),
        F.when(day == "07", F.substring(summary, 1, 20)),
    )).alias("json")).filter("json is not null"), path)
    return path


@_query
def daily_json_with_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Summaries among responses that hold none: no row comes of the others, which are counted."""
    path = _responses(spark, sf)
    counted = landed.rejected_responses(spark, path, multi_line=False)
    rows = landed.unpivot_daily_json(landed.read_daily_json(spark, path, multi_line=False))
    return rows.withColumns({
        "responses": counted.select("responses").scalar(), "rejected": counted.select("rejected").scalar()})


@_query
def daily_json_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Rejected objects by reason, beside what one pass over all responses wrote to either side."""
    target = tables.scratch_path(spark, "landed")
    landed.land_daily_json(spark, _responses(spark, sf), target, multi_line=False)
    accepted = landed.accepted_summaries(spark, target).agg(F.count("*")).scalar()
    return landed.rejected_objects(spark, target).groupBy("reason").agg(
        F.count("*").alias("rejected"), F.count_distinct("object").alias("texts")).withColumn("accepted", accepted)


@_query
def landed_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The incremental update as a stream, over a table partitioned by year that has a part of the days."""
    obs = obs_of(spark, sf)
    path = tables.scratch_path(spark, "observations")
    stored = silver.pivot_elements(obs).unpivot(["stationId", "date"], list(ELEMENTS), "dataType", "value")
    stored = stored.withColumn("attributes", F.lit(None).cast("string")).withColumn(
        "value", F.when(F.substring("date", 10, 1) != "3", F.col("value")))
    tables.write_layer(stored.filter(F.col("date") <= OLD_UNTIL), path, ["year"])
    ingest.apply_landed(
        spark, _responses(spark, sf), path, tables.scratch_path(spark, "stream")).awaitTermination()
    return _table_profile(tables.read_table(spark, path, OBSERVATIONS))


@_query
def crop_json(spark: SparkSession, sf: str) -> DataFrame:
    """Crop statistics landed as JSON responses."""
    raw = fixtures.crop_statistics(spark, sf).withColumn(
        "year", F.when(F.col("commodity") != "WHEAT", F.col("year"))
    )
    row = F.struct(*[F.col(name).alias(field) for field, name in landed.CROP_FIELDS.items()])
    path = tables.scratch_path(spark, "crop-json")
    reports.write_json_rows(raw.select(F.to_json(F.struct(F.array(row).alias("data"))).alias("json")), path)
    return landed.read_crop_json(spark, path, multi_line=False)


@_query
def station_json(spark: SparkSession, sf: str) -> DataFrame:
    """Station pages landed as JSON; rows that lack a latitude are dropped."""
    raw = fixtures.table(spark, sf, "supplier").select(
        F.col("s_name").alias("id"),
        F.concat(F.lit("Station "), F.col("s_suppkey").cast("string")).alias("name"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_nationkey") + 30.5).alias("latitude"),
        F.col("s_acctbal").alias("longitude"),
        F.lit("1995-01-01").alias("mindate"),
        F.lit("2001-12-31").alias("maxdate"),
    )
    page = F.struct(F.array(F.struct(*raw.columns)).alias("results"))
    path = tables.scratch_path(spark, "station-json")
    reports.write_json_rows(raw.select(F.to_json(page).alias("json")), path)
    return landed.read_station_json(spark, path, multi_line=False)


@_query
def csv_report(spark: SparkSession, sf: str) -> DataFrame:
    """The observation report as CSV, read back as text."""
    path = tables.scratch_path(spark, "report")
    reports.write_report(bronze.bronze_report(obs_of(spark, sf), LIMITS), path)
    return spark.read.option("header", True).csv(path)


@_query
def preview(spark: SparkSession, sf: str) -> DataFrame:
    return present.preview(daily_all_of(spark, sf), "date", "stationId")


@_query
def sample_table(spark: SparkSession, sf: str) -> DataFrame:
    return present.sample_table(silver.day_quality(obs_of(spark, sf)), "date", "stationId")


@_query
def export_annual(spark: SparkSession, sf: str) -> DataFrame:
    return present.export_annual(gold_of(spark, sf))


@_query
def export_daily(spark: SparkSession, sf: str) -> DataFrame:
    return present.export_daily(
        present.daily_drilldown(daily_of(spark, sf), SITE.station, FIRST_YEAR)
    )


@_query
def silver_without_supplemental(spark: SparkSession, sf: str) -> DataFrame:
    """The optional source replaced by an empty table of the same shape."""
    obs = obs_of(spark, sf)
    stand_in = tables.empty_like(spark, OBSERVATIONS)
    pools = silver.pool_medians(obs).join(silver.pivot_supplemental(stand_in, "none"), "date", "left")
    return silver.silver_weather(obs, SITE.station, anchor_name=SITE.name, fallback=pools)


# --- incremental logic, deletes and quality checks ----------------------------


@_query
def high_water_mark(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.high_water_mark(obs_of(spark, sf))


@_query
def high_water_mark_by_station(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.high_water_mark(obs_of(spark, sf), by="stationId")


def _station_ids(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.stations(spark, sf).select(F.col("id").alias("stationId"))


@_query
def gap_ranges(spark: SparkSession, sf: str) -> DataFrame:
    marks = bronze.high_water_mark(obs_of(spark, sf))
    return bronze.gap_ranges(bronze.mark_stations(_station_ids(spark, sf), marks), TODAY)


@_query
def gap_ranges_by_station(spark: SparkSession, sf: str) -> DataFrame:
    marks = bronze.high_water_mark(obs_of(spark, sf), by="stationId")
    return bronze.gap_ranges(bronze.mark_stations(_station_ids(spark, sf), marks), TODAY)


@_query
def year_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.year_ranges(_station_ids(spark, sf), 1995, 2001)


def _newer(obs: DataFrame) -> DataFrame:
    return obs.filter(F.col("date") >= NEW_FROM).withColumn("value", F.col("value") * 2)


def _upserted(spark: SparkSession, sf: str, on_conflict: str) -> DataFrame:
    obs = obs_of(spark, sf)
    result = bronze.upsert(
        obs.filter(F.col("date") <= OLD_UNTIL), _newer(obs), on_conflict=on_conflict
    )
    return result.groupBy("stationId", "date", "dataType", "value").agg(F.count("*").alias("n"))


@_query
def upsert_replace(spark: SparkSession, sf: str) -> DataFrame:
    return _upserted(spark, sf, "replace")


@_query
def upsert_keep(spark: SparkSession, sf: str) -> DataFrame:
    return _upserted(spark, sf, "keep")


def _counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy("stationId", "date", "dataType", "value").agg(F.count("*").alias("n"))


def _unread(obs: DataFrame, digit: str) -> DataFrame:
    """The table as it was before the readings of some days were known."""
    return obs.withColumn("value", F.when(F.substring("date", 10, 1) != digit, F.col("value")))


@_query
def upsert_late_reading(spark: SparkSession, sf: str) -> DataFrame:
    """Readings that come after their days were stored without them."""
    obs = obs_of(spark, sf)
    return _counted(bronze.upsert(_unread(obs, "3"), obs, on_conflict="keep"))


@_query
def upsert_null_new(spark: SparkSession, sf: str) -> DataFrame:
    """New rows without readings take nothing from the table."""
    obs = obs_of(spark, sf)
    return _counted(bronze.upsert(obs, _unread(obs, "4"), on_conflict="replace"))


@_query
def upsert_repeated_new(spark: SparkSession, sf: str) -> DataFrame:
    """Each new key several times: one row of each is added."""
    obs = obs_of(spark, sf)
    newer = _newer(obs)
    again = newer.unionByName(newer.withColumn("value", F.col("value") / 4))
    return _counted(bronze.upsert(obs.filter(F.col("date") <= OLD_UNTIL), again, on_conflict="keep"))


@_query
def upsert_append(spark: SparkSession, sf: str) -> DataFrame:
    return _upserted(spark, sf, "append")


@_query
def delete_month(spark: SparkSession, sf: str) -> DataFrame:
    return _table_profile(bronze.delete_month(obs_of(spark, sf), DELETED_MONTH))


@_query
def delete_month_counts(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.delete_month_counts(obs_of(spark, sf), DELETED_MONTH)


@_query
def trim_after(spark: SparkSession, sf: str) -> DataFrame:
    return _table_profile(bronze.trim_after(obs_of(spark, sf), CUTOFF))


@_query
def trim_after_counts(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.trim_after_counts(obs_of(spark, sf), CUTOFF)


@_query
def value_counts_wide(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.value_counts_wide(obs_of(spark, sf))


@_query
def coverage(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.coverage(obs_of(spark, sf))


@_query
def temp_inversions(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.temp_inversions(obs_of(spark, sf))


@_query
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.duplicate_keys(obs_of(spark, sf))


@_query
def duplicate_count(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.duplicate_count(obs_of(spark, sf))


@_query
def extreme_values(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.extreme_values(obs_of(spark, sf), LIMITS)


@_query
def bronze_report(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.bronze_report(obs_of(spark, sf), LIMITS)


@_query
def bronze_issues(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.bronze_issues(bronze.bronze_report(obs_of(spark, sf), LIMITS))


@_query
def issue_count(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.issue_count(bronze.bronze_report(obs_of(spark, sf), LIMITS))


@_query
def station_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.station_inventory(obs_of(spark, sf), fixtures.stations(spark, sf), 1995, 2002)


# --- daily table --------------------------------------------------------------


@_query
def flag_suspect(spark: SparkSession, sf: str) -> DataFrame:
    flagged = silver.flag_suspect(obs_of(spark, sf))
    return flagged.groupBy("stationId", "date", "dataType", "attributes", "suspect").agg(
        F.count("*").alias("n")
    )


@_query
def day_quality(spark: SparkSession, sf: str) -> DataFrame:
    return silver.day_quality(obs_of(spark, sf))


@_query
def pivot_elements(spark: SparkSession, sf: str) -> DataFrame:
    return silver.pivot_elements(obs_of(spark, sf))


@_query
def pivot_supplemental(spark: SparkSession, sf: str) -> DataFrame:
    return silver.pivot_supplemental(obs_of(spark, sf), SITE.supplemental)


@_query
def has_station(spark: SparkSession, sf: str) -> DataFrame:
    obs = obs_of(spark, sf)
    return silver.has_station(obs, SITE.supplemental).unionByName(silver.has_station(obs, "none"))


@_query
def pool_medians(spark: SparkSession, sf: str) -> DataFrame:
    return silver.pool_medians(obs_of(spark, sf))


@_query
def pool_medians_excluding(spark: SparkSession, sf: str) -> DataFrame:
    return silver.pool_medians(obs_of(spark, sf), exclude=[SITE.station, SITE.supplemental])


def _filled(spark: SparkSession, sf: str, exclude=()) -> DataFrame:
    obs = obs_of(spark, sf)
    own = obs.filter(F.col("stationId") == SITE.station)
    return silver.fill_temperature(
        silver.day_wide(own), silver.fallback_temperatures(obs, SITE.supplemental, exclude)
    )


@_query
def fill_temperature(spark: SparkSession, sf: str) -> DataFrame:
    return _filled(spark, sf).select("stationId", "date", "maxC", "minC", "PRCP", "SNOW", "SNWD")


@_query
def temp_provenance(spark: SparkSession, sf: str) -> DataFrame:
    """With a pool that leaves out two stations, so that every tier occurs."""
    filled = _filled(spark, sf, exclude=[SITE.station, SITE.supplemental])
    return silver.temp_provenance(
        filled, SITE.name, SITE.supplemental, SITE.supplemental_name
    ).select("stationId", "date", "maxC", "minC", "tempSource", "tempStationId", "tempStationName")


@_query
def classify_days(spark: SparkSession, sf: str) -> DataFrame:
    days = obs_of(spark, sf).select(F.col("date").cast("date").alias("date")).distinct()
    return silver.classify_days(days)


@_query
def to_us_units(spark: SparkSession, sf: str) -> DataFrame:
    return silver.to_us_units(_filled(spark, sf)).select(
        "stationId", "date", "tempMaxF", "tempMinF", "tempAvgF", "precipIn", "snowIn", "snowDepthIn"
    )


@_query
def silver_weather(spark: SparkSession, sf: str) -> DataFrame:
    return daily_of(spark, sf)


@_query
def silver_all_stations(spark: SparkSession, sf: str) -> DataFrame:
    return layers.all_stations_silver(
        obs_of(spark, sf), fixtures.stations(spark, sf), SITE.supplemental, SITE.supplemental_name
    )


@_query
def silver_repeated_stations(spark: SparkSession, sf: str) -> DataFrame:
    """Every station listed twice: the daily table of all stations stays as it is."""
    stations = fixtures.stations(spark, sf)
    return layers.all_stations_silver(
        obs_of(spark, sf), stations.unionByName(stations), SITE.supplemental, SITE.supplemental_name)


@_query
def inventory_repeated_stations(spark: SparkSession, sf: str) -> DataFrame:
    stations = fixtures.stations(spark, sf)
    return bronze.station_inventory(obs_of(spark, sf), stations.unionByName(stations), 1995, 2002)


@_query
def gap_ranges_repeated_stations(spark: SparkSession, sf: str) -> DataFrame:
    stations = _station_ids(spark, sf)
    marks = bronze.high_water_mark(obs_of(spark, sf), by="stationId")
    return bronze.gap_ranges(bronze.mark_stations(stations.unionByName(stations), marks), TODAY)


@_query
def rows_per_year(spark: SparkSession, sf: str) -> DataFrame:
    return silver.rows_per_year(daily_of(spark, sf))


@_query
def season_rows_per_year(spark: SparkSession, sf: str) -> DataFrame:
    return silver.rows_per_year(gold_of(spark, sf))


@_query
def silver_validation(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_validation(daily_of(spark, sf))


@_query
def silver_validation_all_stations(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_validation(daily_all_of(spark, sf), by=["stationId"])


@_query
def validation_totals(spark: SparkSession, sf: str) -> DataFrame:
    return silver.validation_totals(silver.silver_validation(daily_of(spark, sf)))


@_query
def validation_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return silver.validation_alerts(silver.silver_validation(daily_of(spark, sf)))


@_query
def expected_days_by_year(spark: SparkSession, sf: str) -> DataFrame:
    years = obs_of(spark, sf).selectExpr(f"{bronze.YEAR_NUMBER} as year").distinct()
    return years.selectExpr("year", f"{expected_days('year')} as expectedDays")


# --- crops --------------------------------------------------------------------


@_query
def clean_crops(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned rows counted, because the statistics have repeated rows."""
    cleaned = crops.clean_crops(fixtures.crop_statistics(spark, sf))
    return cleaned.groupBy(
        "year", "state", "countyFips", "commodity", "statisticCat", "value", "parsedValue"
    ).agg(F.count("*").alias("n"))


@_query
def crop_records(spark: SparkSession, sf: str) -> DataFrame:
    return crops.crop_records(fixtures.crop_statistics(spark, sf)).select(*CROP_RECORDS.names)


@_query
def crop_breakdown_by_crop(spark: SparkSession, sf: str) -> DataFrame:
    return crops.crop_breakdown(crops.crop_records(fixtures.crop_statistics(spark, sf)), "cropName")


@_query
def crop_breakdown_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return crops.crop_breakdown(crops.crop_records(fixtures.crop_statistics(spark, sf)), "year")


@_query
def normalised_crops(spark: SparkSession, sf: str) -> DataFrame:
    """Crop names in several spellings, and words of part names that are none."""
    spelled = fixtures.crop_statistics(spark, sf).select(F.explode(F.array(
        F.col("commodity"),
        F.concat(F.lit(" "), F.lower("commodity")),
        F.regexp_replace("commodity", "S$", ""),
        F.concat(F.col("commodity"), F.lit("X")),
    )).alias("name"))
    return spelled.groupBy("name").agg(F.count("*").alias("n")).selectExpr(
        "*", f"{normalise_crop('name')} as crop"
    )


@_query
def require_rows(spark: SparkSession, sf: str) -> DataFrame:
    records = crops.require_rows(
        crops.crop_records(fixtures.crop_statistics(spark, sf)), "no crop records"
    )
    return records.agg(F.count("*").alias("n"))


def _profitability(spark: SparkSession, sf: str) -> DataFrame:
    return crops.crop_profitability(crops.crop_records(fixtures.crop_statistics(spark, sf)))


@_query
def crop_profitability(spark: SparkSession, sf: str) -> DataFrame:
    return _profitability(spark, sf)


@_query
def optimal_mix(spark: SparkSession, sf: str) -> DataFrame:
    mix = crops.optimal_mix(_profitability(spark, sf), gold_of(spark, sf))
    summary = F.col("weatherSummary")
    return mix.select(
        "year", "countyFips", "stateCode", "recommendedCrop", "cornScore", "soybeanScore",
        "wheatScore", "topCropRevenue",
        summary["growingDegreeDays"].alias("growingDegreeDays"),
        summary["totalPrecipIn"].alias("totalPrecipIn"),
        summary["wheatGrowingDroughtIndex"].alias("wheatGrowingDroughtIndex"),
    )


@_query
def optimal_mix_all_counties(spark: SparkSession, sf: str) -> DataFrame:
    """Every county-year, beside the season of the county's station."""
    days = gold.qualified_days(daily_all_of(spark, sf))
    seasons = gold.county_seasons(days, fixtures.counties(spark, sf))
    mix, summary = crops.optimal_mix(_profitability(spark, sf), seasons), F.col("weatherSummary")
    return mix.select(
        "year", "countyFips", "stateCode", "recommendedCrop", "topCropRevenue",
        *[summary[c].alias(c) for c in ("stationId", "growingDegreeDays", "totalPrecipIn", "julAvgTempF")])


# --- season table -------------------------------------------------------------


@_query
def temp_availability(spark: SparkSession, sf: str) -> DataFrame:
    return gold.temp_availability(daily_of(spark, sf))


@_query
def qualified_days(spark: SparkSession, sf: str) -> DataFrame:
    return gold.qualified_days(daily_all_of(spark, sf), SITE.station)


@_query
def growing_degrees(spark: SparkSession, sf: str) -> DataFrame:
    return gold.with_gdd(daily_all_of(spark, sf)).select("stationId", "date", "gdd")


@_query
def season_long(spark: SparkSession, sf: str) -> DataFrame:
    return long_of(daily_of(spark, sf))


@_query
def season_long_all_stations(spark: SparkSession, sf: str) -> DataFrame:
    return long_of(daily_all_of(spark, sf))


@_query
def drought_index(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly precipitation of each station against its mean, in hundredths of mm."""
    yearly = (
        obs_of(spark, sf)
        .filter(F.col("dataType") == "PRCP")
        .groupBy("stationId", F.expr(bronze.YEAR_NUMBER).alias("year"))
        .agg(F.sum(F.rint(F.col("value") * 100).cast("bigint")).alias("amount"))
    )
    return gold.drought_index(yearly, "amount", ["stationId"])


@_query
def season_weather(spark: SparkSession, sf: str) -> DataFrame:
    return gold_of(spark, sf)


@_query
def season_weather_all_stations(spark: SparkSession, sf: str) -> DataFrame:
    return gold.season_weather(daily_all_of(spark, sf), SITE.county_fips, SITE.state)


# --- slices and statistics ----------------------------------------------------


@_query
def latest_reading(spark: SparkSession, sf: str) -> DataFrame:
    return present.latest_reading(daily_of(spark, sf), SITE.station)


@_query
def latest_reading_by_station(spark: SparkSession, sf: str) -> DataFrame:
    return present.latest_reading(daily_all_of(spark, sf))


@_query
def daily_drilldown(spark: SparkSession, sf: str) -> DataFrame:
    return present.daily_drilldown(daily_all_of(spark, sf), SITE.station, FIRST_YEAR)


@_query
def drop_empty_years(spark: SparkSession, sf: str) -> DataFrame:
    """A year whose season is suspect has days in winter only."""
    in_season = F.col("date").between("1998-03-15", "1998-12-05")
    obs = obs_of(spark, sf).withColumn("attributes", F.when(in_season, F.lit(",X,S")).otherwise(F.col("attributes")))
    daily = silver.silver_weather(obs, SITE.station, SITE.supplemental, SITE.name)
    return present.drop_empty_years(layers.gold_for(daily, SITE)).select(
        "year", "frostFreeDays", "growingDegreeDays", "totalPrecipIn"
    )


@_query
def melt_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return present.melt_metrics(gold_of(spark, sf))


def _slice(spark: SparkSession, sf: str, window: str) -> DataFrame:
    days = present.daily_drilldown(daily_of(spark, sf), SITE.station, 1995)
    return present.slice_daily(days, FIRST_YEAR, LAST_YEAR, window).select(
        "date", "tempAvgF", "precipIn", "snowIn", "dailyGdd", "frostFreeFlag", "heatStressFlag"
    )


@_query
def slice_daily_all(spark: SparkSession, sf: str) -> DataFrame:
    return _slice(spark, sf, "all")


@_query
def slice_daily_month(spark: SparkSession, sf: str) -> DataFrame:
    return _slice(spark, sf, "jul")


@_query
def slice_daily_phase(spark: SparkSession, sf: str) -> DataFrame:
    return _slice(spark, sf, "wheatGrowing")


@_query
def slice_annual(spark: SparkSession, sf: str) -> DataFrame:
    return present.slice_annual(gold_of(spark, sf), FIRST_YEAR, LAST_YEAR).select(
        "year", "growingDegreeDays", "totalPrecipIn", "julAvgTempF", "cornGrowingSnowIn"
    )


@_query
def choose_grain(spark: SparkSession, sf: str) -> DataFrame:
    """A short range with days, a range that is too long, and one without days."""
    daily = present.daily_drilldown(daily_of(spark, sf), SITE.station, 1995)
    return (
        present.choose_grain(daily, FIRST_YEAR, LAST_YEAR)
        .unionByName(present.choose_grain(daily, 1995, 2001))
        .unionByName(present.choose_grain(daily, 2010, 2012))
    )


@_query
def summary_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics rounded below the precision at which the order of the sums shows."""
    return _stats(present.melt_long(long_of(daily_of(spark, sf))), ("window", "metric"))


@_query
def summary_stats_daily(spark: SparkSession, sf: str) -> DataFrame:
    """The same over days, which have no drought index."""
    days = present.daily_drilldown(daily_all_of(spark, sf), None, FIRST_YEAR)
    return _stats(present.melt_daily(present.slice_daily(days, FIRST_YEAR, LAST_YEAR)), ("stationId", "metric"))


def _stats(melted: DataFrame, by: tuple[str, ...]) -> DataFrame:
    stats = present.summary_stats(melted, by)
    return stats.withColumns({
        "avgValue": F.round("avgValue", 6), "stddevValue": F.round("stddevValue", 6)
    })


@_query
def condition_tags(spark: SparkSession, sf: str) -> DataFrame:
    return present.condition_tags(long_of(daily_all_of(spark, sf)))


@_query
def season_table(spark: SparkSession, sf: str) -> DataFrame:
    return present.season_table(long_of(daily_all_of(spark, sf)))


@_query
def season_table_phase(spark: SparkSession, sf: str) -> DataFrame:
    return present.season_table(long_of(daily_of(spark, sf)), "soybeanHarvest")


# --- compositions -------------------------------------------------------------


@_query
def refresh(spark: SparkSession, sf: str) -> DataFrame:
    obs = obs_of(spark, sf)
    return layers.refresh(obs.filter(F.col("date") <= OLD_UNTIL), _newer(obs), SITE)


@_query
def refresh_stored(spark: SparkSession, sf: str) -> DataFrame:
    obs = obs_of(spark, sf)
    path = tables.scratch_path(spark, "observations")
    tables.write_layer(obs.filter(F.col("date") <= OLD_UNTIL), path, ["stationId"])
    return layers.refresh_stored(spark, path, _newer(obs), SITE)


@_query
def refresh_stored_keep(spark: SparkSession, sf: str) -> DataFrame:
    """The rule that keeps stored readings, over a table partitioned by year: nothing is rewritten."""
    obs = obs_of(spark, sf)
    path = tables.scratch_path(spark, "observations")
    tables.write_layer(obs.filter(F.col("date") <= OLD_UNTIL), path, ["year"])
    return layers.refresh_stored(spark, path, _newer(obs), SITE, "keep", ["year"])


def _updated_store(spark: SparkSession, sf: str, on_conflict: str) -> incremental.Store:
    """Layers stored as of a date, and then brought up to date."""
    obs, stations = obs_of(spark, sf), fixtures.stations(spark, sf)
    store = incremental.Store(tables.scratch_path(spark, "store"), SITE.supplemental, SITE.supplemental_name)
    incremental.create(spark, store, obs.filter(F.col("date") <= OLD_UNTIL), stations)
    incremental.apply_update(spark, store, _newer(obs), on_conflict, stations)
    return store


@_query
def refresh_propagated(spark: SparkSession, sf: str) -> DataFrame:
    """The season table of all stations after an update that rewrote what it changed."""
    return incremental.season_weather(spark, _updated_store(spark, sf, "replace"), SITE.county_fips, SITE.state)


@_query
def refresh_propagated_keep(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.season_weather(spark, _updated_store(spark, sf, "keep"), SITE.county_fips, SITE.state)


@_query
def silver_propagated(spark: SparkSession, sf: str) -> DataFrame:
    """The daily table of all stations after the same update."""
    return incremental.daily(spark, _updated_store(spark, sf, "replace"))


@_query
def pool_medians_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Medians from stored counts that an update was added to."""
    return incremental.pool_medians(spark, _updated_store(spark, sf, "replace"))


@_query
def temperature_counts_merged(spark: SparkSession, sf: str) -> DataFrame:
    """The counts themselves, after readings were added and taken away."""
    obs = obs_of(spark, sf)
    older = silver.temperature_counts(obs.filter(F.col("date") <= OLD_UNTIL))
    gone = silver.temperature_counts(obs.filter((F.col("date") <= OLD_UNTIL) & (F.col("date") >= NEW_FROM)))
    added = silver.temperature_counts(_newer(obs))
    return silver.merged_counts(older, gone.withColumn("n", -F.col("n")), added)


@_query
def rebuild(spark: SparkSession, sf: str) -> DataFrame:
    return layers.rebuild(obs_of(spark, sf), CUTOFF, SITE)


@_query
def gold_from_stored_silver(spark: SparkSession, sf: str) -> DataFrame:
    """The season stage alone, started from a stored daily table."""
    return layers.gold_for(tables.materialize(daily_of(spark, sf), "daily"), SITE)
