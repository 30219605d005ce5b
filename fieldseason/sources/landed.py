"""Landed JSON responses of the three source services, read on the executors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.readwriter import DataStreamReader

from fieldseason.schemas import CROP_STATISTICS, ELEMENTS, STATIONS

STATION_PREFIX = "GHCND:"

# Source field -> column.
CROP_FIELDS = {
    "year": "year",
    "state_alpha": "state",
    "county_name": "countyName",
    "county_ansi": "countyFips",
    "commodity_desc": "commodity",
    "statisticcat_desc": "statisticCat",
    "unit_desc": "unit",
    "Value": "value",
}
STATION_FIELDS = {
    "id": "id",
    "name": "name",
    "latitude": "latitude",
    "longitude": "longitude",
    "mindate": "minDate",
    "maxdate": "maxDate",
}


def _strings(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def daily_json_schema(elements: Sequence[str] = ELEMENTS) -> T.StructType:
    """Every field as text, because a reading may be a number or a numeric string."""
    return _strings(["STATION", "DATE", *elements])


def read_daily_json(
    spark: SparkSession, path: str, elements: Sequence[str] = ELEMENTS, multi_line: bool = True
) -> DataFrame:
    """Daily summaries. ``multi_line`` reads one array per file, else one object per line.

    Anything else, such as an error object or a page, gives no row of its own: see
    ``rejected_responses``.
    """
    return summaries(spark.read, path, elements, multi_line)


_BROKEN = "_broken"


def summaries(
    reader: DataFrameReader | DataStreamReader, path: str, elements: Sequence[str] = ELEMENTS, multi_line: bool = False
) -> DataFrame:
    """Objects with any field of a summary; those of error responses and broken text are left out."""
    schema = daily_json_schema(elements)
    found = reader.schema(T.StructType([*schema, T.StructField(_BROKEN, T.StringType())])).json(
        path, multiLine=multi_line, columnNameOfCorruptRecord=_BROKEN)
    return found.filter(F.col(_BROKEN).isNull() & F.coalesce(*schema.names).isNotNull()).select(*schema.names)


def rejected_responses(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row: ``responses`` landed at ``path`` and how many of them were ``rejected``.

    A response is a file, or a line. It is rejected when it is no array (a line: no object) that
    can be parsed, or holds an object without a station, a day and any reading, as an error does.
    An empty array is accepted.
    """
    text = spark.read.text(path, wholetext=multi_line).filter("trim(value) <> ''")
    one = f"struct<{', '.join(f'{c}:string' for c in daily_json_schema().names)}>"
    parsed = f"from_json(value, 'array<{one}>', map('mode', 'FAILFAST'))"
    known = f"coalesce({', '.join(f'x.{c}' for c in daily_json_schema().names)}) is not null"
    # A line's object is read as an array of one; parsing has to succeed before it is looked at.
    kind = "try_parse_json(value) is not null and startswith(trim(value), '[')" if multi_line else (
        "try_parse_json(value) is not null and startswith(trim(value), '{')")
    return text.selectExpr(
        f"case when coalesce({kind}, false) then forall({parsed}, x -> {known}) else false end as good"
    ).agg(F.count("*").alias("responses"), F.count_if(~F.col("good")).alias("rejected"))


def _quarantine_schema(elements: Sequence[str]) -> T.StructType:
    return _strings(["path", "reason", "object", "STATION", "DATE", *elements]).add("position", "long").add("accepted", "boolean")


def parsed_objects(
    spark: SparkSession, path: str, elements: Sequence[str] = ELEMENTS, multi_line: bool = True
) -> DataFrame:
    """Each object of each response once: its file, its place in the response, its text, its fields, and a ``reason``
    if it is no summary.

    A response that cannot be parsed, or is no array (a line: no object), is one object itself, so
    that nothing landed is lost. An empty array holds no object.
    """
    fields = daily_json_schema(elements).names
    text = spark.read.text(path, wholetext=multi_line).selectExpr("value", "_metadata.file_path as path").filter("trim(value) <> ''")
    opening, wanted = ("[", "no array") if multi_line else ("{", "no object")
    whole = f"case when try_parse_json(value) is null then 'no JSON' when not startswith(trim(value), '{opening}') then '{wanted}' end"
    objects = "from_json(value, 'array<string>')" if multi_line else "array(value)"
    split = text.selectExpr("path", "value", f"{whole} as whole").selectExpr(
        "path", "whole", f"posexplode(case when whole is null then {objects} else array(value) end) as (position, object)")
    parsed = split.selectExpr("*", f"case when whole is null then from_json(object, '{', '.join(f'{f} string' for f in fields)}') end as x")
    return parsed.selectExpr(
        "path", "cast(position as bigint) as position", "object",
        "coalesce(whole, case when object is null or not startswith(trim(object), '{') then 'no object'"
        f" when coalesce({', '.join(f'x.{f}' for f in fields)}) is null then 'no field of a summary' end) as reason",
        *[f"x.{f} as {f}" for f in fields])


def land_daily_json(
    spark: SparkSession, path: str, target: str, elements: Sequence[str] = ELEMENTS, multi_line: bool = True
) -> dict[str, int]:
    """Write each landed object to the accepted or to the rejected part of ``target``; returns how many went where.

    One pass reads and parses the responses; the counts are observed on the way. ``target`` has to be unused.
    """
    seen = Observation()
    frame = parsed_objects(spark, path, elements, multi_line).withColumn("accepted", F.col("reason").isNull()).observe(
        seen, F.count(F.lit(1)).alias("objects"), F.count_if("accepted").alias("accepted"),
        F.count_if(~F.col("accepted")).alias("rejected"))
    frame.write.partitionBy("accepted").parquet(target)
    return seen.get


def _landed(spark: SparkSession, target: str, elements: Sequence[str], accepted: bool) -> DataFrame:
    return spark.read.schema(_quarantine_schema(elements)).parquet(target).filter(F.col("accepted") == accepted)


def accepted_summaries(spark: SparkSession, target: str, elements: Sequence[str] = ELEMENTS) -> DataFrame:
    """The summaries of ``land_daily_json``, as ``read_daily_json`` gives them."""
    return _landed(spark, target, elements, True).select(*daily_json_schema(elements).names)


def rejected_objects(spark: SparkSession, target: str, elements: Sequence[str] = ELEMENTS) -> DataFrame:
    """What was rejected, for repair: ``path, position, reason`` and the text."""
    return _landed(spark, target, elements, False).select("path", "position", "reason", "object")


def unpivot_daily_json(df: DataFrame, elements: Sequence[str] = ELEMENTS) -> DataFrame:
    """A long row per element of each daily summary, also for readings that are absent.

    A reading that is no finite number is null.
    """
    station = F.coalesce("STATION", F.lit(""))
    return (
        df.select(
            F.when(station.startswith(STATION_PREFIX), station)
            .otherwise(F.concat(F.lit(STATION_PREFIX), station))
            .alias("stationId"),
            F.substring(F.coalesce("DATE", F.lit("")), 1, 10).alias("date"),
            *[_reading(e) for e in elements],
        )
        .unpivot(["stationId", "date"], list(elements), "dataType", "value")
        .withColumn("attributes", F.lit(None).cast("string"))
    )


def _reading(element: str) -> Column:
    number = F.col(element).try_cast("double")
    return F.when(F.abs(number) < float("inf"), number).alias(element)


def _read_wrapped(spark: SparkSession, path: str, array: str, names, multi_line: bool) -> DataFrame:
    schema = T.StructType([T.StructField(array, T.ArrayType(_strings(names)))])
    return spark.read.schema(schema).json(path, multiLine=multi_line).select(F.inline(array))


def read_crop_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Crop statistics from the ``data`` array of each response; a missing year is blank."""
    rows = _read_wrapped(spark, path, "data", CROP_FIELDS, multi_line)
    renamed = rows.select(*[F.col(field).alias(name) for field, name in CROP_FIELDS.items()])
    return renamed.fillna("", subset=["year"]).select(*CROP_STATISTICS.names)


def read_station_json(
    spark: SparkSession,
    path: str,
    required: Sequence[str] = STATIONS.names,
    multi_line: bool = True,
) -> DataFrame:
    """Stations from all pages; a row without one of the required fields is dropped."""
    rows = _read_wrapped(spark, path, "results", STATION_FIELDS, multi_line)
    return rows.select(*[
        _station_field(field, name) for field, name in STATION_FIELDS.items()
    ]).dropna(subset=list(required))


def _station_field(field: str, name: str) -> Column:
    return F.col(field).try_cast(STATIONS[name].dataType).alias(name)
