"""Stored tables: read, overwrite, append, replace a partition, materialise."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldseason.operators.bronze import (
    absent_rows,
    from_first_date,
    only_station,
    require_new,
    upsert,
)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A stored table. A schema keeps the types of partition columns as declared."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_layer(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a table. The source must not be the table itself."""
    _writer(df, partition_by).mode("overwrite").parquet(path)


def append_layer(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    _writer(df, partition_by).mode("append").parquet(path)


#: Partition columns that are made from the date text, null where it is no date.
DERIVED = {
    "year": ("integer", "try_cast(substring(date, 1, 4) as int)"),
    "yearMonth": ("string", "date_format(try_to_date(date, 'yyyy-MM-dd'), 'yyyy-MM')"),
}


def placed(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """``df`` with the partition columns that its dates give."""
    return df.withColumns({c: F.expr(DERIVED[c][1]) for c in partition_by if c in DERIVED and c not in df.columns})


def read_partitioned(spark: SparkSession, path: str, schema: StructType, partition_by: Sequence[str]) -> DataFrame:
    """A stored table with the partition columns that its dates gave."""
    for c in partition_by:
        if c in DERIVED and c not in schema.names:
            schema = StructType([*schema.fields]).add(c, DERIVED[c][0])
    return read_table(spark, path, schema)


def partition_values(df: DataFrame, partition_by: Sequence[str]) -> list[tuple]:
    """The partitions that the rows belong to, null for null and for the empty text, which is stored as null.

    Brought to the driver: no more values than the table's folders, which the driver lists to read it.
    """
    kinds = dict(df.dtypes)
    texts = [F.nullif(F.col(c), F.lit("")).alias(c) if kinds[c] == "string" else F.col(c) for c in partition_by]
    return sorted((tuple(r) for r in df.select(*texts).distinct().collect()), key=repr)


def in_partitions(stored: DataFrame, values: Sequence[tuple], partition_by: Sequence[str]) -> DataFrame:
    """The rows of these partitions, by a filter over literals that the scan takes as a partition filter."""
    if len(partition_by) == 1:
        column, known = F.col(partition_by[0]), [v for v, in values if v is not None]
        found = column.isin(known) if known else F.lit(False)
        return stored.filter(found | column.isNull() if (None,) in values else found)
    one = lambda row: reduce(and_, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(partition_by, row, strict=True)])
    return stored.filter(reduce(or_, map(one, values), F.lit(False)))


def touched_rows(new: DataFrame, path: str, partition_by: Sequence[str]) -> DataFrame:
    """The stored rows in the partitions of ``new``: all that can share a key with its rows."""
    stored = read_partitioned(new.sparkSession, path, new.schema, partition_by)
    return in_partitions(stored, partition_values(placed(new, partition_by), partition_by), partition_by)


def _writer(df: DataFrame, partition_by: Sequence[str]):
    if not partition_by:
        return df.write
    df = placed(df, partition_by)
    # Rebalancing gathers a partition's rows into few files, and splits a partition
    # that would be too large for one task.
    return df.hint("rebalance", *[F.col(c) for c in partition_by]).write.partitionBy(*partition_by)


def overwrite_station(
    new: DataFrame, path: str, station_id: str, partition_by: Sequence[str] = ("stationId",)
) -> None:
    """Replace one station in a stored table. A re-run changes nothing.

    ``new`` without a row is an error, as it would leave the station's old rows in place. A
    table partitioned by other columns is rewritten in the partitions that hold the station:
    only those are read in whole, after a scan of the station ids alone.
    """
    require_new(new, station_id)
    new = only_station(new, station_id)
    if tuple(partition_by) != ("stationId",):
        stored = read_partitioned(new.sparkSession, path, new.schema, partition_by)
        own = stored.filter(F.col("stationId").eqNullSafe(station_id))
        touched = placed(new, partition_by).select(*partition_by).union(own.select(*partition_by))
        rest = in_partitions(stored, partition_values(touched, partition_by), partition_by)
        rest = rest.filter(~F.col("stationId").eqNullSafe(station_id))
        new = materialize(rest.select(*new.columns).unionByName(new), "station")
    overwrite_partitions(new, path, partition_by)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions that ``df`` has rows of. The source must not be the table itself."""
    (
        _writer(df, partition_by)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def append_absent(new: DataFrame, path: str, partition_by: Sequence[str] = ("stationId",)) -> None:
    """Append the observations that the table lacks, under the rule of ``absent_rows``.

    Only stored rows from the first new date on, in the partitions of the new ones, can share
    a key with them, so the comparison reads that part of the table. A re-run appends nothing.
    With many stations, partition by ``year``: a batch then adds a few files, not one for each
    station.
    """
    stored = touched_rows(new, path, partition_by).select(*new.columns)
    append_layer(absent_rows(from_first_date(stored, new), new), path, partition_by)


def upsert_stored(
    new: DataFrame, path: str, on_conflict: str = "keep", partition_by: Sequence[str] = ("stationId",)
) -> None:
    """``bronze.upsert`` over a stored table, by its own conflict rule.

    ``keep`` and ``append`` add files. ``replace`` reads and rewrites the partitions that ``new``
    touches: the merged rows are written aside first, so a re-run gives the same table.
    """
    if on_conflict == "append":
        append_layer(new, path, partition_by)
    elif on_conflict == "keep":
        append_absent(new, path, partition_by)
    else:
        touched = touched_rows(new, path, partition_by)
        merged = upsert(touched.select(*new.columns), new, on_conflict=on_conflict)
        overwrite_partitions(materialize(merged, "upsert"), path, partition_by)


def empty_like(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def find_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The stored table, or None when it is not there."""
    try:
        return read_table(spark, path, schema)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def read_or_seed(
    spark: SparkSession, path: str, seed: Callable[[], DataFrame], schema: StructType | None = None
) -> DataFrame:
    """The stored observations, or the seed when the table is not there.

    A table that is there but holds no date is an error.
    """
    stored = find_table(spark, path, schema)
    if stored is None:
        return seed()
    if stored.filter(F.col("date").isNotNull()).isEmpty():
        raise ValueError(f"no dates in {path}")
    return stored


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Unset, one temporary folder serves a local session, and only that.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    folder = tempfile.mkdtemp(prefix="fieldseason-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    The result has no lineage to recompute and a known size, so the planner broadcasts
    it in a join when, and only when, it is below its threshold.
    """
    path = scratch_path(df.sparkSession, name)
    write_layer(df, path)
    return read_table(df.sparkSession, path, df.schema)
