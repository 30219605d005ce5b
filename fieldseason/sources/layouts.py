"""Stored forms that spare reading and shuffling: sorted files, and tables bucketed by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldseason.functions.columns import quoted
from fieldseason.operators.bronze import OBSERVATION_KEY, absent_rows, one_per_key
from fieldseason.sources.tables import placed

#: Bytes of a row group: each holds few stations, so that a filter skips most.
ROW_GROUP = 8 << 20


def write_clustered(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("year",), cluster_by: Sequence[str] = ("stationId", "date"),
    row_group: int = ROW_GROUP,
) -> None:
    """Overwrite a table whose partitions are sorted throughout.

    Rows are dealt by ranges of (partition, cluster columns), so a file holds a range of stations,
    a large partition is spread over files, and each row group's statistics span few stations.
    A filter on a station then reads the row groups that can hold it.
    """
    df = placed(df, partition_by)
    keys = [*partition_by, *cluster_by]
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered.write.mode("overwrite").option("parquet.block.size", row_group).partitionBy(*partition_by).parquet(path)


def write_bucketed(
    df: DataFrame, name: str, path: str, buckets: int, keys: Sequence[str] = OBSERVATION_KEY
) -> DataFrame:
    """A catalog table at ``path``, dealt and sorted by key into ``buckets``; returns it.

    Groupings and joins by the key read it without an exchange. Choose ``buckets`` for the table's
    full size: a bucket is a task's share. Rows are dealt before they are written, so that each
    bucket is one file.
    """
    spark = df.sparkSession
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite").format("parquet").option("path", path)
        .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    )
    return read_bucketed(spark, name)


def attach_bucketed(
    spark: SparkSession, name: str, path: str, schema: str, buckets: int, keys: Sequence[str] = OBSERVATION_KEY
) -> DataFrame:
    """A bucketed table that another session wrote, known to this session's catalog again."""
    by = ", ".join(keys)
    spark.sql(f"create table if not exists {name} ({schema}) using parquet clustered by ({by}) sorted by ({by})"
              f" into {buckets} buckets location {quoted(path)}")
    return read_bucketed(spark, name)


def read_bucketed(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def upsert_bucketed(
    stored: DataFrame, new: DataFrame, buckets: int, keys: Sequence[str] = OBSERVATION_KEY
) -> DataFrame:
    """``bronze.upsert`` with ``replace`` over a bucketed table: only ``new`` is dealt, to the table's buckets.

    New rows of a key are reduced to one and meet the stored ones bucket by bucket.
    """
    single = one_per_key(new.repartition(buckets, *keys), keys)
    readings = single.filter("value is not null").select(*keys)
    kept = stored.join(readings.hint("shuffle_merge"), list(keys), "left_anti").select(*stored.columns)
    nulls = absent_rows(stored, single.filter("value is null"), keys)
    return kept.unionByName(single.filter("value is not null")).unionByName(nulls)


def bucketed_duplicates(stored: DataFrame, keys: Sequence[str] = OBSERVATION_KEY) -> DataFrame:
    """Keys held by more than one row, counted within buckets."""
    return stored.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)
