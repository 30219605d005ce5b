"""The incremental update as a file stream: each landed summary is applied once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from fieldseason.operators.bronze import one_per_key
from fieldseason.sources.landed import summaries, unpivot_daily_json
from fieldseason.sources.tables import append_absent, append_layer, find_table


def landed_observations(spark: SparkSession, landing: str) -> DataFrame:
    """Stream of long observations from files with one summary object per line."""
    return unpivot_daily_json(summaries(spark.readStream, landing))


def apply_landed(
    spark: SparkSession, landing: str, table: str, checkpoint: str,
    partition_by: Sequence[str] = ("year",),
) -> StreamingQuery:
    """Apply all files landed since the last run to the table, then stop.

    The rule is that of ``upsert`` with ``keep``: a summary that repeats a day adds only
    readings that are not stored. A batch repeated after a failure appends nothing.
    """
    def apply(batch: DataFrame, _: int) -> None:
        if find_table(spark, table, batch.schema) is None:
            append_layer(one_per_key(batch), table, partition_by)
        else:
            append_absent(batch, table, partition_by)

    return (
        landed_observations(spark, landing)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
