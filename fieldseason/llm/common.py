"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import reduce
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

#: ASCII white space, which separates words in every operator here.
SPACE = r"[\x20\x09-\x0D]+"
_SPACES = ("\t", "\n", "\x0b", "\x0c", "\r")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``; a session without it, as in tests, gets one of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(frame: DataFrame) -> DataFrame:
    """``frame`` written to the shared folder and read again: lineage ends there, and no later job repeats the work."""
    spark, path = frame.sparkSession, scratch_dir(frame.sparkSession)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just ``doc_id`` and ``text`` (null: empty), whatever else the table holds."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def id_crc(column: str | Column) -> Column:
    """crc32 of an id written as text; a null id counts as the empty text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """``doc_id, label, text`` of at most ``limit`` labels, the ones whose ids' hashes are smallest."""
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    # Bounded by the limit, so it may be broadcast.
    return texts(docs).join(F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(limit)), "doc_id")


def split_words(text: str) -> list[str]:
    """Maximal runs without ASCII white space."""
    return [w for w in reduce(lambda t, c: t.replace(c, " "), _SPACES, text).split(" ") if w]


def map_rows(frame: DataFrame, make: Callable[[], Callable[[dict], dict]], schema: str, rows: int = 256) -> DataFrame:
    """``mapInArrow`` with a function of column lists.

    ``make`` is called once a task and returns the function, which gets and returns a dict of
    lists for at most ``rows`` rows, so that a slice's results stay small whatever the batch is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, to = make(), None
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                out = work({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                to = to or _arrow(schema)
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in to], schema=to)

    return frame.mapInArrow(run, schema)


_HELD: dict = {}


def held(key: tuple, make: Callable[[], T]) -> T:
    """What a worker keeps from task to task, such as tables of words met before: one operator's at a time.

    Workers serve one operator after another; keeping the tables of all would add up.
    """
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


_TYPES = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(),
          "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()),
          "array<string>": pa.list_(pa.string()), "array<binary>": pa.list_(pa.binary()), "array<array<string>>": pa.list_(pa.list_(pa.string()))}


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([pa.field(n, _TYPES[t]) for n, t in (f.strip().split(" ", 1) for f in schema.split(","))])
