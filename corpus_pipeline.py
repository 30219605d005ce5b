"""A cleaning pipeline over ``documents``: toxicity, exact copies, near copies, personal data, packing.

Each stage works on all that its predecessor kept, and all but the last return the columns of
``documents``. Null texts count as empty, repeated rows are documents each, columns beyond those
of ``documents`` stay as they are until packing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldseason.llm import exact_dedup, ngram_join, packing, pii, toxicity
from fieldseason.llm.common import id_crc, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Documents of this score or more are toxic.
TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The classifier learns from the labels outside its held-out part; documents that it rejects go."""
    labels = table(spark, sf_dir, "labels").filter(id_crc("doc_id") % 4 != 2)
    model = toxicity.train(table(spark, sf_dir, "documents"), labels)
    return docs.filter(toxicity.score_column(docs["text"], model) < TOXIC)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, the one with the smallest id stays."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked documents, the one with the smallest id stays."""
    return ngram_join.one_of_each(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, its spans replaced by their kinds."""
    return pii.mask(docs, pii.find_pii(docs))


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 4096 tokens."""
    return packing.packed_digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("ngram_join", drop_near_copies),
    ("pii", mask_personal_data), ("packing", pack_tokens)]

#: SQL cannot express the trained, sampled and packing stages; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage; what each stage kept is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
