"""Exact deduplication by skew-safe combining, in DataFrame functions only.

Texts are equal when identical after every run of ASCII white space became one space.
Grouping keys always hold the digest and the whole normalised text, so that a digest
shared by different texts never merges them.

1. Local: the partial aggregation of each input task combines its own copies.
2. Salted: a group's local winners are dealt over ``salts`` tasks, and merged there.
3. Global: at most ``salts`` winners of a group meet and give the smallest id and the size.

Rows then look their group up by digest and a second hash of the text; the global stage
fails loudly should two texts ever share both. The lookup is a plain shuffled join, whose
hot keys adaptive execution splits.

Null text is the empty text. Rows with the same id and text are all marked kept. A null id
loses to any other id; a group of null ids only keeps all its rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldseason.llm.common import SPACE, texts


def sha256(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def _digested(rows: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    content = F.regexp_replace("text", SPACE, " ")
    return rows.withColumn("content", content).select(
        "doc_id", "content", digest(F.col("content")).alias("digest"), F.xxhash64("content").alias("second"))


def exact_groups(docs: DataFrame, salts: int = 16, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, digest``."""
    rows = _digested(texts(docs), digest)
    keys, winner = ["digest", "second", "content"], F.min("keep_id").alias("keep_id")
    salted = rows.groupBy(*keys, F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt")).agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("size"))
    # Dealt by the digest alone, both groupings below need no further exchange.
    groups = salted.repartition("digest").groupBy(*keys).agg(winner, F.sum("size").alias("size"))
    found = groups.groupBy("digest", "second").agg(
        winner, F.sum("size").alias("group_size"), F.count("*").alias("contents"))
    shared = F.raise_error(F.lit("different texts share digest and second hash")).cast("long")
    found = found.withColumn("group_size", F.when(F.col("contents") == 1, F.col("group_size")).otherwise(shared))
    return rows.drop("content").join(found.drop("contents"), ["digest", "second"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def deduplicate(docs: DataFrame, salts: int = 16) -> DataFrame:
    """One row of each group of equal texts, with its own columns: of the smallest id, a null id last.

    Where that id has several rows of the text, the first by a hash of all columns stays.
    """
    kept = exact_groups(docs, salts).filter("kept")
    once = docs.groupBy(docs["doc_id"].alias("_id")).count().withColumn("_several", F.col("_id").isNull() | (F.col("count") > 1))
    several = once.filter("_several").select("_id")
    names = kept.select(F.col("doc_id").alias("_stay")).distinct().join(several, F.col("_stay").eqNullSafe(F.col("_id")), "left_anti")
    single = docs.join(names, docs["doc_id"] == names["_stay"], "left_semi")
    if several.isEmpty():
        return single
    # Rows whose id is not theirs alone are told apart by their text.
    content = F.regexp_replace(F.coalesce(docs["text"], F.lit("")), SPACE, " ")
    again = docs.join(several, docs["doc_id"].eqNullSafe(several["_id"]), "left_semi").withColumn("_digest", sha256(content))
    winners = kept.select(F.col("doc_id").alias("_stay"), F.col("digest").alias("_own")).distinct()
    again = again.join(winners, again["doc_id"].eqNullSafe(winners["_stay"]) & (again["_digest"] == winners["_own"]), "left_semi")
    # Each task cuts its own rows down to the first before they are dealt.
    first = Window.partitionBy("_digest").orderBy(F.xxhash64(*docs.columns))
    again = again.withColumn("_row", F.row_number().over(first)).filter("_row = 1")
    return single.unionByName(again.select(docs.columns))
