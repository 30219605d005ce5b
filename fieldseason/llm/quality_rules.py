"""Quality rules: per-document counts and cross-document line frequency, in DataFrame functions only.

A line, normalised (white space collapsed, trimmed, lower case) and hashed, is frequent at a
host when more than ``min_docs`` of the host's distinct documents hold it, however large the host
is. Exact copies of a text are one document here: finding them is another operator's work. Frequent lines are removed, and a document that loses
more than ``max_lost`` of its words so is depleted and rejected.

Null text is the empty text: no words, so it fails the base rules. A null host is a host of its
own. Repeated rows count once and get equal results. Other columns are ignored. A window of
words is compared by its 64-bit hash within one document.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldseason.llm.common import SPACE

WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.lower(F.trim(F.regexp_replace(line, SPACE, " "))))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def base_counts(rows: DataFrame, window: int = 5) -> DataFrame:
    """``rows`` with the counts of its column ``text``.

    Each array is a column of its own before a lambda reads it, so that it is built once a row.
    Documents whose windows are all different, most of them, skip the sort that finds repeats.
    """
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    at = lambda i: F.xxhash64(*[F.get("_w", i + k) for k in range(window)])
    same = lambda e, j: F.coalesce(e["h"] == F.get("_s", j)["h"], F.lit(False))
    rows = rows.withColumn("_w", _words(text)).withColumn("n_words", F.size("_w").cast("long"))
    rows = rows.withColumn("_h", F.when(
        F.col("n_words") >= window, F.transform(F.sequence(F.lit(0), F.size("_w") - window), at)))
    rows = rows.withColumn("_s", F.when(
        F.size("_h") > F.size(F.array_distinct("_h")),
        F.array_sort(F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    rows = rows.withColumn("_p", F.array_sort(F.transform(
        F.filter("_s", lambda e, j: same(e, j - 1) | same(e, j + 1)), lambda e: e["i"])))
    # A repeated window adds the words up to the next one's start, at most its own length.
    covered = F.aggregate(
        F.transform("_p", lambda p, j: F.least(F.lit(window), F.coalesce(F.get("_p", j + 1) - p, F.lit(window)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.withColumn("_l", lines).select(
        *[c for c in rows.columns if not c.startswith("_")],
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    ).withColumn("base_failed", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words"))


def _documents(docs: DataFrame) -> DataFrame:
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(docs["doc_id"].alias("doc_id"), docs["source"].alias("host"), text.alias("text"),
                       F.xxhash64(text).alias("version"))


def _lines(rows: DataFrame) -> DataFrame:
    """Each line with a word: its hash, its place in the document and its number of words."""
    full = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    line = F.transform(full, lambda x: F.struct(_line_hash(x).alias("line"), F.size(_words(x)).alias("words")))
    return rows.select("doc_id", "host", "version", F.posexplode(line).alias("place", "x")).select(
        "doc_id", "host", "version", "place", "x.line", "x.words")


def frequent_lines(docs: DataFrame, min_docs: int = 20) -> DataFrame:
    """``host, line, n_docs`` of the lines above the limit."""
    return _lines(_documents(docs)).groupBy("host", "line").agg(F.countDistinct("version").alias("n_docs")).filter(
        F.col("n_docs") > min_docs)


def quality_rules(docs: DataFrame, min_docs: int = 20, max_lost: float = 0.8) -> DataFrame:
    """One row per document: the base counts, ``lost_words``, ``kept`` and the text without frequent lines.

    ``cleaned`` costs an exchange of the texts; it is pruned when not selected.
    """
    rows = _documents(docs)
    frequent = frequent_lines(docs, min_docs).select(F.col("host").alias("_h"), F.col("line").alias("_l"))
    key = ["doc_id", "host", "version"]
    # As a set, so that repeated rows, whose lines are the same, lose each line once.
    lost = _lines(rows).join(frequent, F.col("host").eqNullSafe(F.col("_h")) & (F.col("line") == F.col("_l"))) \
        .groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(
            F.collect_set(F.struct("place", "line", "words")).alias("_gone"))
    out = base_counts(rows).join(lost, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]), "left")
    left = F.filter(F.split("text", "\n"), lambda x: ~F.array_contains("_gone.line", _line_hash(x)))
    lost_words = F.coalesce(F.aggregate("_gone", F.lit(0).cast("long"), lambda a, x: a + x["words"]), F.lit(0))
    return out.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        lost_words.cast("long").alias("lost_words"),
        (~F.col("base_failed") & (lost_words <= max_lost * F.col("n_words"))).alias("kept"),
        F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias("cleaned"))
