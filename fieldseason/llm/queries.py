"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldseason.llm import (
    bpe, exact_dedup, fm_quality, langid, ngram_join, packing, pii, prefix_trie, quality_rules, simhash, token_counts, toxicity,
    whitening,
)
from fieldseason.llm.common import id_crc, table

Query = Callable[[SparkSession, str], DataFrame]


def _judged(scored: DataFrame, parts: int, held: int, threshold: float) -> DataFrame:
    return scored.select("doc_id", (id_crc("doc_id") % parts == held).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(id_crc("doc_id") % 4 != 2))
    return _judged(toxicity.score(docs, model), 4, 2, 0.3)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dictionaries = langid.train(docs.filter(id_crc("doc_id") % 3 != 1))
    found = langid.identify(docs, dictionaries)
    return found.select("doc_id", (id_crc("doc_id") % 3 == 1).alias("held_out"), "lang_pred", "score", "rejected")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_classes(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_digests(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(bpe.encode(table(spark, sf_dir, "documents")))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fm_quality.train(docs, labels.filter(id_crc("doc_id") % 3 != 1))
    return _judged(fm_quality.score(docs, model), 3, 1, 0.5)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find_pii(table(spark, sf_dir, "documents")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept", "lost_words")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(prefix_trie.turn_paths(table(spark, sf_dir, "conversations")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` is null where a long cannot hold it; ``deviation_exact`` always has it."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "component", "n", F.col("deviation").try_cast("long").alias("deviation"), "whitened", "explained",
                        "identity_error", F.col("deviation").alias("deviation_exact"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def registry() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_toxicity, op2_language, op3_token_counts, op4_ngram_join, op5_packing, op6_byte_bpe, op7_exact_dedup, op8_quality,
        op9_pii, op10_quality_rules, op11_prefix_trie, op12_whitening, op13_simhash)}
