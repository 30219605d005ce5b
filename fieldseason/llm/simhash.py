"""Near duplicates by SimHash, found by covering locality-sensitive hashing.

1. ``fingerprints``: a text's words (A to Z in lower case, split at ASCII white space) give shingles
   of ``width`` words, repeats included; a bit is 1 if it is set in over half of the shingles'
   XXH64 hashes. A text of fewer words is one shingle, one without words has fingerprint 0.
2. Equal fingerprints are one node. ``covering_masks`` gives ``2 ** (radius + 1) - 1`` masks over the
   bits: bit ``i`` carries a vector ``m(i)`` of ``radius + 1`` bits, mask ``v`` keeps the bits with an odd
   ``m(i) & v``. For the differing bits of a pair within the radius, at most ``radius`` vectors, some
   ``v`` is even with all of them, so the pair agrees on mask ``v`` and meets in that table: no link
   is left to chance.
3. A bucket holds the fingerprints that agree on a mask. Small buckets are compared in whole. Large
   ones are covered again over the bits their mask leaves free, which keeps the guarantee and about
   halves the free bits, until at most ``FREE`` are left: such a bucket has ``2 ** FREE`` fingerprints at most.
   Only spanning forests of the links leave a task, never all pairs.
4. The forests are joined to components, named by their smallest document id.

Null text is the empty text. Repeated rows get equal results. A null id takes part, and names a
component only if that has no other id. An empty table gives no row. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldseason.llm.common import map_rows, stored, texts
from fieldseason.llm.ngram_join import components

BITS, RADIUS, WIDTH, SEED = 64, 4, 4, 42
#: A bucket above ``LIMIT`` fingerprints is covered again unless no more than ``FREE`` of its bits differ.
LIMIT, FREE = 1_024, 16
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_SPACES = dict.fromkeys((9, 10, 11, 12, 13), " ")
_CHUNK = 1 << 16


def fingerprint(text: str, width: int = WIDTH) -> int:
    import xxhash

    words = [w.encode("utf-8", "surrogatepass") for w in text.translate(_LOWER | _SPACES).split(" ") if w]
    if not words:
        return 0
    whole, n = b" ".join(words), len(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts, width = (ends - [len(w) + 1 for w in words]).tolist(), min(width, n)
    ends, digest = (ends - 1).tolist(), xxhash.xxh64_intdigest
    counts, total = np.zeros(BITS, np.int64), n - width + 1
    for first in range(0, total, _CHUNK):  # a very long text's hashes are counted part by part
        last = min(first + _CHUNK, total)
        hashes = np.array([digest(whole[a:b], SEED) for a, b in zip(starts[first:last], ends[first + width - 1:], strict=False)], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, fp``: the fingerprint of each whole text, as a signed long."""

    def make() -> Callable[[dict], dict]:
        def work(rows: dict) -> dict:
            found = np.array([fingerprint(t, width) for t in rows["text"]], np.uint64)
            return {"doc_id": rows["doc_id"], "fp": found.view(np.int64).tolist()}

        return work

    return map_rows(texts(docs), make, "doc_id long, fp long")


def covering_masks(free: int, radius: int = RADIUS) -> list[int]:
    """Masks over the set bits of ``free`` such that any ``radius`` of them lie outside some mask."""
    bits = [i for i in range(BITS) if free >> i & 1]
    vectors = 2 ** (radius + 1) - 1
    return [sum(1 << bit for k, bit in enumerate(bits) if ((k % vectors + 1) & v).bit_count() % 2) for v in range(1, vectors + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Label propagation in place: rows linked by ``a, b`` get the smallest row of what they reach."""
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while not np.array_equal(label, up := label[label]):
            label[:] = up
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]


def bucket_forest(bucket: np.ndarray, fp: np.ndarray, radius: int) -> np.ndarray:
    """For each row, the row that stands for it among the rows of its bucket it is linked to.

    Rows of a bucket follow one another; they are compared at each distance up to a bucket's size.
    """
    label = np.arange(len(fp))
    held, pairs = [], 0
    alive = np.arange(len(fp))
    for lag in range(1, len(fp)):
        alive = alive[alive < len(fp) - lag]
        alive = alive[bucket[alive] == bucket[alive + lag]]
        if not len(alive):
            break
        good = alive[np.bitwise_count(fp[alive] ^ fp[alive + lag]) <= radius]
        good = good[label[good] != label[good + lag]]
        held.append((good, good + lag))
        pairs += len(good)
        if pairs > 4 * len(fp):
            _joined(label, *(np.concatenate(x) for x in zip(*held, strict=True)))
            held, pairs = [], 0
    if held:
        _joined(label, *(np.concatenate(x) for x in zip(*held, strict=True)))
    return label


def _compare(rows: DataFrame, radius: int) -> DataFrame:
    """Links ``a, b`` between fingerprints of one bucket, from ``mask, key, fp`` sorted within partitions."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def edges(bucket: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        label = bucket_forest(bucket, fp, radius)
        row = np.flatnonzero(label != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[x].view(np.int64)) for x in (label[row], row)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, fp, last, at = np.zeros(0, np.int64), np.zeros(0, np.uint64), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            mask, key, more = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("mask", "key", "fp"))
            new = np.r_[last != (mask[0], key[0]), (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])]
            numbers = at + np.cumsum(new)
            last, at = (mask[-1], key[-1]), int(numbers[-1])
            bucket, fp = np.concatenate([bucket, numbers]), np.concatenate([fp, more.view(np.uint64)])
            whole = int(np.searchsorted(bucket, at))  # the last bucket may go on
            if whole:
                yield edges(bucket[:whole], fp[:whole])
                bucket, fp = bucket[whole:], fp[whole:]
        if len(fp):
            yield edges(bucket, fp)

    return rows.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp").mapInArrow(run, "a long, b long")


def _covered(fps: DataFrame, radius: int, masks: list[int]) -> DataFrame:
    """``mask, key, fp`` of fingerprints in buckets of no bit, or of ``masks``, covered over their free bits."""
    def finer(mask: int) -> list[int]:
        return [_signed(mask | m) for m in covering_masks(~mask & (1 << BITS) - 1, radius)]

    if masks == [0]:
        rows = fps.withColumn("m", F.explode(F.lit(finer(0))))
    else:
        # At most 31 masks, or 961, of 31 finer ones each: a constant, whatever the data are.
        table = fps.sparkSession.createDataFrame([(_signed(m), finer(m)) for m in masks], "mask long, ms array<long>")
        rows = fps.join(F.broadcast(table), "mask").withColumn("m", F.explode("ms"))
    return rows.select(F.col("m").alias("mask"), F.col("fp").bitwiseAND(F.col("m")).alias("key"), "fp")


def links(fps: DataFrame, radius: int = RADIUS, limit: int = LIMIT, free: int = FREE) -> DataFrame:
    """Forests ``a, b`` of all links between different values of ``fp``, each value given once."""
    found, level, masks = [], fps.select("fp"), [0]
    while True:
        rows = _covered(level, radius, masks)
        if masks != [0]:
            rows = rows.distinct()  # other tables may lead to the same bucket
        masks = sorted({m | f for m in masks for f in covering_masks(~m & (1 << BITS) - 1, radius)})
        splits = [_signed(m) for m in masks if BITS - m.bit_count() > free]
        large = stored(rows.groupBy("mask", "key").count().filter(F.col("count") > limit).filter(
            F.col("mask").isin(splits) if splits else F.lit(False)).select("mask", "key"))
        if not splits or large.isEmpty():
            found.append(_compare(rows, radius))
            break
        found.append(_compare(rows.join(large, ["mask", "key"], "left_anti"), radius))
        level = stored(rows.join(large, ["mask", "key"], "left_semi").select("mask", "fp").distinct())
        masks = [m for m in masks if BITS - m.bit_count() > free]
    return reduce(DataFrame.union, found)


def near_components(docs: DataFrame, radius: int = RADIUS, limit: int = LIMIT) -> DataFrame:
    """One row per document: ``doc_id, fp`` and ``component_id``."""
    marked = stored(fingerprints(docs))
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    labels = components(links(nodes, radius, limit))
    named = nodes.join(labels, F.col("fp") == F.col("node"), "left").select(
        F.col("fp").alias("_fp"), "least", F.coalesce("label", "fp").alias("label"))
    least = named.groupBy(F.col("label").alias("_label")).agg(F.min("least").alias("component_id"))
    named = named.join(least, F.col("label") == F.col("_label")).select("_fp", "component_id")
    return marked.join(named, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id")
