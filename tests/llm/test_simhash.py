"""SimHash components against all pairs, and the guarantee of the covering masks."""

import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from fieldseason.llm import simhash
from fieldseason.llm.queries import op13_simhash


def fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass"), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps):
    """``{fingerprint: representative}`` by all pairs."""
    values = sorted(set(fps))
    up = {f: f for f in values}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    array = np.array(values, np.uint64)
    for i, f in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(array[:i] ^ array[i]) <= 4):
            up[root(f)] = root(values[j])
    return {f: root(f) for f in values}


def expected(rows):
    fps = [fingerprint(t) for _, t in rows]
    of, least = components(fps), {}
    for (doc, _), f in zip(rows, fps, strict=True):
        if doc is not None:
            least[of[f]] = min(doc, least.get(of[f], doc))
    return sorted(((doc, f"{f:016x}", least.get(of[f])) for (doc, _), f in zip(rows, fps, strict=True)), key=str)


@pytest.mark.parametrize("free", [2**64 - 1, 0xFFFFFFFF, 0x0F0F0F0F0F0F0F0F, 0x3FF])
def test_every_choice_of_four_bits_lies_outside_a_mask(free):
    masks, bits = simhash.covering_masks(free), [i for i in range(64) if free >> i & 1]
    assert len(masks) == 31 and all(m & ~free == 0 for m in masks)
    rng = random.Random(1)
    choices = itertools.combinations(bits, 4) if len(bits) < 33 else [rng.sample(bits, 4) for _ in range(50_000)]
    outside = [~m for m in masks]
    for chosen in choices:
        x = sum(1 << b for b in chosen)
        assert any(x & o == x for o in outside)


def test_finer_masks_leave_few_bits():
    for mask in simhash.covering_masks(2**64 - 1):
        for finer in simhash.covering_masks(~mask & 2**64 - 1):
            assert 64 - (mask | finer).bit_count() <= simhash.FREE


@pytest.mark.parametrize("limit", [2, 40, 5_000])
def test_dense_and_far_fingerprints_at_any_limit(spark, limit):
    rng = random.Random(limit)
    seeds = [rng.getrandbits(64) for _ in range(3)]
    fps = {rng.getrandbits(64) for _ in range(200)} | {0, 2**64 - 1}
    for seed in seeds:
        for _ in range(400):
            x = seed
            for bit in rng.sample(range(64), rng.choice([1, 2, 3, 4, 5, 7])):
                x ^= 1 << bit
            fps.add(x)
    rows = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    up = {f: f for f in fps}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for r in simhash.links(rows, limit=limit).distinct().collect():
        a, b = r["a"] % 2**64, r["b"] % 2**64
        up[root(a)] = root(b)
    of = components(fps)
    groups = lambda f: sorted(sorted(x for x in fps if f(x) == r) for r in {f(x) for x in fps})
    assert groups(root) == groups(of.get)


def test_a_bucket_of_many_links_is_joined():
    fp = np.arange(3000, dtype=np.uint64)  # neighbours of one bit chain them all
    assert (simhash.bucket_forest(np.zeros(3000, int), fp, 1) == 0).all()
    apart = np.array([0, 0b11111, 0b11], np.uint64)
    assert simhash.bucket_forest(np.zeros(3, int), apart, 2).tolist() == [0, 1, 0]
    assert simhash.bucket_forest(np.array([0, 1, 2]), apart, 64).tolist() == [0, 1, 2]


def test_odd_rows(spark, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    found = sorted(((r["doc_id"], f"{r['fp'] % 2**64:016x}", r["component_id"]) for r in simhash.near_components(odd).collect()), key=str)
    assert found == expected(rows)
    assert simhash.near_components(odd.filter("doc_id = -5")).collect() == []


def test_whole_table_against_all_pairs(spark, sf):
    for folder in (sf, sf.replace("0.001", "0.01")):
        rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
        found = sorted((tuple(r) for r in op13_simhash(spark, folder).collect()), key=str)
        assert found == expected(rows)
        assert len({c for _, _, c in found}) < len(found)


def test_a_very_long_text_is_counted_in_parts():
    text = " ".join(str(i) for i in range(simhash._CHUNK + 1000))
    assert simhash.fingerprint(text) == fingerprint(text)
