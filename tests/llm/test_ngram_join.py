"""The chosen-path join against all pairs."""

import itertools
import random
import re

import numpy as np
import pytest

from fieldseason.llm import ngram_join, queries


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    width = min(5, len(words))
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if words else set()


def brute(texts):
    """``{doc: (class, links)}`` by comparing all pairs."""
    sets, up, links = {d: shingles(t) for d, t in texts.items()}, {d: d for d in texts}, dict.fromkeys(texts, 0)

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(texts), 2):
        both = len(sets[a] & sets[b])
        if both and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
            links[a] += 1
            links[b] += 1
            a, b = sorted((root(a), root(b)))
            up[b] = a
    return {d: (root(d), links[d]) for d in texts}


def found(docs):
    return {r["doc_id"]: (r["class_id"], r["links"]) for r in ngram_join.near_classes(docs).collect()}


def test_op4_is_the_all_pairs_result(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op4_ngram_join(spark, sf).collect()
    assert {r["doc_id"]: (r["class_id"], r["links"]) for r in rows} == brute(texts)


def test_a_large_group_of_near_copies(docs_of, monkeypatch):
    """More near copies than a bucket or a block holds, some below the threshold of one another."""
    monkeypatch.setattr(ngram_join, "LIMIT", 16)
    monkeypatch.setattr(ngram_join, "BLOCK", 50)
    rng = random.Random(6)
    base, rows = [f"b{i}" for i in range(90)], []
    for i in range(220):
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            words[rng.randrange(90)] = f"n{rng.randrange(1000)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(base[:12] + [f"o{i}_{k}" for k in range(60)])) for i in range(60)]
    expected, got = brute(dict(rows)), found(docs_of(*rows))
    assert sum(n for _, n in expected.values()) > 1000
    assert got == expected


def test_a_group_of_near_copies_is_not_split(docs_of, monkeypatch):
    """What is one group already is dealt over pieces with the few others, not split in each run; no link is lost."""
    monkeypatch.setattr(ngram_join, "LIMIT", 16)
    rng, made, split = random.Random(7), [], ngram_join._split

    def counted(large):
        out = split(large)
        made.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "_split", counted)
    base, rows = [f"b{i}" for i in range(90)], []
    for i in range(150):
        words = list(base)
        words[rng.randrange(90)] = f"n{i}"
        rows.append((i, " ".join(words)))
    # Some linked to a part of the group only, and some to none of it.
    rows += [(200 + i, " ".join(base[:80 - i] + [f"o{i}_{k}" for k in range(i)])) for i in range(12)]
    expected, got = brute(dict(rows)), found(docs_of(*rows))
    assert {0 < n < 149 for d, (_, n) in expected.items() if d >= 200} == {True, False}
    assert got == expected
    assert sum(made) <= len(rows)


def test_settled_buckets(spark, monkeypatch):
    """All pairs of a settled bucket that are not of its largest group meet in a piece."""
    monkeypatch.setattr(ngram_join, "LIMIT", 16)
    large = spark.createDataFrame(
        [(1, i, 100) for i in range(100)] + [(2, i, 60) for i in range(60)] + [(3, i, 50) for i in range(70, 120)], "path long, rep long, n long")
    groups = spark.createDataFrame([(i, 0) for i in range(88)], "node long, label long")
    settled = ngram_join._settled(large, groups)
    assert {tuple(r) for r in settled.collect()} == {(1, 0), (2, 0)}
    pieces, inside = {}, set()
    for r in ngram_join._pieces(large.filter("path = 1"), settled, groups).collect():
        pieces.setdefault(r["path"], set()).add(r["rep"])
        inside |= {r["rep"]} if r["inside"] else set()
    assert inside == set(range(88))
    assert len(pieces) == 7 and max(map(len, pieces.values())) < 50
    assert set.union(*pieces.values()) == set(range(100))
    meet = {pair for members in pieces.values() for pair in itertools.combinations(sorted(members), 2)}
    assert {(a, b) for a, b in itertools.combinations(range(100), 2) if b >= 88} <= meet


@pytest.mark.parametrize("change", [1, 2, 3, 4])
def test_pairs_about_the_threshold(docs_of, change):
    """Pairs whose similarity is just over or under 0.8, decided exactly."""
    rng, rows = random.Random(change), []
    for i in range(120):
        words = [f"d{i}_{k}" for k in range(rng.randrange(6, 70))]
        other = words[:-change] + [f"e{i}_{k}" for k in range(rng.randrange(0, 2 * change))]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, "\n".join(other))]
    assert found(docs_of(*rows)) == brute(dict(rows))


def test_chance_of_meeting():
    """Measured over random sets, the chance is what the number of runs was computed from."""
    rng, hits, trials = np.random.default_rng(8), 0, 400
    for _ in range(trials):
        a = rng.integers(0, 2**63, ngram_join.TOKENS, np.uint64)
        b = np.where(rng.random(ngram_join.TOKENS) < 0.8, a, a + np.uint64(1))
        paths = {int(rng.integers(0, 2**62))}
        for _ in range(ngram_join.MAX_DEPTH):
            now = np.array(sorted(paths), np.uint64)
            kids = [set(ngram_join.children(now, np.broadcast_to(x, (len(now), len(x))))[1].tolist()) for x in (a, b)]
            paths = kids[0] & kids[1]
            if not paths:
                break
        hits += bool(paths)
    assert abs(hits / trials - ngram_join.met(0.8, ngram_join.MAX_DEPTH)) < 0.08
    runs = ngram_join.runs_for(0.999, 0.8)
    assert ngram_join.missed(runs, 0.8, ngram_join.MAX_DEPTH) <= 0.001 < ngram_join.missed(runs - 1, 0.8, ngram_join.MAX_DEPTH)


def test_chance_of_missing_over_all_runs():
    """All runs of a pair share its tokens; what is left out over many pairs is what ``missed`` says."""
    rng, runs, depth, lost, trials = np.random.default_rng(9), 5, 6, 0, 1500
    roots = rng.integers(0, 2**62, (trials, runs)).astype(np.uint64)
    for t in range(trials):
        a = rng.integers(0, 2**63, ngram_join.TOKENS, np.uint64)
        b = np.where(rng.random(ngram_join.TOKENS) < 0.8, a, a + np.uint64(1))
        now = roots[t]
        for _ in range(depth):
            kids = [set(ngram_join.children(now, np.broadcast_to(x, (len(now), len(x))))[1].tolist()) for x in (a, b)]
            now = np.array(sorted(kids[0] & kids[1]), np.uint64)
            if not len(now):
                break
        lost += not len(now)
    assert abs(lost / trials - ngram_join.missed(runs, 0.8, depth)) < 0.03


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_no_link_is_lost_on_larger_tables(spark, scale):
    """Against all pairs that share a shingle, found by an inverted index."""
    folder = f"/root/testdata/{scale}"
    sets = {r["doc_id"]: shingles(r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    holders, links = {}, dict.fromkeys(sets, 0)
    for doc, own in sets.items():
        for x in own:
            holders.setdefault(x, []).append(doc)
    for doc, own in sets.items():
        shared = {}
        for x in own:
            for other in holders[x]:
                shared[other] = shared.get(other, 0) + 1
        links[doc] = sum(5 * n >= 4 * (len(own) + len(sets[o]) - n) for o, n in shared.items() if o != doc)
    assert {r["doc_id"]: r["links"] for r in queries.op4_ngram_join(spark, folder).collect()} == links


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 7), (200, 201), (201, 202), (5, 5)]
    frame = spark.createDataFrame(edges, "a long, b long")
    labels = {r["node"]: r["label"] for r in ngram_join.components(frame).collect()}
    assert labels == dict.fromkeys([*range(61), 100], 0) | dict.fromkeys([200, 201, 202], 200)
    assert ngram_join.components(frame.filter("a < 0")).collect() == []
