"""Whitening against a dense eigendecomposition and exact sums."""

import math
import random

import numpy as np
import pytest

from fieldseason.llm import whitening
from fieldseason.llm.queries import op12_whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def dense(vectors):
    x = np.floor(1024 * np.array(vectors, float)) + 100_000
    x = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(x.T @ x / len(x))
    return values[::-1], axes[:, ::-1], x


def check(rows, table, components=8):
    ids, vectors = [i for i, _ in table], [[float(np.float32(v)) for v in vec] for _, vec in table]
    values, axes, x = dense(vectors)
    whole = [[math.floor(1024 * v) + 100_000 for v in vec] for vec in vectors]
    n, sums = len(whole), [sum(c) for c in zip(*whole, strict=True)]
    deviation = {i: sum((n * v - s) ** 2 for v, s in zip(vec, sums, strict=True)) for i, vec in zip(ids, whole, strict=True)}
    k = min(components, len(sums), sum(v > 1e-12 * values.sum() for v in values))
    assert len(rows) == n * k
    white = {}
    for r in rows:
        assert (r["n"], r["deviation"]) == (n, deviation[r["vec_id"]])
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-10)
        assert r["identity_error"] < 1e-9
        white[r["vec_id"], r["component"]] = r["whitened"]
    for c in range(k):
        found = np.array([white[i, c + 1] for i in ids])
        best = x @ axes[:, c] / math.sqrt(values[c])
        assert min(np.abs(found - best).max(), np.abs(found + best).max()) < 1e-6


@pytest.mark.parametrize("d", [1, 2, 5, 8, 40])
def test_against_a_dense_solver(spark, d):
    rng = random.Random(d)
    table = [(i, [rng.gauss(0, 1 / (j + 1)) + j for j in range(d)]) for i in range(300)]
    check(whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in table], SCHEMA).repartition(7)).collect(), table)


def test_whole_table(spark, sf):
    table = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    rows = op12_whitening(spark, sf).collect()
    check(rows, table)
    assert all(r["deviation"] == int(r["deviation_exact"]) for r in rows)


def test_odd_vectors(spark):
    rng = random.Random(3)
    good = [(i, [rng.random() for _ in range(4)]) for i in range(30)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [math.nan, 0.0, 0.0, 0.0]), (104, [math.inf, 0.0, 0.0, 0.0]),
           (105, [1.0, 2.0]), (106, [1e20, 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame([(i, v, None) for i, v in good + bad], SCHEMA).selectExpr("*", "'x' as x", "'y' as length", "0 as rows")
    check(whitening.whiten(frame).collect(), good)
    again = spark.createDataFrame([(None, v, None) for _, v in good + good], SCHEMA)
    rows = whitening.whiten(again).collect()
    assert len(rows) == 240 and {r["n"] for r in rows} == {60} and {r["vec_id"] for r in rows} == {None}


def test_nothing_to_whiten(spark):
    make = lambda *v: whitening.whiten(spark.createDataFrame([(i, x, 0) for i, x in enumerate(v)], SCHEMA)).collect()
    assert make() == [] and make(None) == [] and make([1.0, 2.0]) == [] and make([1.0, 2.0], [1.0, 2.0]) == []
    flat = make([0.0, 1.0], [0.0, 3.0])
    assert [(r["component"], abs(r["whitened"]), r["explained"]) for r in flat] == [(1, 1.0, 1.0)] * 2


def test_large_entries_stay_exact(spark):
    table = [(i, [2.0**38 * (i % 3), float(i)]) for i in range(5000)]
    n, whole = len(table), [[math.floor(1024 * v) + 100_000 for v in vec] for _, vec in table]
    sums = [sum(c) for c in zip(*whole, strict=True)]
    rows = whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in table], SCHEMA)).collect()
    assert {r["vec_id"]: int(r["deviation"]) for r in rows} == {
        i: sum((n * v - s) ** 2 for v, s in zip(whole[i], sums, strict=True)) for i in range(n)}


def products(matrix, seen):
    def times(u):
        seen.append(u.shape[1])
        return matrix @ u

    return times


@pytest.mark.parametrize("spectrum", ["slow", "clustered", "multiple", "low rank"])
def test_residuals_reach_double_precision(spectrum):
    rng = np.random.default_rng(4)
    d = 300
    values = {"slow": np.linspace(2, 1, d), "clustered": np.r_[1 + 1e-6 * np.arange(12), np.linspace(0.5, 0.1, d - 12)],
              "multiple": np.r_[[3.0] * 10, [1.0] * (d - 10)], "low rank": np.r_[[5.0, 4.0, 3.0], np.zeros(d - 3)]}[spectrum]
    basis = np.linalg.qr(rng.standard_normal((d, d)))[0]
    matrix, seen = (basis * values) @ basis.T, []
    found, vectors = whitening.leading_components(products(matrix, seen), d, float(values.sum()))
    best = np.sort(values)[::-1][:8]
    best = best[best > 0]
    assert np.abs(found - best).max() < 1e-13 * best[0] * 10
    assert np.linalg.norm(matrix @ vectors - vectors * found, axis=0).max() < 2 * 32 * 2.3e-16 * math.sqrt(d) * best[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-13


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(5)
    basis = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    matrix = (basis * np.r_[np.linspace(-3, -1, 10), np.linspace(1, 4, 20)]) @ basis.T
    right = rng.standard_normal((30, 3))
    found = whitening.minres(lambda z: matrix @ z, right, 30, 0.0)
    assert np.abs(found - np.linalg.solve(matrix, right)).max() < 1e-8
    zero = whitening.minres(lambda z: matrix @ z, np.zeros((30, 1)), 5)
    assert np.isfinite(zero).all() and not zero.any()
