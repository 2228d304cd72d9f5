"""Whitening against eigenvectors of numpy, polynomials against integer determinants, odd rows."""

import os
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm.queries import QUERIES
from corpusloom.llm.whitening import Scatter, characteristic_polynomial, isolated_root, null_vectors, primes_below, roots_above, scatter, whiten

FOLDER = "/root/testdata/sf0.001"


def rows_of(spark, vectors, start=0):
    data = [(start + k, None if v is None else [None if e is None else float(e) for e in v], "own") for k, v in enumerate(vectors)]
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, whitened string").withColumn("n", F.lit("own")).repartition(3)


def fraction_polynomial(matrix):
    """Faddeev and LeVerrier's recursion, in fractions."""
    size = len(matrix)
    identity = [[Fraction(i == j) for j in range(size)] for i in range(size)]

    def product(a, b):
        return [[sum(x * y for x, y in zip(row, column)) for column in zip(*b)] for row in a]

    found, m = [Fraction(1)], [[Fraction(0)] * size for _ in range(size)]
    for k in range(1, size + 1):
        m = [[x + found[-1] * y for x, y in zip(a, b)] for a, b in zip(product(matrix, m), identity)]
        found.append(-sum(row[i] for i, row in enumerate(product(matrix, m))) / k)
    return [int(c) for c in found]


def test_polynomial_like_fractions(spark):
    rng = random.Random(4)
    for size, top in ((1, 5), (2, 9), (5, 10**9), (7, 3)):
        half = [[rng.randint(-top, top) for _ in range(max(1, size - (top == 3)))] for _ in range(size)]
        matrix = [[sum(a * b for a, b in zip(x, y)) for y in half] for x in half]
        assert characteristic_polynomial(spark, matrix) == fraction_polynomial(matrix)


def test_primes():
    found = primes_below(1 << 31, 300)
    assert found[0] == 2**31 - 1 and found == sorted(found, reverse=True)
    assert all(all(p % d for d in range(2, 2000)) for p in found)


def test_roots_are_counted_isolated_and_may_coincide():
    # (x - 2)(x - 7)^3 (x - 7000001)
    coefficients = [1]
    for root in (2, 7, 7, 7, 7_000_001):
        coefficients = [a - root * b for a, b in zip([*coefficients, 0], [0, *coefficients])]
    assert [roots_above(coefficients, at) for at in (0, 2, 3, 7, 8, 7_000_001)] == [5, 4, 4, 1, 1, 0]
    for k, want, first, last in ((1, 7_000_001, 1, 1), (2, 7, 2, 4), (4, 7, 2, 4), (5, 2, 5, 5)):
        root, low, high = isolated_root(coefficients, k, 128)
        assert (low, high) == (first, last) and abs(Fraction(root, 1 << 128) - want) < Fraction(1, 1 << 100)


def test_vectors_of_a_repeated_root_are_orthonormal():
    matrix = [[5, 0, 0, 0], [0, 5, 0, 0], [0, 0, 2, 1], [0, 0, 1, 2]]
    found = np.array([[v / 2**320 for v in row] for row in null_vectors(matrix, 5 << 128, 128, 2)])
    assert np.allclose(found @ found.T, np.eye(2), atol=1e-15) and np.allclose(found @ np.array(matrix), 5 * found, atol=1e-14)


def plain(vectors):
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)) + 1_000_000
    centred = x - x.mean(axis=0)
    values, components = np.linalg.eigh(centred.T @ centred / len(x))
    return x, centred, values[::-1], components[:, ::-1]


def test_whitened_like_numpy(spark):
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(300, 7)) @ rng.normal(size=(7, 7)) + 3).tolist()
    vectors += vectors[:2]
    x, centred, values, components = plain(vectors)
    odd = [None, [], [1.0] * 6, [None] + [1.0] * 6, [float("nan")] * 7, [float("inf")] + [0.0] * 6, [3e38] * 7]
    found = whiten(rows_of(spark, vectors + odd)).toPandas().sort_values(["vec_id", "component"])
    assert set(found["vec_id"]) == set(range(302)) and (found["n"] == 302).all() and (found["identity_error"] < 1e-9).all()
    deviation = ((302 * x - x.sum(axis=0)) ** 2).sum(axis=1).astype(int)
    assert found["deviation"].tolist() == np.repeat(deviation, 7).tolist()
    assert np.allclose(found["explained"].to_numpy()[:7], values / values.sum(), rtol=1e-10)
    ours, theirs = found["whitened"].to_numpy().reshape(302, 7), centred @ components / np.sqrt(values)
    for k in range(7):
        sign = 1 if ours[0, k] * theirs[0, k] > 0 else -1
        assert np.allclose(ours[:, k], sign * theirs[:, k], atol=1e-8)


def test_dimensions_without_spread_and_equal_eigenvalues(spark):
    corners = [[a, b, c, 4.0, a + b] for a in (-1, 1) for b in (-1, 1) for c in (-1, 1)]
    found = whiten(rows_of(spark, corners)).toPandas()
    assert sorted(set(found["component"])) == [1, 2, 3] and len(found) == 24 and found["identity_error"].max() < 1e-12
    square = whiten(rows_of(spark, [[a, b] for a in (-1, 1) for b in (-1, 1)])).toPandas()
    assert set(square["explained"].round(12)) == {0.5} and square["identity_error"].max() < 1e-12
    few = whiten(rows_of(spark, corners), components=2).toPandas()
    assert sorted(set(few["component"])) == [1, 2]


def test_nothing_to_whiten(spark):
    for vectors in ([[1.0, 2.0]] * 3, [None, [None, 1.0]], [[]]):
        assert whiten(rows_of(spark, vectors)).count() == 0
    assert whiten(rows_of(spark, [[1.0]]).limit(0)).count() == 0


def test_large_entries_stay_exact(spark):
    vectors = [[2.0**40, 1.0], [2.0**41, -1.0], [2.0**42, 2.0], [2.0**30, 5.0]]
    found = scatter(rows_of(spark, vectors), 2)
    x = [[int(64 * e) for e in v] for v in vectors]
    sums = [sum(v[i] for v in x) for i in range(2)]
    assert isinstance(found, Scatter) and found.sums == sums
    assert found.matrix == [[4 * sum(v[i] * v[j] for v in x) - sums[i] * sums[j] for j in range(2)] for i in range(2)]
    assert whiten(rows_of(spark, vectors)).count() == 8


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no benchmark tables here")
def test_query_like_numpy(spark):
    data = spark.read.parquet(f"{FOLDER}/embeddings.parquet").orderBy("vec_id").toPandas()
    x, centred, values, components = plain(data["embedding"].tolist())
    found = QUERIES["op11_embedding_whitening"](spark, FOLDER).toPandas().sort_values(["vec_id", "component"])
    assert len(found) == 32 * len(x) and found["identity_error"].max() < 1e-9
    ours, theirs = found["whitened"].to_numpy().reshape(len(x), 32), (centred @ components / np.sqrt(values))[:, :32]
    signs = np.sign((ours * theirs).sum(axis=0))
    assert np.allclose(ours, theirs * signs, atol=1e-6)
    assert np.allclose(found["explained"].to_numpy()[:32], values[:32] / values.sum(), rtol=1e-9)
