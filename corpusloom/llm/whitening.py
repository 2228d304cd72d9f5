"""Whitening of embeddings by the exact characteristic polynomial of their integer scatter.

Entries become integers, so n times the scatter of all vectors is a matrix of exact
integers. Its characteristic polynomial is computed modulo primes by reduction to
Hessenberg form, primes dealt out to tasks, and put together by Chinese remainders. As
the matrix is symmetric, all roots are real, and by Descartes' rule the changes of sign
of the polynomial moved to a point count exactly the roots above it. A task per
component isolates its root, narrows it, and finds its vector by inverse iteration in
whole-number arithmetic of several hundred bits.

At scale: one pass over the vectors sums up states of a fixed size per task, one
measures the result, one writes it. Only matrices of the dimension reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import folded
from corpusloom.session import spread

COMPONENTS = 32
SCALE = 64
OFFSET = 1_000_000
# A root is known to so many bits; roots that agree in all of them count as one of that multiplicity.
ROOT_BITS = 120
_VECTOR_BITS = 320
_ITERATIONS = 3
_LIMBS = 6  # of 32 bits, per sum of a task
_FAST = 1 << 53


def whole_entries(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that remain, floor(64 c) of their entries) of a batch; a vector of another size does not remain."""
    column = batch["embedding"]
    lengths = np.diff(column.offsets.to_numpy())
    keep = (lengths == size) & column.is_valid().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(keep)
    at = column.offsets.to_numpy()[:-1][rows, None] + np.arange(size)
    values = column.values.cast(pa.float64())
    entries = values.fill_null(np.nan).to_numpy(zero_copy_only=False)[at] * SCALE
    # What is no 64-bit integer when scaled and moved is no finite entry either.
    fine = (np.isfinite(entries) & (np.abs(entries) < 2.0**62)).all(axis=1)
    return rows[fine], np.floor(entries[fine]).astype(np.int64)


def _limbs(values: list[int]) -> bytes:
    """Whole numbers as two's complement of a fixed number of bytes."""
    return b"".join(v.to_bytes(4 * _LIMBS, "little", signed=True) for v in values)


def _numbers(data: bytes) -> list[int]:
    width = 4 * _LIMBS
    return [int.from_bytes(data[at : at + width], "little", signed=True) for at in range(0, len(data), width)]


def _products(x: np.ndarray) -> list[int]:
    """Sums of x_i and of x_i x_j for i <= j over the rows, exact."""
    upper = np.triu_indices(x.shape[1])
    top = int(np.abs(x).max(initial=0))
    if top * top * len(x) < _FAST:
        floats = x.astype(np.float64)
        square = (floats.T @ floats).astype(np.int64)
    elif top * top * len(x) < 1 << 62:
        square = x.T @ x
    else:
        x = x.astype(object)
        square = x.T @ x
    return [int(v) for v in x.sum(axis=0)] + [int(v) for v in square[upper]]


def _added(states: Iterator[tuple[int, bytes]]) -> tuple[int, bytes]:
    n, total = 0, None
    for rows, state in states:
        numbers = _numbers(state)
        n, total = n + rows, numbers if total is None else [a + b for a, b in zip(total, numbers)]
    return n, _limbs(total or [])


class Scatter:
    """n, the sums of all dimensions, and n times the scatter matrix (n^2 times the covariance), all exact."""

    def __init__(self, n: int, size: int, numbers: list[int]):
        self.n, self.size = n, size
        self.sums = numbers[:size]
        self.matrix = [[0] * size for _ in range(size)]
        products = iter(numbers[size:])
        for i in range(size):
            for j in range(i, size):
                self.matrix[i][j] = self.matrix[j][i] = n * next(products) - self.sums[i] * self.sums[j]


def scatter(vectors: DataFrame, size: int) -> Scatter | None:
    """The scatter of all vectors of ``size`` entries; none if there are none."""

    def run(batches):
        n, total = 0, None
        for batch in batches:
            _, x = whole_entries(batch, size)
            for at in range(0, len(x), 4096):
                part = _products(x[at : at + 4096])
                n, total = n + len(x[at : at + 4096]), part if total is None else [a + b for a, b in zip(total, part)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([_limbs(total)], pa.binary())], names=["n", "state"])

    n, state = folded(vectors.mapInArrow(run, "n bigint, state binary"), _added)
    return Scatter(n, size, _numbers(state)) if n else None


# --- the polynomial ----------------------------------------------------------------


def _is_prime(n: int) -> bool:
    """Miller and Rabin's test with bases that decide all numbers below 2^32."""
    d, twos = n - 1, 0
    while d % 2 == 0:
        d, twos = d // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, d, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_below(start: int, bits: int) -> list[int]:
    """The largest primes below ``start`` whose product has more than ``bits`` bits."""
    found, have, n = [], 0.0, start - 1 - start % 2
    while have <= bits:
        if _is_prime(n):
            found.append(n)
            have += n.bit_length() - 1
        n -= 2
    return found


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x - matrix) modulo a prime below 2^31, highest first, by reduction to Hessenberg form."""
    h, size = matrix % p, len(matrix)
    for m in range(1, size - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        pivot = m + int(below[0])
        if pivot != m:
            h[[m, pivot]] = h[[pivot, m]]
            h[:, [m, pivot]] = h[:, [pivot, m]]
        factor = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - factor[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * factor % p).sum(axis=1)) % p
    # Row k holds the polynomial of the leading k by k block, lowest coefficient first.
    polys = np.zeros((size + 1, size + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, size + 1):
        made = np.r_[0, polys[k - 1, :-1]] - h[k - 1, k - 1] * polys[k - 1] % p
        product = 1
        for i in range(k - 1, 0, -1):
            product = product * int(h[i, i - 1]) % p
            if not product:
                break
            made = made - (int(h[i - 1, k - 1]) * product % p) * polys[i - 1] % p
        polys[k] = made % p
    return polys[size, ::-1].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(x - matrix) for a symmetric matrix that is nowhere negative, highest first.

    Such a coefficient is a sum of principal minors, at most the product of all (1 +
    diagonal entries), which says how many primes are needed.
    """
    size, bits = len(matrix), 2
    for i in range(size):
        bits += (1 + matrix[i][i]).bit_length()
    primes = primes_below(1 << 31, bits)
    text = [[str(v) for v in row] for row in matrix]

    def run(batches):
        whole = [[int(v) for v in row] for row in text]
        for batch in batches:
            for p in batch["p"].to_pylist():
                found = polynomial_modulo(np.array([[v % p for v in row] for row in whole], np.int64), p)
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([found], pa.list_(pa.int64()))], names=["p", "coefficients"])

    tasks = min(len(primes), 64)
    dealt = spark.createDataFrame([(p,) for p in primes], "p bigint").repartition(tasks)
    total, modulus = [0] * (size + 1), 1
    for p, coefficients in sorted(dealt.mapInArrow(run, "p bigint, coefficients array<bigint>").collect()):
        inverse = pow(modulus, -1, p)
        total = [t + modulus * ((c - t) * inverse % p) for t, c in zip(total, coefficients)]
        modulus *= p
    return [t - modulus if 2 * t > modulus else t for t in total]


# --- its roots ----------------------------------------------------------------------


def _scaled(coefficients: list[int], bits: int) -> list[int]:
    """The polynomial whose roots are 2^bits times as large."""
    return [c << (bits * k) for k, c in enumerate(coefficients)]


def roots_above(coefficients: list[int], at: int) -> int:
    """How many roots, by multiplicity, lie above ``at``: exact where all roots are real."""
    moved = list(coefficients)
    for last in range(len(moved) - 1, 0, -1):
        for k in range(1, last + 1):
            moved[k] += at * moved[k - 1]
    signs = [c > 0 for c in moved if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _value(coefficients: list[int], at: int) -> int:
    total = 0
    for c in coefficients:
        total = total * at + c
    return total


def isolated_root(coefficients: list[int], k: int, bits: int) -> tuple[int, int, int]:
    """(root, first, last): the k-th largest root, k from 1, times 2^bits, and which roots agree with it.

    All roots must be real and none negative, and the k-th one above 0. Intervals are
    halved until one root is left in them or they are as narrow as ``ROOT_BITS`` asks.
    A single root is narrowed further by signs of the polynomial alone.
    """
    scaled = _scaled(coefficients, bits)
    low, high = 0, 1 << ((-coefficients[1]).bit_length() + bits)  # the sum of all roots bounds each
    above, above_low = 0, roots_above(scaled, 0)
    while high - low > max(1, low >> ROOT_BITS):
        if above_low - above == 1:
            break
        middle = (low + high) // 2
        count = roots_above(scaled, middle)
        if count >= k:
            low, above_low = middle, count
        else:
            high, above = middle, count
    if above_low - above == 1:
        # One simple root in (low, high]: above it the sign is that of its number of larger roots.
        upper = above % 2
        while high - low > max(1, low >> ROOT_BITS):
            middle = (low + high) // 2
            value = _value(scaled, middle)
            if value == 0:
                low = high = middle
            elif (value < 0) == bool(upper):
                high = middle
            else:
                low = middle
    return (low + high) // 2, above + 1, above_low


# --- its vectors ----------------------------------------------------------------------


def null_vectors(matrix: list[list[int]], root: int, bits: int, count: int) -> list[list[int]]:
    """``count`` orthonormal vectors times 2^_VECTOR_BITS of the eigenvalue root / 2^bits, by inverse iteration.

    A pivot of nothing, as an exact root leaves one, counts as the smallest unit.
    """
    size, one = len(matrix), 1 << _VECTOR_BITS
    rows = [[(matrix[i][j] << _VECTOR_BITS) - ((root << _VECTOR_BITS >> bits) if i == j else 0) for j in range(size)] for i in range(size)]
    order, factors = list(range(size)), []
    for k in range(size):
        pivot = max(range(k, size), key=lambda i: abs(rows[i][k]))
        rows[k], rows[pivot] = rows[pivot], rows[k]
        order[k], order[pivot] = order[pivot], order[k]
        for earlier in factors:
            earlier[k], earlier[pivot] = earlier[pivot], earlier[k]
        rows[k][k] = rows[k][k] or 1
        head, lead, column = rows[k], rows[k][k], [0] * size
        for i in range(k + 1, size):
            if rows[i][k]:
                f = column[i] = (rows[i][k] << _VECTOR_BITS) // lead
                rows[i] = [0] * (k + 1) + [a - (f * b >> _VECTOR_BITS) for a, b in zip(rows[i][k + 1 :], head[k + 1 :])]
        factors.append(column)

    def solved(vector: list[int]) -> list[int]:
        x = [vector[i] for i in order]
        for k, column in enumerate(factors):
            if x[k]:
                x = x[: k + 1] + [a - (f * x[k] >> _VECTOR_BITS) for a, f in zip(x[k + 1 :], column[k + 1 :])]
        for k in range(size - 1, -1, -1):
            rest = sum(a * b for a, b in zip(rows[k][k + 1 :], x[k + 1 :])) >> _VECTOR_BITS
            x[k] = ((x[k] - rest) << _VECTOR_BITS) // rows[k][k]
        return x

    def normal(vector: list[int]) -> list[int]:
        length = isqrt(sum(v * v for v in vector))
        return [(v << _VECTOR_BITS) // length for v in vector]

    rng = np.random.default_rng(size)
    vectors = [normal([int(v) * (one >> 32) for v in rng.integers(1, 1 << 32, size)]) for _ in range(count)]
    for _ in range(_ITERATIONS):
        made = []
        for vector in map(normal, map(solved, vectors)):
            for _ in range(2):
                for earlier in made:
                    along = sum(a * b for a, b in zip(vector, earlier)) >> _VECTOR_BITS
                    vector = [a - (along * b >> _VECTOR_BITS) for a, b in zip(vector, earlier)]
                vector = normal(vector)
            made.append(vector)
        vectors = made
    return vectors


class Whitening:
    """What whitens a vector: the mean, components (columns) over the roots of their eigenvalues, shares of the trace."""

    def __init__(self, values: np.ndarray, vectors: np.ndarray, trace: float, mean: np.ndarray):
        self.values, self.vectors, self.mean = values, vectors, mean
        self.explained = values / trace if len(values) else values
        self.matrix = vectors / np.sqrt(values)

    def apply(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.matrix


def fit(spark: SparkSession, found: Scatter, components: int = COMPONENTS) -> Whitening:
    """Components of all eigenvalues above 0, largest first, ``components`` at most; of a component's signs that which makes its largest entry positive."""
    size, mean = found.size, np.array([s / found.n for s in found.sums])
    coefficients = characteristic_polynomial(spark, found.matrix)
    rank = max(k for k, c in enumerate(coefficients) if c)  # the root 0 is as often there as the last coefficients are 0
    coefficients, wanted = coefficients[: rank + 1], min(components, rank)
    if not wanted:
        return Whitening(np.zeros(0), np.zeros((size, 0)), 1.0, mean)
    text, told = [[str(v) for v in row] for row in found.matrix], [str(c) for c in coefficients]
    bits = ROOT_BITS + 8

    def run(batches):
        matrix, polynomial = [[int(v) for v in row] for row in text], [int(c) for c in told]
        for batch in batches:
            for k in batch["k"].to_pylist():
                root, first, last = isolated_root(polynomial, k, bits)
                vector = null_vectors(matrix, root, bits, last - first + 1)[k - first]
                top = max(vector, key=abs)
                entries = [(v if top > 0 else -v) / (1 << _VECTOR_BITS) for v in vector]
                value = root / (found_n**2 << bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int64()), pa.array([value]), pa.array([entries], pa.list_(pa.float64()))], names=["k", "value", "vector"]
                )

    found_n = found.n
    dealt = spark.createDataFrame([(k,) for k in range(1, wanted + 1)], "k bigint").repartition(wanted)
    rows = sorted(dealt.mapInArrow(run, "k bigint, value double, vector array<double>").collect())
    trace = sum(found.matrix[i][i] for i in range(size)) / found.n**2
    return Whitening(np.array([r["value"] for r in rows]), np.array([r["vector"] for r in rows]).T, trace, mean)


def identity_error(vectors: DataFrame, size: int, n: int, whitening: Whitening) -> float:
    """The largest entry of the whitened vectors' covariance less the identity, measured over all vectors."""
    width = whitening.matrix.shape[1]

    def run(batches):
        rows, total = 0, np.zeros((width + 1, width))
        for batch in batches:
            _, x = whole_entries(batch, size)
            made = whitening.apply(x)
            rows, total = rows + len(made), total + np.vstack([made.T @ made, made.sum(axis=0)])
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([rows], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["n", "state"])

    def add(states):
        rows, total = 0, np.zeros((width + 1, width))
        for n, state in states:
            rows, total = rows + n, total + np.frombuffer(state).reshape(width + 1, width)
        return rows, total.tobytes()

    total = np.frombuffer(folded(vectors.mapInArrow(run, "n bigint, state binary"), add)[1]).reshape(width + 1, width)
    mean = total[width] / n
    return float(np.abs(total[:width] / n - np.outer(mean, mean) - np.eye(width)).max())


_RESULT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of all remaining vectors and components.

    A vector does not remain if it is null or holds a null, an entry that is not finite
    or one of 2^56 and more, or if it is not as long as most (of equally frequent
    lengths the longest counts). Repeated rows and missing ids are rows like others.
    Dimensions without spread give no components; without any spread, or without
    vectors, there are no rows. Equal eigenvalues share their space by a fixed start, the
    same in each run. ``deviation`` is null where it exceeds a long. Of other columns none is read.
    """
    spark, empty = rows.sparkSession, rows.sparkSession.createDataFrame([], _RESULT)
    vectors = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    sizes = vectors.where(F.col("embedding").isNotNull()).groupBy(F.size("embedding").alias("size")).count()
    common = sizes.orderBy(F.col("count").desc(), F.col("size").desc()).first()
    if common is None or not common["size"]:
        return empty
    size, vectors = common["size"], spread(vectors)
    found = scatter(vectors, size)
    whitening = fit(spark, found, components) if found else None
    if whitening is None or not len(whitening.values):
        return empty
    n, sums, width = found.n, found.sums, len(whitening.values)
    error = identity_error(vectors, size, n, whitening)

    def deviations(x: np.ndarray) -> list[int | None]:
        top = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
        kind = np.int64 if top * top * size < 1 << 62 else object
        exact = ((x.astype(kind) * n - np.array(sums, kind)) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in exact]

    def run(batches):
        for batch in batches:
            kept, x = whole_entries(batch, size)
            for at in range(0, len(kept), 1024):
                part = x[at : at + 1024]
                count, ids = len(part), batch["vec_id"].take(pa.array(kept[at : at + 1024]))
                each = np.repeat(np.arange(count), width)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), count)),
                        pa.array(np.full(count * width, n)), pa.array(deviations(part), pa.int64()).take(pa.array(each)),
                        pa.array(whitening.apply(part).ravel()), pa.array(np.tile(whitening.explained, count)), pa.array(np.full(count * width, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return vectors.mapInArrow(run, _RESULT)
