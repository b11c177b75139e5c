"""Embedding whitening (op11): a distributed centred covariance, its leading
eigenvectors, and a broadcast projection.

Each entry c becomes the integer x = floor(64 * c) + 1000000. The covariance is
over the fit list (every distinct x vector once, divisor n): tasks sum the
outer products of centred vectors, the matrix's rows are added up by row number
on the executors, and the driver gets one d x d matrix, whatever the number of
rows. There: Householder reflections to a tridiagonal matrix, bisection on
Sturm counts for the leading eigenvalues, inverse iteration with
reorthogonalisation inside clusters for their vectors. Components (d x 16
numbers) are broadcast and every row is projected.

Defined cases: a null vector, or one with a null, NaN or infinite entry, is
dropped; so is an empty one and one whose length is not the fit list's most
frequent (of equally frequent ones the greatest). Entries beyond 2^46 are
taken as 2^46. Repeated rows and ids, and null ids, each keep their rows.
Components whose eigenvalue is at most 1e-11 of the largest (rounding) are
left out, so a table of equal vectors, or an empty one, gives no row. A
deviation beyond 64 bits is null. Other columns are ignored. Vectors have at
most ``MOST_DIMENSIONS`` entries, which bounds the matrix on the driver;
longer ones are an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import in_small_batches, stage

COMPONENTS, SCALE, SHIFT = 16, 64, 1_000_000
MOST_DIMENSIONS, LARGEST = 8192, float(1 << 52)
ROUNDING = 1e-11
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


# --- the eigenproblem, on the driver ------------------------------------------

def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Householder: (diagonal, off-diagonal, reflectors) of a symmetric matrix."""
    a, d, reflectors = np.array(matrix, float), len(matrix), []
    for k in range(d - 2):
        v = a[k + 1:, k].copy()
        size = np.linalg.norm(v)
        if size == abs(v[0]):  # nothing below the first: already in form
            reflectors.append(None)
            continue
        to = -np.copysign(size, v[0])
        v[0] -= to
        v /= np.linalg.norm(v)
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1:, k] = 0
        a[k + 1, k] = to
        reflectors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues are less than each of ``at``."""
    least = np.finfo(float).tiny / np.finfo(float).eps * max(1.0, float((off * off).max(initial=0)))
    q, count = diagonal[0] - at, np.zeros(len(at), np.int64)
    for i in range(len(diagonal)):
        if i:
            q = diagonal[i] - at - off[i - 1] ** 2 / q
        q = np.where(np.abs(q) < least, -least, q)
        count += q < 0
    return count


def leading(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection down to rounding."""
    d = len(diagonal)
    reach = np.zeros(d)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    slack = np.finfo(float).eps * max(np.abs(diagonal).max() + reach.max(), np.finfo(float).tiny) * d
    low = np.full(k, (diagonal - reach).min() - slack)
    high = np.full(k, (diagonal + reach).max() + slack)
    rank = d - 1 - np.arange(k)
    for _ in range(200):
        middle = (low + high) / 2
        if np.all((middle <= low) | (middle >= high)):
            break
        under = below(diagonal, off, middle) <= rank
        low, high = np.where(under, middle, low), np.where(under, high, middle)
    return (low + high) / 2


def _solver(diagonal: np.ndarray, off: np.ndarray, at: float):
    """Elimination with row exchanges of the tridiagonal matrix less ``at``;
    returns a function that solves for a right side."""
    d = len(diagonal)
    main, first, second = (diagonal - at).tolist(), [*off.tolist(), 0.0], [0.0] * d
    steps, lower = [], off.tolist()
    tiny = np.finfo(float).eps * max(np.abs(diagonal).max(), np.abs(off).max(initial=0), np.finfo(float).tiny)
    for i in range(d - 1):
        swap = abs(lower[i]) > abs(main[i])
        if swap:
            main[i], lower[i] = lower[i], main[i]
            first[i], main[i + 1] = main[i + 1], first[i]
            second[i], first[i + 1] = first[i + 1], 0.0
        if main[i] == 0:
            main[i] = tiny
        m = lower[i] / main[i]
        main[i + 1] -= m * first[i]
        first[i + 1] -= m * second[i]
        steps.append((swap, m))
    if abs(main[-1]) < tiny:
        main[-1] = tiny

    def solve(right: np.ndarray) -> np.ndarray:
        b = right.tolist()
        for i, (swap, m) in enumerate(steps):
            if swap:
                b[i], b[i + 1] = b[i + 1], b[i]
            b[i + 1] -= m * b[i]
        for i in range(d - 1, -1, -1):
            b[i] = (b[i] - (first[i] * b[i + 1] if i + 1 < d else 0.0) - (second[i] * b[i + 2] if i + 2 < d else 0.0)) / main[i]
        return np.array(b)
    return solve


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 5) -> np.ndarray:
    """Unit vectors (columns) of falling eigenvalues, by inverse iteration.
    Values within a thousandth of the norm of the one before are a cluster,
    whose vectors are held at right angles to each other."""
    norm = max(np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0), np.finfo(float).tiny)
    start, random = 0, np.random.default_rng(11)
    out, at = np.zeros((len(diagonal), len(values))), np.array(values, float)
    for j in range(len(values)):
        if j and values[j - 1] - values[j] > 1e-3 * norm:
            start = j
        if j > start:  # equal values need different matrices
            at[j] = min(at[j], at[j - 1] - 4 * np.finfo(float).eps * norm)
        solve, z = _solver(diagonal, off, at[j]), random.uniform(0.5, 1.0, len(diagonal)) * random.choice([-1, 1], len(diagonal))
        cluster = out[:, start:j]
        for _ in range(rounds):
            z = solve(z / np.abs(z).max())
            for _ in range(2):
                z = z / np.linalg.norm(z)
                z = z - cluster @ (cluster.T @ z)
        out[:, j] = z / np.linalg.norm(z)
    return out


def components(covariance: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, vectors as columns) of up to ``most`` leading components,
    falling; those lost in rounding are left out. A vector's largest entry in
    size (the first of equal ones) is positive."""
    size = float(np.abs(covariance).max(initial=0))
    if not size > 0:
        return np.zeros(0), np.zeros((len(covariance), 0))
    diagonal, off, reflectors = tridiagonal(covariance / size)
    values = leading(diagonal, off, min(most, len(covariance)))
    values = values[values > ROUNDING * max(values[0], 0)] if values[0] > 0 else values[:0]
    vectors = eigenvectors(diagonal, off, values)
    for k in range(len(reflectors) - 1, -1, -1):
        if (v := reflectors[k]) is not None:
            vectors[k + 1:] -= 2 * np.outer(v, v @ vectors[k + 1:])
    lead = np.abs(vectors).argmax(0)
    return values * size, vectors * np.sign(vectors[lead, np.arange(len(values))])


# --- sums over all rows, on the executors -------------------------------------

def whole_numbers(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x) of rows whose vector is fit for use."""
    v = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    good = F.coalesce(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))), F.lit(False))
    x = F.transform("v", lambda c: F.floor(F.greatest(F.least(c * F.lit(float(SCALE)), F.lit(LARGEST)), F.lit(-LARGEST))).cast("long") + F.lit(SHIFT).cast("long"))
    return v.filter(good & (F.size("v") > 0)).select("vec_id", x.alias("x"))


def _x(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _sums(fit: DataFrame, d: int) -> list[int]:
    """S, exact: high and low halves are summed on their own."""
    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(d, np.int64), np.zeros(d, np.int64)
        for b in batches:
            x = _x(b, d)
            high += (x >> 26).sum(0)
            low += (x & ((1 << 26) - 1)).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array(high), pa.array(low)], names=["i", "high", "low"])

    got = fit.select("x").mapInArrow(halves, "i int, high long, low long").groupBy("i").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    sums = [0] * d
    for r in got:
        sums[r["i"]] = (int(r["high"]) << 26) + int(r["low"])
    return sums


class Centre:
    """n, S, and a vector's exact distance from the mean."""

    def __init__(self, n: int, sums: list[int], reach: int):
        self.n, self.sums = n, sums
        self.small = n * reach < 1 << 62  # n * x and S fit in 64 bits
        self.s = np.array(sums, np.int64) if self.small else np.array(sums, object)

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        return x * self.n - self.s if self.small else x.astype(object) * self.n - self.s

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.numerators(x).astype(float) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S)^2, exact; null beyond 64 bits."""
        d = self.numerators(x)
        if self.small and int(np.abs(d).max(initial=0)) ** 2 * x.shape[1] < 1 << 63:
            return (d * d).sum(1).tolist()
        exact = [sum(int(v) ** 2 for v in row) for row in d]
        return [v if v < 1 << 63 else None for v in exact]


def _covariance(fit: DataFrame, d: int, centre: Centre) -> np.ndarray:
    """Each task adds up outer products of centred vectors and sends the
    matrix's rows to the task that adds up that row number."""
    shared = fit.sparkSession.sparkContext.broadcast(centre)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros((d, d)), False
        for b in batches:
            c = shared.value.centred(_x(b, d))
            total += c.T @ c
            any_rows = any_rows or len(c) > 0
        for i in range(0, d if any_rows else 0, 512):
            rows = [r.tobytes() for r in total[i:i + 512]]
            yield pa.RecordBatch.from_arrays([pa.array(range(i, i + len(rows)), pa.int32()), pa.array(rows, pa.binary())], names=["i", "row"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, np.ndarray] = {}
        for b in batches:
            for i, r in zip(b.column("i").to_pylist(), b.column("row").to_pylist()):
                rows[i] = rows[i] + np.frombuffer(r) if i in rows else np.frombuffer(r).copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int32()), pa.array([r.tobytes() for r in rows.values()], pa.binary())], names=["i", "row"])

    schema = "i int, row binary"
    got = fit.select("x").mapInArrow(part, schema).repartition("i").mapInArrow(add, schema).collect()
    shared.unpersist()
    total = np.zeros((d, d))
    for r in got:
        total[r["i"]] = np.frombuffer(r["row"])
    return (total + total.T) / (2 * centre.n)


def _merged(a: tuple, b: tuple) -> tuple:
    """Counts, means and centred products of two parts as those of both."""
    n, shift = a[0] + b[0], b[1] - a[1]
    return n, a[1] + shift * (b[0] / n), a[2] + b[2] + np.outer(shift, shift) * (a[0] * b[0] / n)


def _identity_error(fit: DataFrame, d: int, centre: Centre, project: np.ndarray, parts: int = 16) -> float:
    """Largest entry, in size, of the covariance of the fit list's whitened
    values less the identity."""
    shared, k = fit.sparkSession.sparkContext.broadcast((centre, project)), project.shape[1]

    def row(total: tuple | None) -> Iterator[pa.RecordBatch]:
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([total[0]], pa.int64()), pa.array([total[1].tobytes()], pa.binary()), pa.array([total[2].tobytes()], pa.binary())], names=["n", "mean", "products"])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                c, p = shared.value
                w = c.centred(_x(b, d)) @ p
                mean = w.mean(0)
                here = (len(w), mean, (w - mean).T @ (w - mean))
                total = _merged(total, here) if total else here
        yield from row(total)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for n, mean, products in zip(*(c.to_pylist() for c in b.columns)):
                here = (n, np.frombuffer(mean), np.frombuffer(products).reshape(k, k))
                total = _merged(total, here) if total else here
        yield from row(total)

    schema = "n long, mean binary, products binary"
    got = fit.select("x").mapInArrow(part, schema).repartition(parts).mapInArrow(merge, schema).collect()
    shared.unpersist()
    total = None
    for r in got:
        here = (r["n"], np.frombuffer(r["mean"]), np.frombuffer(r["products"]).reshape(k, k))
        total = _merged(total, here) if total else here
    return float(np.abs(total[2] / total[0] - np.eye(k)).max())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """A row for each usable row of ``vectors`` and each component (``SCHEMA``)."""
    spark = vectors.sparkSession
    in_small_batches(spark)
    rows = whole_numbers(vectors, id_col, vector_col)
    fit = stage(rows.select("x").distinct(), "whitening-fit")
    sizes = fit.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"), F.max(F.greatest(F.abs(F.array_max("x")), F.abs(F.array_min("x")))).alias("reach"))
    found = sizes.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not found:
        return spark.createDataFrame([], SCHEMA)
    d, n, reach = found[0]["d"], found[0]["n"], found[0]["reach"]
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {d} entries; at most {MOST_DIMENSIONS}")
    fit, rows = fit.filter(F.size("x") == d), rows.filter(F.size("x") == d)
    centre = Centre(n, _sums(fit, d), reach)
    covariance = _covariance(fit, d, centre)
    values, vectors_ = components(covariance, most)
    k = len(values)
    if not k:
        return spark.createDataFrame([], SCHEMA)
    project = vectors_ / np.sqrt(values)
    error, explained = _identity_error(fit, d, centre, project), values / np.trace(covariance)
    shared = spark.sparkContext.broadcast((centre, project))

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c, p = shared.value
            x = _x(b, d)
            m = len(x)
            each = np.repeat(np.arange(m), k)
            deviations = c.deviations(x)
            yield pa.RecordBatch.from_arrays([
                b.column("vec_id").take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                pa.array(list(chain.from_iterable([v] * k for v in deviations)), pa.int64()),
                pa.array((c.centred(x) @ p).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(rows_of, SCHEMA)
