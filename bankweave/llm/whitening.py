"""Embedding whitening by spectrum slicing.

Sums and products of the integer vectors are exact, so the covariance does not depend on how rows are dealt to tasks.
Its leading eigenvalues are isolated by counting: the inertia of an LDL' factorisation of the shifted covariance says
how many eigenvalues lie under the shift.  Rayleigh quotient iteration then converges inside each slice, and
counts on both sides of the value found certify its number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankweave.llm.common import bound_batches

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
_FARTHEST = float(2**50)  # entries beyond take this value, so that products fit a decimal
_EPS = float(np.finfo(float).eps)
_WHOLE = pa.decimal128(38, 0)
_EXACT = 2**53


def whole_entries(column: Column) -> Column:
    """floor(1024 * c) + 100000 of every entry as long; null where the vector is null or holds a null or non-finite entry."""
    value = lambda x: x.cast("double")
    good = F.forall(column, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(value(x)) & (F.abs(value(x)) < float("inf")), F.lit(False)))
    held = lambda x: F.greatest(F.least(value(x) * SCALE, F.lit(_FARTHEST)), F.lit(-_FARTHEST))
    return F.when(good, F.transform(column, lambda x: F.floor(held(x)).cast("long") + SHIFT))


def rows_of(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _integers(values: list[int]) -> pa.Array:
    return pa.array([Decimal(v) for v in values], _WHOLE)


def products(z: np.ndarray) -> np.ndarray:
    """Sum of the outer products of the rows, exactly: in doubles as far as they hold whole numbers, else in integers."""
    if not len(z):
        return np.zeros((z.shape[1],) * 2, object)
    largest = max(1, int(np.abs(z).max()))
    most = _EXACT // (largest * largest)
    if not most:
        wide = z.astype(object)
        return wide.T @ wide
    total = np.zeros((z.shape[1],) * 2, object)
    for at in range(0, len(z), most):
        part = z[at : at + most].astype(float)
        total = total + (part.T @ part).astype(np.int64)
    return total


@dataclass
class Moments:
    """Sums of the vectors, and the covariance of their entries (divisor n), rounded once from its exact value."""

    n: int
    sums: list[int]
    near: np.ndarray  # the means, rounded to whole numbers
    rest: list[int]  # sums of what is left beside them
    covariance: np.ndarray


def moments(vectors: DataFrame, dims: int) -> Moments:
    """``vectors`` have a column ``x`` of ``dims`` longs.  Two passes; a task gives a row for each pair of dimensions."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dims, object), 0
        for batch in batches:
            x = rows_of(batch, dims)
            total, n = total + x.sum(axis=0), n + len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), _integers(total), pa.array([n] * dims, pa.int64())], names=["i", "s", "n"])

    found = vectors.mapInArrow(add, "i int, s decimal(38,0), n long").groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
    sums, n = [0] * dims, 0
    for r in found:
        sums[r["i"]], n = int(r["s"]), r["n"]
    near = np.array([(2 * s + n) // (2 * n) if n else 0 for s in sums], np.int64)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims), object)
        for batch in batches:
            total = total + products(rows_of(batch, dims) - near)
        i, j = np.triu_indices(dims)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), _integers(total[i, j])], names=["i", "j", "v"])

    rest = [s - n * int(m) for s, m in zip(sums, near)]
    covariance = np.zeros((dims, dims))
    if n:
        whole = vectors.mapInArrow(multiply, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v"))
        for r in whole.collect():  # a row for each pair of dimensions
            i, j = r["i"], r["j"]
            covariance[i, j] = covariance[j, i] = (n * int(r["v"]) - rest[i] * rest[j]) / (n * n)
    return Moments(n, sums, near, rest, covariance)


def count_below(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix lie under ``shift``: the negative ones in D of the shifted matrix's LDL'.

    Pivots are chosen over the whole rest (blocks of one or two rows), so no shift breaks the factorisation.
    """
    a = matrix - shift * np.eye(len(matrix))
    bar, negative = (1 + math.sqrt(17)) / 8, 0
    while len(a):
        size = np.abs(a)
        own = np.diagonal(size)
        p = int(own.argmax())
        if own[p] >= bar * size.max():
            pivot = a[p, p]
            if pivot == 0:  # what is left is all zero
                return negative
            negative += pivot < 0
            column = np.delete(a[:, p], p)
            a = np.delete(np.delete(a, p, 0), p, 1) - np.outer(column, column / pivot)
        else:  # the largest entry lies beside the diagonal: its block has one negative eigenvalue and one positive
            two = list(np.unravel_index(size.argmax(), a.shape))
            negative += 1
            columns = np.delete(a[:, two], two, 0)
            a = np.delete(np.delete(a, two, 0), two, 1) - columns @ np.linalg.solve(a[np.ix_(two, two)], columns.T)
    return int(negative)


def _solve(matrix: np.ndarray, shift: float, scale: float, right: np.ndarray) -> np.ndarray:
    for nudge in (0.0, 1.0, 3.0):
        try:
            found = np.linalg.solve(matrix - (shift + nudge * _EPS * scale) * np.eye(len(matrix)), right)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(found).all():
            return found
    return right


def rayleigh(matrix: np.ndarray, low: float, high: float, scale: float) -> tuple[float, np.ndarray] | None:
    """The eigenvalue and unit eigenvector that Rayleigh quotient iteration finds in a slice; None if it leaves the slice."""
    middle = (low + high) / 2
    v = np.random.default_rng(1).standard_normal(len(matrix))
    for _ in range(3):  # inverse iteration brings the start near the slice's own vector
        v = _solve(matrix, middle, scale, v)
        v /= np.linalg.norm(v)
    best = None
    for _ in range(12):
        value = float(v @ matrix @ v)
        residual = float(np.linalg.norm(matrix @ v - value * v))
        if not low <= value <= high:
            return None
        if best is None or residual < best[2]:
            best = value, v, residual
        elif residual <= 64 * _EPS * scale:
            break
        v = _solve(matrix, value, scale, v)
        v /= np.linalg.norm(v)
    return best[:2] if best and best[2] <= 1024 * _EPS * scale else None


def cluster(matrix: np.ndarray, low: float, high: float, many: int, scale: float) -> list[tuple[float, np.ndarray]]:
    """Eigenvalues that no shift tells apart: a basis of their space by inverse iteration on a block."""
    block = np.random.default_rng(1).standard_normal((len(matrix), many))
    for _ in range(8):
        block, _ = np.linalg.qr(_solve(matrix, (low + high) / 2, scale, block))
    return sorted(((float(v @ matrix @ v), v) for v in block.T), key=lambda x: -x[0])


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors as columns; only values that stand out from
    rounding, so fewer for a matrix of lower rank."""
    d = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max(initial=0))
    if not scale:
        return np.zeros(0), np.zeros((d, 0))
    least, tiny = 16 * d * _EPS * scale, 64 * _EPS * scale
    k = min(k, d - count_below(matrix, least))
    found: list[tuple[float, np.ndarray]] = []
    # Slices from the top: (low, high, eigenvalues at or over low, over high).
    waiting = [(least, scale * (1 + 4 * _EPS), d - count_below(matrix, least), 0)]
    while waiting and len(found) < k:
        low, high, at_low, at_high = waiting.pop()
        inside = at_low - at_high
        if not inside:
            continue
        if inside == 1 and (pair := rayleigh(matrix, low, high, scale)):
            value = pair[0]
            if d - count_below(matrix, value + tiny) == at_high and d - count_below(matrix, value - tiny) == at_low:
                found.append(pair)
                continue
        if high - low <= tiny:
            found += cluster(matrix, low, high, inside, scale)
            continue
        middle = (low + high) / 2
        at_middle = d - count_below(matrix, middle)
        waiting += [(low, middle, at_low, at_middle), (middle, high, at_middle, at_high)]
    found = found[:k]
    if not found:
        return np.zeros(0), np.zeros((d, 0))
    vectors = np.stack([v for _, v in found], axis=1)
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), range(len(found))])
    return np.array([e for e, _ in found]), vectors * signs


def whiten(vectors: DataFrame, k: int = COMPONENTS, vec: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error`` for every
    row and each of the ``k`` leading components.

    All rows whose vector is not null and holds neither null nor non-finite entries are fitted and returned; null ids
    pass through and repeated rows count as often as they come.  Of vectors of several lengths only the most frequent length
    takes part (of ties the longest), of empty ones none.  Entries over 2^40 count as 2^40.  ``deviation`` is null
    where it has more than 38 digits.  A covariance of lower rank has fewer components; no row, one row or all rows alike
    have none, and give no rows.  Eigenvectors have their largest entry positive.  Other columns are left out.

    The passes are over the vectors alone: lengths, sums, products, covariance of the whitened values, result.  What comes to the
    driver is a row for each pair of dimensions, however many vectors there are.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    schema = T.StructType([
        T.StructField("vec_id", vectors.schema[vec].dataType), T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("values", T.ArrayType(T.DoubleType()))])
    whole = vectors.select(F.col(vec).alias("vec_id"), whole_entries(F.col(embedding)).alias("x")).filter(F.size("x") > 0)
    lengths = whole.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    dims = lengths[0]["d"] if lengths else 0
    whole = whole.filter(F.size("x") == dims)
    fitted = moments(whole.select("x"), dims)
    values, basis = leading(fitted.covariance, k)
    n, near, rest, few = fitted.n, fitted.near, fitted.rest, len(values)
    shift = np.array([r / n for r in rest]) if n else np.zeros(dims)
    turned = basis / np.sqrt(values)
    farthest = max(map(abs, rest), default=0)

    def project(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        z = rows_of(batch, dims) - near
        return z, (z - shift) @ turned

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, squares = np.zeros(few), np.zeros((few, few))
        for batch in batches:
            w = project(batch)[1]
            total, squares = total + w.sum(axis=0), squares + w.T @ w
        i, j = np.divmod(np.arange(few * few), few)
        columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i]), pa.array(squares[i, j])]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "s", "v"])

    error = 0.0
    if few:
        sums = whole.select("x").mapInArrow(spread, "i int, j int, s double, v double").groupBy("i", "j").agg(F.sum("s").alias("s"), F.sum("v").alias("v")).collect()
        mean = {r["i"]: r["s"] / n for r in sums}
        error = max(abs(r["v"] / n - mean[r["i"]] * mean[r["j"]] - (r["i"] == r["j"])) for r in sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, w = project(batch)
            largest = n * max(1, int(np.abs(z).max(initial=0))) + farthest
            if dims * largest * largest < 2**63:
                gaps = n * z - np.array(rest, np.int64)
                deviation = pa.array((gaps * gaps).sum(axis=1)).cast(_WHOLE)
            else:
                gaps = n * z.astype(object) - np.array(rest, object)
                exact = (gaps * gaps).sum(axis=1)
                deviation = pa.array([Decimal(v) if v < 10**38 else None for v in exact], _WHOLE)
            lists = pa.ListArray.from_arrays(np.arange(len(w) + 1, dtype=np.int32) * few, pa.array(w.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), deviation, lists], names=schema.fieldNames())

    trace = float(np.trace(fitted.covariance))
    shares = F.array(*[F.lit(float(e / trace)) for e in values]) if few else F.array().cast("array<double>")
    rows = whole.mapInArrow(run, schema).select("vec_id", "deviation", F.posexplode("values").alias("at", "whitened"))
    return rows.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error"))
