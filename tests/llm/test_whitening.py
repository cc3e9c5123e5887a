"""Embedding whitening against NumPy's eigenvalues and exact arithmetic."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from bankweave.llm import queries, whitening
from bankweave.llm.common import read

SCHEMA = "vec_id long, embedding array<double>, component string, n string"


def by_hand(rows, k=8):
    """Number of vectors, exact covariance, deviations and the rows' coordinates on the leading eigenvectors."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    centred = [[Fraction(n * a - s, n) for a, s in zip(v, sums)] for v in x]
    floats = np.array([[float(c) for c in v] for v in centred])
    covariance = np.array([[float(sum(p * q for p, q in zip(a, b)) / n) for b in zip(*centred)] for a in zip(*centred)])
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:k]
    return n, covariance, deviation, values[order], floats @ vectors[:, order] / np.sqrt(values[order])


def check(spark, rows, extra=(), k=8):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in [*rows, *extra]], SCHEMA).repartition(3)
    got = whitening.whiten(df, k).collect()
    n, covariance, deviation, values, coordinates = by_hand(rows, k)
    assert len(got) == len(rows) * len(values) and {r["n"] for r in got} == {n}
    found = {(r["vec_id"], r["component"]): r for r in got}
    for j, e in enumerate(values):
        want, have = coordinates[:, j], np.array([found[i, j + 1]["whitened"] for i, _ in rows])
        assert np.allclose(have, want, rtol=0, atol=1e-7) or np.allclose(have, -want, rtol=0, atol=1e-7)
        assert abs(found[rows[0][0], j + 1]["explained"] - e / np.trace(covariance)) < 1e-12
    assert [int(found[i, 1]["deviation"]) for i, _ in rows] == deviation
    assert max(r["identity_error"] for r in got) < 1e-8


def test_random_vectors_and_rows_that_take_no_part(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.3) * (j + 1) for j in range(12)]) for i in range(150)]
    nan, inf = float("nan"), float("inf")
    extra = [(900, None), (901, [1.0, None] + [0.0] * 10), (902, [nan] * 12), (903, [inf] + [0.0] * 11), (904, [-inf] * 12), (905, [1.0, 2.0]), (906, [])]
    check(spark, rows, extra)


def test_copies_null_ids_and_large_entries(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(5)]) for i in range(40)]
    rows += [(100 + i, rows[3][1]) for i in range(30)] + [(None, [0.5, 0.25, -1.0, 3.0, 2.0])]
    rows += [(200, [1e5, -2e4, 0.0, 1.0, 2.0]), (201, [-1e5, 5e4, 7.0, 1.0, 2.0])]
    check(spark, rows)


def test_rank_and_empty_tables(spark):
    rng = random.Random(3)
    line = [(i, [i / 8, i / 4, -i / 8, 1.0]) for i in range(20)]
    got = whitening.whiten(spark.createDataFrame([(i, v, "", "") for i, v in line], SCHEMA)).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 20 and abs(got[0]["explained"] - 1) < 1e-12
    one = spark.createDataFrame([(1, [1.0, 2.0], "", "")], SCHEMA)
    assert whitening.whiten(one).count() == 0
    assert whitening.whiten(one.union(one)).count() == 0
    assert whitening.whiten(one.limit(0)).count() == 0
    assert whitening.whiten(one.limit(0)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    huge = [(i, [rng.choice([-1e300, 1e300]), rng.random()]) for i in range(10)]
    got = whitening.whiten(spark.createDataFrame([(i, v, "", "") for i, v in huge], SCHEMA)).collect()
    assert got and all(math.isfinite(r["whitened"]) for r in got)


def spectrum(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))
    return (q * np.array(values)) @ q.T


@pytest.mark.parametrize("values", [
    [9, 8, 7, 6, 5, 4, 3, 2, 1], [1e6, 1.0, 1 - 1e-9, 1e-3, 0, 0], [5, 5, 5, 1], [2, 1, 1, 1, 1, 1, 0.5], [1, 1 - 1e-12, 1 - 2e-12, 0.1], [3.0], [0, 0, 0], [1e-30, 1e-31]])
def test_slicing_numbers_close_and_equal_eigenvalues(values):
    m = spectrum(values)
    m = (m + m.T) / 2
    got, vectors = whitening.leading(m, 8)
    want = np.sort(np.linalg.eigvalsh(m))[::-1]
    scale = max(1e-300, want[0])
    assert len(got) == min(8, int((want > 1e-12 * scale).sum()))
    assert np.allclose(got, want[: len(got)], rtol=0, atol=1e-13 * scale)
    assert np.allclose(m @ vectors, vectors * got, rtol=0, atol=1e-12 * scale)
    assert np.allclose(vectors.T @ vectors, np.eye(len(got)), atol=1e-3)
    for shift in [*(want[:-1] + want[1:]) / 2, -1.0 * scale, 2 * scale]:
        if np.abs(want - shift).min() > 1e-11 * scale:
            assert whitening.count_below(m, shift) == int((want < shift).sum())


def test_counts_of_matrices_without_a_diagonal():
    m = np.array([[0.0, 1.0], [1.0, 0.0]])
    assert [whitening.count_below(m, s) for s in (-2.0, 0.0, 2.0)] == [0, 1, 2]
    assert whitening.count_below(np.zeros((3, 3)), 0.0) == 0


def test_whole_table_against_numpy(spark, sf_dir):
    rows = [(r["vec_id"], [float(c) for c in r["embedding"]]) for r in read(spark, sf_dir, "embeddings").collect()]
    got = queries.queries()["op13_whitening"](spark, sf_dir)
    assert dict(got.dtypes)["deviation"] == "bigint" and dict(got.dtypes)["component"] == "int"
    x = np.floor(1024 * np.array([v for _, v in rows])) + 100_000
    centred = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(x))
    found = {(r["vec_id"], r["component"]): r for r in got.collect()}
    assert len(found) == 8 * len(rows)
    for j in range(8):
        want = centred @ vectors[:, -1 - j] / math.sqrt(values[-1 - j])
        have = np.array([found[i, j + 1]["whitened"] for i, _ in rows])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-6
    assert max(r["identity_error"] for r in found.values()) < 1e-6
    n, sums = len(x), [int(s) for s in x.sum(axis=0)]
    assert [found[i, 1]["deviation"] for i, _ in rows] == [sum((n * int(a) - s) ** 2 for a, s in zip(v, sums)) for v in x]
