"""Whitening against whole-matrix linear algebra."""

import math

import numpy as np
import pytest

from pasarlens.llm import queries as Q
from pasarlens.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>, label int, n long, component int, deviation long, w0 double, dim int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4, 5.0, 6) for i, v in rows], SCHEMA)


def symmetric(rng, values):
    q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    return q @ np.diag(values) @ q.T


def matrices():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 7, 64, 150):
        yield np.atleast_2d(np.cov(rng.normal(size=(2 * n + 5, n)).T))
    yield np.eye(12)
    yield np.zeros((9, 9))
    yield np.diag([3.0, 3, 3, 2, 2, 1, 1, 1, 1, 0])
    yield symmetric(rng, [5.0] * 4 + [5 - 1e-12] * 3 + [4.999] * 3 + [1.0] * 20)
    yield symmetric(rng, [5.0] * 4 + [5 - 1e-12] * 3 + [1e-9] * 20) * 1e-200
    yield symmetric(rng, np.geomspace(1e12, 1e-3, 40))
    off = np.diag(np.ones(20), 1)
    yield off + off.T + np.diag(np.abs(np.arange(21) - 10.0))  # pairs of nearly equal eigenvalues


@pytest.mark.parametrize("matrix", list(matrices()), ids=lambda m: str(len(m)))
def test_leading_eigen(matrix):
    values, vectors = W.leading_eigen(matrix, 8)
    size = np.abs(matrix).max() or 1.0
    want = np.linalg.eigvalsh(matrix)[::-1][:8]
    assert np.abs(values - want).max() <= 1e-13 * size * len(matrix)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12 * size * len(matrix)


def test_counts_above():
    rng = np.random.default_rng(1)
    d, e = rng.normal(size=30), rng.normal(size=29)
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    points = np.linspace(-4, 4, 50)
    assert (W.count_above(d, e, points) == [(values > p).sum() for p in points]).all()


def check(got, rows, most=8):
    """Rows of the operator against numpy, for (vec_id, vector) pairs that remain."""
    dims = max(len(v) for _, v in rows)
    x = [[math.floor(1024 * c) + 100000 for c in [*v, *[0.0] * (dims - len(v))]] for _, v in rows]
    n = len(x)
    sums = [sum(column) for column in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    y = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    v = y.T @ y / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    used = sum(e > values[0] * 1e-12 for e in values[:most])
    assert sorted((r["vec_id"], r["component"]) for r in got) == sorted((i, k + 1) for i, _ in rows for k in range(used))
    assert {r["n"] for r in got} <= {n}
    of = {i: d for (i, _), d in zip(rows, deviation)}
    assert all(r["deviation"] == of[r["vec_id"]] for r in got)
    for k in range(used):
        mine = {r["vec_id"]: r for r in got if r["component"] == k + 1}
        assert all(abs(r["explained"] - values[k] / np.trace(v)) <= 1e-4 * r["explained"] for r in mine.values())
        gap = min(abs(values[k] - values[j]) for j in range(len(values)) if j != k) if len(values) > 1 else 1
        if gap > 1e-6 * values[0]:
            want = y @ vectors[:, k] / math.sqrt(values[k])
            have = np.array([mine[i]["whitened"] for i, _ in rows])
            sign = 1 if want @ have > 0 else -1
            assert np.abs(have - sign * want).max() < 1e-6
    if got:
        w = np.array([[r["whitened"] for r in sorted(got, key=lambda r: (str(r["vec_id"]), r["component"]))]]).reshape(n, used)
        w = w - w.mean(axis=0)
        error = np.abs(w.T @ w / n - np.eye(used)).max()
        assert error <= 1e-4 and all(abs(r["identity_error"] - error) < 1e-9 for r in got)


def test_query(spark, folder):
    rows = [(r["vec_id"], r["embedding"]) for r in Q.table(spark, folder, "embeddings").collect()]
    check(Q.op11_whitening(spark, folder).collect(), rows)


def test_awkward_vectors(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.normal(size=12).tolist()) for i in range(40)]
    good += [(100, [0.0] * 12), (101, []), (102, [1.5]), (103, rng.normal(size=12).tolist())]
    bad = [(200, None), (201, [None] + [1.0] * 11), (202, [float("nan")] * 12), (203, [1.0, float("inf")]), (None, None)]
    check(W.whiten(vectors_of(spark, good + bad).repartition(5)).collect(), good)


def test_few_equal_and_repeated_vectors(spark):
    few = [(i, v) for i, v in enumerate([[1.0, 2.0, 3.0, 4.0], [2.0, 1.0, 0.0, 1.0], [0.5, 0.25, 7.0, 1.0]])]
    check(W.whiten(vectors_of(spark, few)).collect(), few)  # rank two: two components
    assert W.whiten(vectors_of(spark, [(1, [1.0, 2.0])] * 4)).count() == 0
    assert W.whiten(vectors_of(spark, [(1, [1.0, 2.0])])).count() == 0
    assert W.whiten(vectors_of(spark, [(1, None)])).count() == 0
    assert W.whiten(vectors_of(spark, few).limit(0)).count() == 0
    ties = [(i, [float(i == k) for k in range(5)]) for i in range(5)] * 2
    got = W.whiten(vectors_of(spark, ties)).collect()
    assert len(got) == 10 * 4 and all(r["identity_error"] < 1e-9 for r in got)
    ids = [(None, [1.0, 2.0]), (None, [2.0, 5.0]), (3, [4.0, 1.0])]
    assert sorted(str(r["vec_id"]) for r in W.whiten(vectors_of(spark, ids)).collect()) == ["3", "3", "None", "None", "None", "None"]


def test_numbers_beyond_64_bits(spark):
    rows = [(1, [1e15, 1.0]), (2, [-1e15, 2.0]), (3, [1e13, 3.0]), (4, [0.0, 5.0])]
    got = W.whiten(vectors_of(spark, rows)).collect()
    assert {r["vec_id"] for r in got} == {1, 2, 3, 4} and all(r["deviation"] is None for r in got if r["vec_id"] < 3)
    assert all(r["identity_error"] < 1e-4 for r in got)
