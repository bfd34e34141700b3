import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm.feast import eigenvalues_above, leading_eigenpairs
from lectern.llm.whitening import whiten

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, components=4):
    """Kept ids with integer vectors, exact deviations, and the eigenpairs of a library."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dimension = max((len(v) for _, v in kept), default=0)
    vectors = [(i, [math.floor(256 * c) for c in v] + [0] * (dimension - len(v))) for i, v in kept]
    fit = sorted({tuple(x) for _, x in vectors})
    n, sums = len(fit), [sum(column) for column in zip(*fit, strict=True)]
    centred = [[Fraction(n * a - s, n) for a, s in zip(x, sums, strict=True)] for x in fit]
    matrix = np.array(
        [[float(sum(row[i] * row[j] for row in centred) / n) for j in range(dimension)] for i in range(dimension)]
    )
    deviations = [sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)) for _, x in vectors]
    return vectors, n, sums, deviations, matrix


def check(spark, rows, components=4):
    found = whiten(spark.createDataFrame(rows, SCHEMA), components=components).collect()
    vectors, n, sums, deviations, matrix = brute(rows)
    values, eigenvectors = np.linalg.eigh(matrix)
    values, eigenvectors = values[::-1], eigenvectors[:, ::-1]
    number = min(components, len(matrix))
    assert len(found) == number * len(vectors)
    got = {}
    for r in found:
        got.setdefault((r.id, r.deviation), {}).setdefault(r.component, set()).add(r.whitened)
        assert r.n == n
        assert r.explained == pytest.approx(max(values[r.component - 1], 0) / values.clip(0).sum(), rel=1e-9, abs=1e-12)
        assert r.identity_error < 1e-9
    assert got.keys() == {(i, d) for (i, _), d in zip(vectors, deviations, strict=True)}
    mean = np.array([s / n for s in sums])
    signs = {}
    for (i, x), d in zip(vectors, deviations, strict=True):
        for component in range(1, number + 1):
            if values[component - 1] < 1e-9:
                assert got[i, d][component] == {None}
                continue
            value = (np.array(x) - mean) @ eigenvectors[:, component - 1] / math.sqrt(values[component - 1])
            near = min(got[i, d][component], key=lambda w: abs(abs(w) - abs(value)))
            assert abs(abs(near) - abs(value)) < 1e-7
            if abs(value) > 1e-3:
                signs.setdefault(component, set()).add(math.copysign(1, near * value))
    assert all(len(s) == 1 for s in signs.values())


def random_symmetric(values, seed=0):
    turn, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return turn @ np.diag(values) @ turn.T, turn


@pytest.mark.parametrize("seed", range(5))
def test_inertia(seed):
    values = np.random.default_rng(seed).standard_normal(30)
    matrix, _ = random_symmetric(values, seed)
    for shift in (-1.0, -0.1, 0.0, 0.3, 2.0):
        assert eigenvalues_above(matrix, shift) == (values > shift).sum()
    assert eigenvalues_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
    assert eigenvalues_above(np.zeros((3, 3)), 0.0) == 0


@pytest.mark.parametrize(
    "values",
    [
        np.arange(1, 65), np.r_[np.ones(60), 5, 4, 3, 2], np.r_[np.full(40, 7.0), np.full(24, 1.0)], np.geomspace(1e-9, 1e6, 50),
        np.r_[np.zeros(30), 1e-3, 2e-3], np.r_[3.0], np.r_[np.linspace(1, 1 + 1e-7, 20), 9], np.r_[np.zeros(5), 2.0, 2.0],
    ],
)
def test_leading_eigenpairs(values):
    values = np.sort(np.asarray(values, float))[::-1]
    matrix, _ = random_symmetric(values)
    found, vectors = leading_eigenpairs((matrix + matrix.T) / 2, 4)
    wanted = values[: min(4, (values > 0).sum())]
    assert found == pytest.approx(wanted, rel=1e-10, abs=1e-12 * values[0])
    assert np.abs(vectors.T @ vectors - np.eye(len(wanted))).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12 * values[0]


def test_no_variance_has_no_eigenpairs():
    for matrix in (np.zeros((3, 3)), np.zeros((0, 0))):
        assert leading_eigenpairs(matrix, 4)[0].size == 0


def test_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    check(spark, [(r.vec_id, list(r.embedding)) for r in rows])


def test_dropped_repeated_and_short_rows(spark):
    nan, inf = float("nan"), float("inf")
    random = np.random.default_rng(3)
    rows = [(k, random.normal(0, 2, 6).tolist()) for k in range(40)]
    rows += [(100, None), (101, [nan] * 6), (102, [inf] * 6), (103, [None] * 6), (None, [1.0] * 6), (None, [1.0] * 6)]
    rows += [(3, rows[3][1])] * 5 + [(200, []), (201, [0.5])] + [(300 + k, rows[7][1]) for k in range(30)]
    check(spark, rows)


def test_large_offsets_stay_exact(spark):
    random = np.random.default_rng(4)
    check(spark, [(k, (random.normal(0, 1, 5) + 2.0**30).tolist()) for k in range(30)])


def test_directions_without_variance(spark):
    check(spark, [(k, [float(k), 1.0, 0.0, float(-k)]) for k in range(10)])
    one = whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).collect()
    assert [(r.id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(one)] == [
        (i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)
    ]


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    columns = ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whiten(empty).columns == columns and whiten(empty).collect() == []
    assert whiten(spark.createDataFrame([(1, []), (2, None)], SCHEMA)).collect() == []
    clashing = spark.createDataFrame([(k, [float(k), k * k / 2]) for k in range(5)], SCHEMA)
    for name in ("id", "x", "row", "place", *columns[1:]):
        clashing = clashing.withColumn(name, F.lit("z"))
    found = whiten(clashing)
    assert found.columns == columns and found.count() == 10
