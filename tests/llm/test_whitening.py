"""Whitening against an eigendecomposition of the covariance, and on odd input."""

import math
from fractions import Fraction

import numpy as np
import pytest

from broadsheet.llm import queries, whitening

SF_DIR = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def whole(vectors):
    return np.floor(64 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 1_000_000


def test_query_equals_an_eigendecomposition(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = whole([row.embedding for row in rows])
    fitted = np.unique(x, axis=0)
    n, sums = len(fitted), fitted.sum(axis=0)
    centred = fitted - sums / n
    cov = centred.T @ centred / n
    values, directions = (part[..., ::-1][..., :16] for part in np.linalg.eigh(cov))
    expected = dict(zip((row.vec_id for row in rows), (x - sums / n) @ directions / np.sqrt(values)))
    deviations = dict(zip((row.vec_id for row in rows), ((n * x - sums) ** 2).sum(axis=1).tolist()))
    got = queries.op12_whitening(spark, SF_DIR).collect()
    assert len(got) == 16 * len(rows) and {row.n for row in got} == {n}
    table = np.zeros((len(rows), 16))
    place = {vec_id: i for i, vec_id in enumerate(expected)}
    for row in got:
        table[place[row.vec_id], row.component - 1] = row.whitened
        assert row.deviation == deviations[row.vec_id]
        assert row.explained == pytest.approx(values[row.component - 1] / np.trace(cov), rel=1e-9)
        assert row.identity_error < 1e-9
    wanted = np.array(list(expected.values()))
    wanted *= np.sign((table * wanted).sum(axis=0))
    assert np.abs(table - wanted).max() < 1e-7


def test_factor_and_rotations_keep_small_eigenvalues():
    """Eigenvalues over twelve orders of magnitude, each to its own precision."""
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.normal(size=(9, 9)))
    scales = 10.0 ** -np.arange(0, 9, dtype=float)
    scaled = np.diag(np.sqrt(scales)) @ (q @ np.diag(np.linspace(1, 2, 9)) @ q.T) @ np.diag(np.sqrt(scales))
    g = whitening.pivoted_cholesky(scaled)
    assert np.abs(g @ g.T - scaled).max() < 1e-15
    turned = whitening.one_sided_jacobi(g)
    gram = turned.T @ turned
    norms = np.sqrt(np.diag(gram))
    assert np.abs(gram / np.outer(norms, norms) - np.eye(9)).max() < 1e-14
    expected = np.linalg.svd(g, compute_uv=False)
    assert np.allclose(np.sort(norms)[::-1], expected, rtol=1e-9)


def test_every_pair_of_columns_meets_once():
    for n in (1, 2, 5, 8):
        met = [tuple(pair) for p, q in whitening._rounds(n) for pair in zip(p.tolist(), q.tolist())]
        assert sorted(met) == [(i, j) for i in range(n) for j in range(i + 1, n)]


def test_odd_rows(spark):
    rows = [
        (1, [0.5, 1.0], "a"), (1, [0.5, 1.0], "b"), (None, [0.25, -3.0], "c"), (2, None, "d"), (3, [None, 1.0], "e"),
        (4, [NAN, 1.0], "f"), (5, [INF, 1.0], "g"), (6, [], "h"), (7, [1.0, 2.0, 3.0], "i"), (8, [-0.001, 7.0], "j"),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, component string")
    got = whitening.whiten(df).collect()
    assert sorted((row.vec_id or 0, row.component) for row in got) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2), (8, 1), (8, 2)]
    assert {row.n for row in got} == {3}
    x = whole([[0.5, 1.0], [0.25, -3.0], [-0.001, 7.0]])
    deviation = ((3 * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert {(row.vec_id, row.deviation) for row in got} == set(zip([1, None, 8], deviation.tolist()))
    assert math.isclose(sum({row.component: row.explained for row in got}.values()), 1.0)


def test_few_dimensions_and_no_rows(spark):
    schema = "vec_id long, embedding array<double>"
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(6)], schema)
    assert {row.component for row in whitening.whiten(flat).collect()} == {1}
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(6)], schema)
    empty = whitening.whiten(same)
    assert empty.collect() == [] and empty.columns == whitening.whiten(flat).columns
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []


def test_large_entries_stay_exact(spark):
    """Products beyond what doubles hold exactly."""
    rng = np.random.default_rng(9)
    x = rng.integers(-(1 << 33), 1 << 33, size=(40, 3))
    df = spark.createDataFrame([(row.tolist(),) for row in x], "x array<long>").repartition(3)
    model = whitening.fit(df, 3)
    exact = [[sum(Fraction(int(a)) * int(b) for a, b in zip(x[:, i], x[:, j])) for j in range(3)] for i in range(3)]
    sums = [int(total) for total in x.sum(axis=0)]
    trace = float(sum(exact[i][i] - Fraction(sums[i]) ** 2 / 40 for i in range(3)) / 40)
    assert model.sums.tolist() == sums
    assert model.eigenvalues.sum() == pytest.approx(trace, rel=1e-14)
