"""Whitening of embeddings by the principal components of their distinct vectors.

Entries become integers, so that every sum over the data is exact and in any order the same. The scatter of the
distinct vectors is summed around a whole-number centre next to the mean, and what is left of the mean is taken
off in whole numbers too. The scatter, a square of the dimension, is factored by Cholesky with full pivoting;
one-sided Jacobi then turns the columns of the triangular factor until they are orthogonal. Their norms give the
eigenvalues and their directions the components, to the relative precision of the factor, as the factor is never
multiplied with itself.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.tables import Workspace

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16

# Whole numbers below this are exact in doubles.
EXACT = 1 << 53

# A pivot below this share of the largest is rounding error: the vectors span no further dimension.
RANK_TOLERANCE = 1e-13

RESULT = "component int, n long, deviation long, whitened double, explained double"


@dataclass(frozen=True)
class Fit:
    """Number of distinct vectors, their sums, and per component (a row) direction, eigenvalue and share."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray


def whole(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """``df`` with its vectors as whole numbers ``x``; rows go whose vector is null or empty or holds an entry
    that is null or not finite. Whole numbers beyond a long raise, by the cast."""
    entries = F.col(vector).cast("array<double>")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(entries, lambda c: F.floor(c * SCALE).cast("long") + F.lit(OFFSET))
    return df.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & finite).withColumn("x", x)


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a batch, all of one dimension, as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _total(x: np.ndarray) -> np.ndarray:
    """Exact sums of the columns, as Python numbers."""
    wide = x if float(np.abs(x).max()) * len(x) < 2.0**62 else x.astype(object)
    return wide.sum(axis=0).astype(object)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, 0
    for batch in batches:
        if len(batch):
            n += len(batch)
            total = total + _total(_matrix(batch.column("x")))
    if n:
        yield _table(dim=np.arange(len(total)), n=np.full(len(total), n), total=[str(v) for v in total])


def _table(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({name: pa.array(values) for name, values in columns.items()})


def _scatter_of(centre: np.ndarray):
    """Partial sums of products of centred entries, ``(i, j, total)`` for i <= j, and of the entries at j = -1."""

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(centre)
        products, totals, some = np.zeros((d, d), dtype=object), np.zeros(d, dtype=object), False
        for batch in batches:
            if not len(batch):
                continue
            some = True
            z = _matrix(batch.column("x")) - centre
            if float(np.abs(z).max()) ** 2 * len(z) < EXACT:
                wide = z.astype(np.float64)
                products += (wide.T @ wide).astype(np.int64)
            else:
                products += z.astype(object).T.dot(z.astype(object))
            totals += _total(z)
        if some:
            i, j = np.triu_indices(d)
            i, j = np.concatenate([i, np.arange(d)]), np.concatenate([j, np.full(d, -1)])
            total = np.concatenate([products[np.triu_indices(d)], totals])
            yield _table(i=i, j=j, total=[str(v) for v in total])

    return scatter


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """A factor with ``g @ g.T == a`` whose rows, in the order of the pivots, are lower triangular; as many
    columns as ``a`` has rank."""
    a, order, columns = a.copy(), np.arange(len(a)), []
    least = RANK_TOLERANCE * max(a.diagonal().max(initial=0.0), 0.0)
    for k in range(len(a)):
        pivot = k + int(a.diagonal()[k:].argmax())
        a[[k, pivot]] = a[[pivot, k]]
        a[:, [k, pivot]] = a[:, [pivot, k]]
        order[[k, pivot]] = order[[pivot, k]]
        for column in columns:
            column[[k, pivot]] = column[[pivot, k]]
        if a[k, k] <= least:
            break
        column = np.zeros(len(a))
        column[k:] = a[k:, k] / sqrt(a[k, k])
        a[k:, k:] -= np.outer(column[k:], column[k:])
        columns.append(column)
    g = np.zeros((len(a), len(columns)))
    if columns:
        g[order] = np.stack(columns, axis=1)
    return g


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of ``n`` columns, in rounds of pairs that share no column."""
    seats = np.arange(n + n % 2)
    for _ in range(len(seats) - 1):
        p, q = seats[: len(seats) // 2], seats[len(seats) // 2 :][::-1]
        both = (p < n) & (q < n)
        yield np.minimum(p, q)[both], np.maximum(p, q)[both]
        seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])


def one_sided_jacobi(g: np.ndarray) -> np.ndarray:
    """``g`` with its columns turned pairwise until they are orthogonal to working precision."""
    g = g.copy()
    small = len(g) * np.finfo(float).eps
    turned = g.shape[1] > 1
    while turned:
        turned = False
        for p, q in _rounds(g.shape[1]):
            a, b = g[:, p], g[:, q]
            alpha, beta, gamma = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            off = np.abs(gamma) > small * np.sqrt(alpha * beta)
            if not off.any():
                continue
            turned = True
            p, q, a, b = p[off], q[off], a[:, off], b[:, off]
            zeta = (beta[off] - alpha[off]) / (2 * gamma[off])
            tangent = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            cosine = 1 / np.sqrt(1 + tangent * tangent)
            sine = cosine * tangent
            g[:, p], g[:, q] = cosine * a - sine * b, sine * a + cosine * b
    return g


def principal(scatter: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Components (rows), eigenvalues and explained shares of the covariance ``scatter / n``, largest first."""
    if not len(scatter) or scatter.diagonal().max() <= 0:
        return np.zeros((0, len(scatter))), np.zeros(0), np.zeros(0)
    # Entries of very different size do not meet in a sum before they are scaled to about one.
    size = scatter.diagonal().max()
    turned = one_sided_jacobi(pivoted_cholesky(scatter / size))
    norms = np.sqrt((turned * turned).sum(axis=0))
    order = np.argsort(-norms, kind="stable")[:most]
    eigenvalues = norms[order] ** 2 * size / n
    return (turned[:, order] / norms[order]).T.copy(), eigenvalues, eigenvalues / (scatter.trace() / n)


def fit(distinct: DataFrame, most: int = COMPONENTS) -> Fit:
    """Principal components of the vectors ``x`` of a written table.

    The driver gets sums per dimension and pair of dimensions, never rows.
    """
    totals = distinct.select("x").mapInArrow(_sums, "dim long, n long, total string").groupBy("dim")
    totals = totals.agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    rows = sorted(totals.collect())
    if not rows:
        return Fit(0, np.zeros(0, dtype=np.int64), np.zeros((0, 0)), np.zeros(0), np.zeros(0))
    n, sums = rows[0]["n"], [int(row["total"]) for row in rows]
    centre = np.array([(2 * total + n) // (2 * n) for total in sums], dtype=np.int64)
    parts = distinct.select("x").mapInArrow(_scatter_of(centre), "i long, j long, total string").groupBy("i", "j")
    parts = parts.agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    exact = {(row["i"], row["j"]): int(row["total"]) for row in parts}
    d = len(sums)
    scatter = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            # n times the scatter, in whole numbers; only the quotient is rounded.
            scatter[i, j] = scatter[j, i] = (n * exact[i, j] - exact[i, -1] * exact[j, -1]) / n
    return Fit(n, np.array(sums, dtype=np.int64), *principal(scatter, n, most))


def _deviations(x: np.ndarray, model: Fit) -> np.ndarray:
    """``n`` times the distance of each entry from the mean, exact."""
    centre = model.sums // model.n
    return (x - centre) * model.n - (model.sums - centre * model.n)


def _projected(x: np.ndarray, model: Fit) -> np.ndarray:
    return (_deviations(x, model) / model.n) @ (model.components / np.sqrt(model.eigenvalues)[:, None]).T


def _errors(model: Fit):
    def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.eigenvalues)
        total = np.zeros((k, k))
        for batch in batches:
            if len(batch):
                white = _projected(_matrix(batch.column("x")), model)
                total += white.T @ white
        i, j = np.triu_indices(k)
        yield _table(i=i, j=j, total=total[i, j])

    return errors


def identity_error(distinct: DataFrame, model: Fit) -> float:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity."""
    sums = distinct.select("x").mapInArrow(_errors(model), "i long, j long, total double").groupBy("i", "j")
    off = F.abs(F.sum("total") / F.lit(float(model.n)) - (F.col("i") == F.col("j")).cast("double"))
    return sums.agg(off.alias("off")).agg(F.max("off")).first()[0] or 0.0


def _whitened(model: Fit):
    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.eigenvalues)
        for batch in batches:
            if not len(batch) or not k:
                continue
            x = _matrix(batch.column("x"))
            away = _deviations(x, model)
            if float(np.abs(away).max()) ** 2 * away.shape[1] < 2.0**62:
                deviation = (away * away).sum(axis=1)
            else:
                deviation = [int(row.dot(row)) for row in away.astype(object)]
            rows = pa.array(np.repeat(np.arange(len(batch)), k))
            kept = [batch.column(name).take(rows) for name in batch.schema.names if name != "x"]
            found = [
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(batch))),
                pa.array(np.full(len(rows), model.n)),
                pa.array(deviation, pa.int64()).take(rows),
                pa.array(_projected(x, model).reshape(-1)),
                pa.array(np.tile(model.explained, len(batch))),
            ]
            names = [name for name in batch.schema.names if name != "x"]
            added = ["component", "n", "deviation", "whitened", "explained"]
            yield pa.RecordBatch.from_arrays([*kept, *found], names=[*names, *added])

    return whitened


def whiten(vectors: DataFrame, most: int = COMPONENTS, label: str = "whitening") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` for each remaining row of
    ``vectors`` ``(vec_id, embedding, ...)`` and each of the first ``most`` components.

    Rows go as :func:`whole` says. Where vectors differ in dimension, the commonest dimension counts (the larger
    of equals) and other rows go. Components without variance do not exist: one distinct vector, or none, gives no
    rows, and vectors that span fewer dimensions than ``most`` give one component for each of these. Repeated rows
    fit once and each get their rows; a null vec_id is one like others. Other columns are ignored.
    """
    work = Workspace(vectors.sparkSession, label)
    kept = work.keep(whole(vectors.select("vec_id", "embedding")).select("vec_id", "x"))
    sizes = kept.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if sizes:
        kept = kept.where(F.size("x") == sizes[0]["d"])
    distinct = work.keep(kept.select("x").distinct())
    model = fit(distinct, most)
    error = identity_error(distinct, model) if len(model.eigenvalues) else 0.0
    id_type = kept.schema["vec_id"].dataType.simpleString()
    found = kept.mapInArrow(_whitened(model), f"vec_id {id_type}, {RESULT}")
    return found.withColumn("identity_error", F.lit(error))
