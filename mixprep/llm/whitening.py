"""Embedding whitening (11): shifted CholeskyQR over the centred distinct rows, then the SVD of R.

Rows are ``x = floor(scale * c) + shift``; the fit list holds each distinct ``x`` once. With ``Y`` the centred fit list, every pass
is one distributed sum: tasks turn their rows ``Y`` into ``Q = Y R^-1`` by triangular solves and add up ``Q'Q``, a matrix as wide as
a vector is long; the sums of all tasks meet in a hash aggregation. The driver takes the Cholesky factor of the sum (the first
passes with a shift, which keeps a badly conditioned or singular sum positive) and composes it with ``R``. Passes end when
``Q'Q`` is the identity, on its range where the rows do not span all dimensions. The SVD of the composed ``R`` gives the components: its right
singular vectors are the eigenvectors of the covariance, its singular values squared over n the eigenvalues. Forming the covariance itself would
lose half of the digits of small eigenvalues; orthogonalising again and again does not.

Nothing but matrices of the vectors' width reaches the driver. Every pass reads the written fit list again, so a lost executor costs
its tasks of one pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mixprep.llm.common import ship, stage
from mixprep.llm.vectors import matrix, scaled_rows

#: Passes at most; three are enough for any condition number up to that of double precision.
PASSES = 8
#: Dimensions that the rows do not span: eigenvalues of ``Q'Q`` below ``LOST``, singular values of ``R`` below ``RANK`` of the largest (what rounding leaves).
LOST, RANK = 1e-13, 1e-12


def _sums(rows: DataFrame, shape: tuple[int, int], block: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """Sum over all rows of the matrices ``block(x)`` of ``shape``: added up within a task, then by an aggregation over (line, column)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for b in batches:
            if b.num_rows:
                total = total + block(matrix(b.column("x")))
        if np.ndim(total):
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_pydict({"i": i.ravel().astype(np.int32), "j": j.ravel().astype(np.int32), "v": total.ravel()})
    cells = rows.mapInArrow(run, f"i int, j int, v {kind}").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()    # as many cells as the shape has
    out = np.zeros(shape, np.float64 if kind == "double" else np.int64)
    for c in cells:
        out[c["i"], c["j"]] = c["v"]
    return out


def _centred(x: np.ndarray, n: int, s: np.ndarray) -> np.ndarray:
    """``x - S/n`` as double: whole numbers ``n*x - S`` first, so nothing cancels."""
    return (n * x - s) / n


def _solve(y: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``y R1^-1 R2^-1 ...``: a triangular solve per factor."""
    for r in factors:
        out = np.empty_like(y)
        for k in range(r.shape[0]):                     # forward substitution over columns: q_k = (y_k - sum q_j r_jk) / r_kk
            out[:, k] = (y[:, k] - out[:, :k] @ r[:k, k]) / r[k, k]
        y = out
    return y


def _factor(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper Cholesky factor of ``gram`` plus the smallest multiple of ``shift`` that makes it positive."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, np.finfo(float).tiny)


def orthogonalise(rows: DataFrame, n: int, s: np.ndarray) -> np.ndarray:
    """``R`` with ``Y = Q R`` and ``Q'Q`` the identity (on the range of Y), for the centred rows ``Y`` of ``rows`` (x)."""
    width, factors, r = len(s), [], np.eye(len(s))
    for k in range(PASSES):
        def block(x: np.ndarray, factors=factors) -> np.ndarray:
            q = _solve(_centred(x, n, s), factors)
            return q.T @ q
        gram = _sums(rows, (width, width), block)
        gram = (gram + gram.T) / 2
        values, axes = np.linalg.eigh(gram)
        spanned = values > LOST * max(values[-1], 1e-300)
        if k and abs(values[spanned] - 1).max(initial=0) < 1e-10 or not values[-1] > 0:
            break
        # The shift of the first pass: 11 (m n + n (n + 1)) u |Y|^2 keeps the sum positive whatever rounding did; later sums are near the identity.
        shift = 11 * (n * width + width * (width + 1)) * np.finfo(float).eps / 2 * np.trace(gram) if k == 0 else 0.0
        f = _factor(gram, min(shift, 1e-2 * np.trace(gram) / width))
        factors, r = [*factors, f], f @ r
    return (np.sqrt(np.maximum(values, 0))[:, None] * axes.T) @ r     # the last sum as a factor of its own: the identity but for rounding and lost dimensions


def whitening(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16, scale: float = 64.0,
              shift: int = 1_000_000) -> DataFrame:
    """One row per vector and component: id column, component (from 1, by falling eigenvalue), n, deviation, whitened, explained, identity_error.

    ``n`` is the number of distinct rows, ``deviation`` the exact sum of ``(n*x - S)^2`` (null where it is beyond a long), ``whitened`` the centred row projected on the
    component over the square root of its eigenvalue, ``explained`` the eigenvalue's share of the trace, ``identity_error`` the largest entry of the
    covariance of ``whitened`` over the fit list minus the identity, measured in a pass of its own. A component's largest entry is positive.

    Vectors that are null or hold null or non-finite components are left out, shorter ones filled up with zeros (``vectors.scaled_rows``).
    Rows that repeat an id or a vector, or have a null id, are rows like any other. Components are those with an eigenvalue above zero: equal
    rows alone, a single row or an empty table have none and give no rows. Other columns are not read.
    """
    spark = df.sparkSession
    ship(spark)
    id_type = df.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = stage(scaled_rows(df, id_col, vector_col, scale, shift), "scaled")
    fit = stage(rows.select("x").filter(F.size("x") > 0).distinct(), "fit-list")
    n = fit.count()
    result = lambda out: out.withColumnRenamed("id", id_col)
    if not n:
        return result(spark.createDataFrame([], schema))

    def plain(x: np.ndarray) -> np.ndarray:
        if abs(x).max() > 2 ** 62 // n:
            raise OverflowError("n * x does not fit a long")
        return x.sum(axis=0, keepdims=True)
    s = _sums(fit, (1, fit.select(F.size("x").alias("n")).first()["n"]), plain, "bigint")[0]
    r = orthogonalise(fit, n, s)
    _, sigma, axes = np.linalg.svd(r)
    values = sigma ** 2 / n
    trace = values.sum()
    k = int(min(components, (sigma > RANK * sigma[0]).sum())) if trace > 0 else 0
    if not k:
        return result(spark.createDataFrame([], schema))
    axes = axes[:k]
    axes = axes * np.sign(axes[np.arange(k), abs(axes).argmax(axis=1)])[:, None]
    project = (axes / np.sqrt(values[:k])[:, None]).T

    def covariance(x: np.ndarray) -> np.ndarray:
        w = _centred(x, n, s) @ project
        return w.T @ w
    error = float(abs(_sums(fit, (k, k), covariance) / n - np.eye(k)).max())
    explained = values[:k] / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, 4096):
                part = b.slice(a, 4096)
                x = matrix(part.column("x"))
                m = len(x)
                yield pa.RecordBatch.from_arrays([
                    part.column("id").take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, np.int64)), squares(n * x - s).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array((_centred(x, n, s) @ project).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return result(rows.mapInArrow(run, schema))


def squares(d: np.ndarray) -> pa.Array:
    """Exact sums of squares of the rows; null beyond a long."""
    if abs(d).max(initial=0) < 2.0 ** 31 / max(1, d.shape[1]) ** 0.5:
        return pa.array((d * d).sum(axis=1))
    exact = [sum(int(c) ** 2 for c in row) for row in d]
    return pa.array([e if e < 2 ** 63 else None for e in exact], pa.int64())
