"""Whitening against a plain eigendecomposition of the covariance of the distinct rows."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from mixprep.llm.queries import QUERIES
from mixprep.llm.whitening import squares, whitening

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def brute(vectors, components=16):
    """vec index -> (deviation, whitened up to sign), eigenvalue shares, n."""
    x = np.floor(64 * np.asarray(vectors, np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    y = (n * fit - s) / n
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return n, [sum(int(n * a - b) ** 2 for a, b in zip(row, s)) for row in x], ((n * x - s) / n) @ axes / np.sqrt(values), values / np.trace(y.T @ y / n)


def held(got, vectors, components=16):
    n, deviation, white, explained = brute(vectors, components)
    got = got.sort_values(["vec_id", "component"])
    assert list(got.columns) == COLUMNS and len(got) == len(vectors) * components
    assert (got.n == n).all() and got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9
    assert got.deviation.tolist() == [d for d in deviation for _ in range(components)]
    mine = got.whitened.to_numpy().reshape(-1, components)
    assert np.allclose(np.abs(mine), np.abs(white), atol=1e-7)
    assert np.allclose(mine * np.sign((mine * white).sum(axis=0)), white, atol=1e-7)        # one sign a component
    assert np.allclose(got.explained.to_numpy().reshape(-1, components), explained, rtol=1e-9)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query_by_brute_force(spark, sf):
    held(QUERIES["op11_whitening"](spark, f"/root/testdata/{sf}").toPandas(),
         pq.read_table(f"/root/testdata/{sf}/embeddings.parquet").sort_by("vec_id").column("embedding").to_pylist())


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "y", "z") for i, v in rows], "vec_id bigint, embedding array<float>, n int, x string, component string")


def test_repeats_count_once_and_bad_rows_go(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(60, 5))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate((base, base[:20], np.repeat(base[:1], 300, axis=0))))]
    bad = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0]), (902, [math.nan] * 5), (903, [math.inf, 0.0, 0.0, 0.0, 0.0])]
    got = whitening(frame(spark, rows + bad).repartition(5)).toPandas()
    assert set(got.vec_id) == set(range(len(rows)))
    held(got, [v for _, v in rows], 5)


def test_null_and_repeated_ids_are_rows(spark):
    rng = np.random.default_rng(2)
    got = whitening(frame(spark, [(None, v.tolist()) for v in rng.normal(size=(9, 2))] + [(7, v.tolist()) for v in rng.normal(size=(9, 2))])).toPandas()
    assert len(got) == 36 and got.vec_id.isna().sum() == 18


def test_dimensions_that_rows_do_not_span(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=(200, 3)) * [5, 1, 0.2]
    v = np.floor(64 * a) / 64
    got = whitening(frame(spark, [(i, [*r, r[0], 0.25, r[1]]) for i, r in enumerate(v.tolist())])).toPandas()    # copies and a constant
    assert got.component.max() == 3 and got.identity_error.max() < 1e-9
    assert np.allclose(np.cov(got[got.component == 3].whitened, bias=True), 1)


def test_ill_conditioned_rows(spark):
    rng = np.random.default_rng(4)
    a = rng.normal(size=(500, 4)) * [1e7, 1e4, 30, 0.1]
    a[:, 3] += a[:, 0]                                      # nearly the first again: a covariance formed at once would lose it
    got = whitening(spark.createDataFrame([(i, r) for i, r in enumerate(a.tolist())], "vec_id int, embedding array<double>")).toPandas()
    assert got.component.max() == 4 and got.identity_error.max() < 1e-6


def test_short_vectors_are_filled_up(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0]), (3, []), (4, [3.0, 0.5])]
    held(whitening(frame(spark, rows)).toPandas(), [(v + [0.0, 0.0])[:2] for _, v in rows], 2)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_nothing_to_span(spark, rows):
    got = whitening(frame(spark, rows))
    assert got.columns == COLUMNS and got.count() == 0


def test_squares_beyond_a_long():
    assert squares(np.array([[3, 4]])).to_pylist() == [25]
    assert squares(np.array([[2 ** 31, 2 ** 31], [2 ** 32, 0]])).to_pylist() == [None, None]
    assert squares(np.array([[2 ** 31, 1]])).to_pylist() == [2 ** 62 + 1]


def test_too_large_components_fail(spark):
    with pytest.raises(Exception, match="beyond"):
        whitening(frame(spark, [(1, [1e30]), (2, [0.0])]))
