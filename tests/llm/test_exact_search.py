"""Exact search against all inner products in whole numbers."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from mixprep.llm import exact_search
from mixprep.llm.exact_search import exact_top_k
from mixprep.llm.queries import QUERIES


def brute(rows, every=100, k=10, scale=1024.0):
    """Sorted (query_id, rank, vec_id, score)."""
    x = [(i, [math.floor(scale * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for at, (i, q) in enumerate(x):
        if i is None or i % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(q, v)), j is None, j or 0) for b, (j, v) in enumerate(x) if b != at))[:k]
        out += [(i, r, None if none else j, -s) for r, (s, none, j) in enumerate(scored, 1)]
    return sorted(out, key=str)


def result(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted([tuple(r) for r in df.collect()], key=str)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 1, "x", 0.5) for i, v in rows], f"vec_id bigint, embedding array<{kind}>, row int, x string, r double")


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query_by_brute_force(spark, sf):
    t = pq.read_table(f"/root/testdata/{sf}/embeddings.parquet")
    x = np.floor(1024 * np.array(t.column("embedding").to_pylist(), np.float64)).astype(np.int64)
    ids = t.column("vec_id").to_numpy()
    want = []
    for q in np.flatnonzero(ids % 100 == 0):
        score = x @ x[q]
        order = [j for j in np.lexsort((ids, -score)) if j != q][:10]
        want += [(int(ids[q]), r, int(ids[j]), int(score[j])) for r, j in enumerate(order, 1)]
    assert result(QUERIES["op12_exact_search"](spark, f"/root/testdata/{sf}")) == sorted(want, key=str)


def clustered(rng, n, dims, spread, lengths):
    centres = rng.normal(size=(12, dims))
    v = centres[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, dims))
    return (v / np.linalg.norm(v, axis=1, keepdims=True) * rng.choice(lengths, n)[:, None]).tolist()


@pytest.mark.parametrize("seed, dims, spread, lengths", [(1, 3, 0.05, [1]), (2, 16, 0.3, [0.2, 1, 5]), (3, 2, 0.5, [1]), (4, 8, 1.0, [1, 40])])
def test_many_slices_and_groups(spark, seed, dims, spread, lengths):
    rng = np.random.default_rng(seed)
    rows = list(enumerate(clustered(rng, 1500, dims, spread, lengths)))
    got = exact_top_k(frame(spark, rows, "double"), every=7, k=5, part_rows=100, block_rows=32, query_rows=60, pivots=9)
    assert result(got) == brute(rows, every=7, k=5)


def test_a_pivot_of_copies_and_ties(spark):
    rng = np.random.default_rng(5)
    rows = list(enumerate([[1.0, 0.0]] * 400 + rng.normal(size=(200, 2)).tolist()))
    got = exact_top_k(frame(spark, rows, "double"), every=10, k=4, part_rows=64, block_rows=16, query_rows=20, pivots=5)
    assert result(got) == brute(rows, every=10, k=4)


def test_annuli_are_left_out(spark, monkeypatch):
    """Far slices are not paired with a group: the bounds do prune."""
    rng = np.random.default_rng(6)
    kept = []
    monkeypatch.setattr(exact_search, "stage", lambda df, name, real=exact_search.stage: kept.append((name, real(df, name))) or kept[-1][1])
    rows = list(enumerate(clustered(rng, 2000, 3, 0.02, [1])))
    got = exact_top_k(frame(spark, rows, "double"), every=5, k=3, part_rows=64, block_rows=64, query_rows=64, pivots=12)
    assert result(got) == brute(rows, every=5, k=3)
    made = dict(kept)
    groups = made["groups"].select("group").distinct().count()
    assert made["pairs"].count() < 0.6 * groups * made["groups"].count()


def test_null_repeated_and_bad_rows(spark):
    rows = [(100, [1.0, 0.0]), (100, [1.0, 0.0]), (None, [1.0, 0.0]), (None, [0.5, 0.5]), (0, [0.0, 0.0]), (200, [-1.0, 2.0]), (3, None), (4, [math.nan, 1.0]),
            (300, [math.inf, 1.0]), (400, [None, 1.0]), (-100, [0.25, 0.25]), (7, [2.0, 2.0])]
    assert result(exact_top_k(frame(spark, rows), k=4)) == brute(rows, k=4)


def test_short_vectors_are_filled_up(spark):
    rows = [(0, [1.0, 2.0, 3.0]), (100, [2.0]), (2, []), (3, [1.0, 1.0])]
    full = [(i, (v + [0.0] * 3)[:3]) for i, v in rows]
    assert result(exact_top_k(frame(spark, rows))) == brute(full)


@pytest.mark.parametrize("size", [2.0 ** 14, 2.0 ** 19])
def test_large_numbers_stay_exact(spark, size):
    rng = np.random.default_rng(8)
    rows = [(i, [math.floor(c) + 1 / 1024 for c in v]) for i, v in enumerate((size * rng.normal(size=(60, 3))).tolist())]
    assert result(exact_top_k(frame(spark, rows, "double"), every=6)) == brute(rows, every=6)


@pytest.mark.parametrize("rows", [[], [(0, None)], [(0, [1.0])], [(1, [1.0]), (2, [1.0])]])
def test_nothing_to_find(spark, rows):
    assert result(exact_top_k(frame(spark, rows))) == []


def test_number_type():
    assert [exact_search.number_type(x) for x in (2 ** 24 - 1, 2 ** 24, 2 ** 53)] == [np.float32, np.float64, object]
