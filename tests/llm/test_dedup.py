"""Exact (9), near (3) and embedding (6) de-duplication against brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mixprep.llm import embedding_dedup, exact_dedup, hnsw, near_dedup
from mixprep.llm.components import connected_components

SPACES = str.maketrans("", "", " \t\n\x0b\x0c\r")


def groups_by_bytes(rows):
    by = {}
    for i, t in rows:
        by.setdefault((t or "").translate(SPACES), []).append((-len(t or ""), i))
    return {norm: (sorted(x)[0][1], len(x)) for norm, x in by.items()}


def check_exact(got, rows):
    import hashlib
    by = groups_by_bytes(rows)
    want = sorted((i, *by[(t or "").translate(SPACES)], hashlib.sha256((t or "").translate(SPACES).encode()).hexdigest()) for i, t in rows)
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert sorted(r.doc_id for r in kept) == sorted(k for k, _ in by.values()) and len(kept) == len(by)


@pytest.fixture(scope="module")
def copies(make_docs, tmp_path_factory):
    rows = [(i, "a b  c" if i % 3 else "a\tbc") for i in range(60)] + [(100 + i, f"text {i // 2}" + " " * (i % 2)) for i in range(40)]
    rows += [(200, None), (201, ""), (202, " \n"), (203, "b c"), (204, "bc"), (205, "x" * 300_000), (206, "x" * 300_000 + " "), (206, "x" * 300_000 + " ")]
    path = tmp_path_factory.mktemp("copies") / "documents.parquet"
    make_docs(rows, path)
    return str(path), rows


def test_exact_groups(spark, copies):
    check_exact(exact_dedup.exact_dedup(spark, copies[0]).collect(), copies[1])


def test_exact_when_digests_collide(spark, copies):
    """With a digest of four bits nearly everything collides: the bytes must tell the groups apart."""
    weak = lambda c: F.substring(F.sha2(c.cast("binary"), 256), 1, 1)
    check_exact(exact_dedup.exact_dedup(spark, copies[0], digest=weak).collect(), copies[1])


def test_exact_in_several_batches(spark, copies):
    check_exact(exact_dedup.exact_dedup(spark, copies[0], max_bytes_per_batch="1").collect(), copies[1])


def test_state_goes_on_where_it_was(spark, make_docs, tmp_path):
    """A second run with the same checkpoint reads only the new file, and the state still knows the old rows."""
    make_docs([(1, "a b"), (2, "c")], tmp_path / "in")
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    run = lambda: {r.digest: (r.n, r.keep_id) for r in exact_dedup.retained(
        spark, str(tmp_path / "in"), schema, "doc_id", "text", lambda c: c, str(tmp_path / "state")).collect()}
    assert run() == {"ab": (1, 1), "c": (1, 2)}
    make_docs([(3, "a  b"), (0, "c")], tmp_path / "more")
    spark.read.parquet(str(tmp_path / "more")).write.mode("append").parquet(str(tmp_path / "in"))
    assert run() == {"ab": (2, 3), "c": (2, 0)}


def test_exact_edges_and_nothing(spark, edges, edge_rows, nothing):
    check_exact(exact_dedup.exact_dedup(spark, exact_dedup.source_path(edges)).collect(), edge_rows)
    assert exact_dedup.exact_dedup(spark, exact_dedup.source_path(nothing)).count() == 0
    stays = exact_dedup.drop_copies(edges)
    assert stays.columns == edges.columns and stays.count() == len(groups_by_bytes(edge_rows))
    assert exact_dedup.drop_copies(edges.filter("doc_id in (8, 9)")).count() == 1  # not all rows of its files


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def near_by_brute_force(rows, percent=85):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                n = len(a & b)
                if 100 * n >= percent * (len(a) + len(b) - n):
                    p, q = root(i), root(j)
                    parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_rows(seed=3):
    """A large group of near copies at all distances, chains, shared passages, exact copies, short and unlike texts."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(4))
    base = [word() for _ in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rnd.choice([0, 1, 1, 2, 3, 5, 8])):
            w[rnd.randrange(len(w))] = word()
        rows.append(" ".join(w))
    chain = [word() for _ in range(100)]
    for i in range(25):
        chain[4 * i % 100] = word()
        rows.append(" ".join(chain))
    passage = " ".join(word() for _ in range(60))
    rows += [passage + " " + " ".join(word() for _ in range(rnd.randrange(5, 60))) for _ in range(80)]
    rows += ["Exact Copy of one text that has some words"] * 40 + ["one two", "one two", "ONE\ttwo", "", None, " "]
    rows += [" ".join(word() for _ in range(rnd.randrange(1, 80))) for _ in range(100)]
    rnd.shuffle(rows)
    return list(enumerate(rows, 10))


@pytest.mark.parametrize("block", [128, 8])
def test_near_groups_equal_brute_force(spark, make_docs, tmp_path, block):
    rows = near_rows()
    got = near_dedup.near_dedup(make_docs(rows, tmp_path / "d"), block=block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_by_brute_force(rows)
    assert len(got) == len(rows) and all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_by_the_shuffled_path(spark, make_docs, tmp_path, monkeypatch):
    monkeypatch.setattr(near_dedup, "BROADCAST_IDS", 0)
    rows = near_rows(seed=4)[:200]
    got = near_dedup.near_dedup(make_docs(rows, tmp_path / "d")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_by_brute_force(rows)


def test_near_query_on_the_table(spark):
    from mixprep.llm.queries import op3_near_dedup
    sf = "/root/testdata/sf0.001"
    docs = pd.read_parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op3_near_dedup(spark, sf).collect()}
    assert got == near_by_brute_force(list(zip(docs.doc_id, docs.text)))


def test_near_edges_and_nothing(edges, edge_rows, nothing):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_dedup(edges).collect()}
    assert got == near_by_brute_force(edge_rows)
    assert near_dedup.near_dedup(nothing).count() == 0
    stays = near_dedup.drop_near_copies(edges)
    assert stays.columns == edges.columns and {r.doc_id for r in stays.collect()} == {i for i, (_, c) in got.items() if i == c}


def sequential_superminhash(elements, slots):
    """The published loop, one element after another, with the same random numbers."""
    h = np.full(slots, np.inf)
    for e in elements:
        e, p = np.array([e], np.uint64), list(range(slots))
        for j in range(slots):
            x = near_dedup._mix(e + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            r = float((x >> np.uint64(11))[0]) * 2.0 ** -53
            k = j + int(((near_dedup._mix(x ^ near_dedup._GOLD) >> np.uint64(32)) * np.uint64(slots - j) >> np.uint64(32))[0])
            p[j], p[k] = p[k], p[j]
            h[p[j]] = min(h[p[j]], r + j)
    return h


def test_levels_give_the_published_signature():
    rng = np.random.default_rng(1)
    sets = [np.sort(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (1, 2, 7, 40, 300)]
    got = near_dedup.superminhash(sets, 24)
    for s, row in zip(sets, got):
        assert np.array_equal(row, sequential_superminhash(s, 24))


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(60):
        x = rng.integers(0, 2**63, 300, dtype=np.uint64)
        a, b = x[:240], x[60:]
        sign = near_dedup.superminhash([np.sort(a), np.sort(b)], 100)
        errors.append((sign[0] == sign[1]).mean() - 180 / 300)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_linked_pairs_are_exact():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 400, n).astype(np.uint64)) for n in rng.integers(1, 300, 40)] + [np.empty(0, np.uint64)]
    got = near_dedup.linked_pairs(sets, 30)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            n = len(np.intersect1d(a, b))
            assert got[i, j] == (len(a) > 0 and len(b) > 0 and 100 * n >= 30 * (len(a) + len(b) - n))


def test_components(spark):
    edges = [(1, 2), (2, 3), (7, 7), (9, 8), (8, 9), (20, 10), (20, 30), (40, 30), (40, 50), (None, 3)] + [(1000 + i, 1001 + i) for i in range(60)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {2: 1, 3: 1, 9: 8, 20: 10, 30: 10, 40: 10, 50: 10} | {1001 + i: 1000 for i in range(60)}
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def vectors(seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 16))
    rows, k = [], 0
    for label in (0, 0, 0, 1, 2):
        for _ in range(90):
            v = centres[rng.integers(12)] + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.35, 1.5])
            rows.append((k, v.astype(np.float32).tolist(), label))
            k += 1
    same = rows[3][1]
    rows += [(k + i, same, 0) for i in range(200)]                       # one very common vector
    k += 200
    rows += [(k, [2 * x for x in same], 0), (k + 1, same, 1), (k + 2, same, None), (k + 3, None, 0), (k + 4, [0.0] * 16, 0), (k + 5, [None] + same[1:], 0),
             (k + 6, [float("nan")] + same[1:], 0), (k + 7, [float("inf")] + same[1:], 0), (k + 8, [], 0), (k + 9, same[:8], 0)]
    return rows


def embedding_by_brute_force(rows, least):
    ok = [(i, np.array(v, float), la) for i, v, la in rows if la is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = {i: 0 for i, _, _ in rows}
    parent = {i: i for i, _, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for x, (i, v, la) in enumerate(ok):
        for j, w, lb in ok[x + 1:]:
            if la == lb and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= least:
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (links[i], root(i)) for i, _, _ in rows}


@pytest.mark.parametrize("shard_rows,query_rows", [(16_384, 4_096), (70, 40)])
def test_embedding_groups_equal_brute_force(spark, shard_rows, query_rows):
    rows = vectors()
    df = spark.createDataFrame([(i, v, la, "x", "y") for i, v, la in rows], "vec_id bigint, embedding array<float>, label int, id string, w string")
    got = embedding_dedup.embedding_dedup(df, shard_rows=shard_rows, query_rows=query_rows).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == embedding_by_brute_force(rows, 0.93)
    assert len(got) == len(rows) and all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_embedding_nothing(spark):
    assert embedding_dedup.embedding_dedup(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0


def test_beams_that_are_too_narrow_are_widened():
    """600 nearly equal vectors: every beam is full of partners, and yet none is lost."""
    rng = np.random.default_rng(8)
    x = embedding_dedup.unit(np.concatenate([rng.normal(size=(1, 32)) + 0.02 * rng.normal(size=(600, 32)), rng.normal(size=(900, 32))]))[rng.permutation(1500)]
    graph = hnsw.Graph.build(x.astype(np.float32))
    got = embedding_dedup.linked(graph, x, x, 0.93)
    want = embedding_dedup._exact(x, x, 0.93)
    assert sum(len(np.intersect1d(a, b)) for a, b in zip(got, want)) >= 0.99 * sum(map(len, want)) and max(map(len, got)) >= 600
    assert all(set(a) <= set(b) for a, b in zip(got, want))


def test_graph_recall():
    rng = np.random.default_rng(9)
    x = embedding_dedup.unit(rng.normal(size=(4000, 24))).astype(np.float32)
    graph = hnsw.Graph.build(x)
    ids, _ = graph.search(x[:300], 64)
    top = np.argsort(-(x[:300] @ x.T), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids.tolist(), top.tolist())]) >= 0.9
