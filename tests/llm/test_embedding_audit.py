"""The recall audit of embedding de-duplication (6) needs evidence."""

import numpy as np
import pytest

from mixprep.llm import embedding_dedup, hnsw


class Lossy:
    """A search that finds the rows of one cluster alone."""

    def __init__(self, x, cluster):
        self.x, self.cluster = x, cluster

    def search(self, q, beam):
        sims = (q @ self.x[:self.cluster].T)
        ids = np.argsort(-sims, axis=1)[:, :beam].astype(np.int32)
        return ids, np.take_along_axis(sims, ids, 1).astype(np.float32)


def cluster_and_pairs(cluster=600, pairs=1200, seed=8):
    """Rows of one cluster, then rows each of which has a near copy; the copies."""
    rng = np.random.default_rng(seed)
    x = embedding_dedup.unit(np.concatenate([rng.normal(size=(1, 32)) + 0.02 * rng.normal(size=(cluster, 32)), rng.normal(size=(pairs, 32))]))
    return x, embedding_dedup.unit(x[cluster:] + 0.02 * rng.normal(size=(pairs, 32)))


def same(got, want):
    return all(np.array_equal(a, b) for a, b in zip(got, want)) and len(got) == len(want)


def test_links_of_a_cluster_do_not_outvote_lone_pairs():
    x, copies = cluster_and_pairs()
    q = np.concatenate([x[:600], copies])
    q = q[np.random.default_rng(1).permutation(len(q))]
    assert same(embedding_dedup.linked(Lossy(x, 600), q, x, 0.93), embedding_dedup._exact(q, x, 0.93))


def test_an_audit_without_partners_is_no_proof():
    """Of 1000 queries one, not audited, has a partner."""
    x, copies = cluster_and_pairs()
    q = embedding_dedup.unit(np.random.default_rng(2).normal(size=(1000, 32)))
    q[1] = copies[5]
    got = embedding_dedup.linked(Lossy(x, 600), q, x, 0.93)
    assert got[1].tolist() == [605]


def test_finding_itself_is_no_proof():
    x, copies = cluster_and_pairs(pairs=400)
    x = np.concatenate([x, copies])

    class OnlyItself(Lossy):
        def search(self, q, beam):
            ids = np.full((len(q), beam), -1, np.int32)
            ids[:, 0] = (q @ self.x.T.astype(np.float32)).argmax(axis=1)
            return ids, np.where(ids >= 0, np.float32(1), np.float32(-2))

    q = x[600:]
    got = embedding_dedup.linked(OnlyItself(x, 600), q, x, 0.93, own=np.arange(600, len(x)))
    assert same(got, embedding_dedup._exact(q, x, 0.93))


@pytest.mark.parametrize("shards", [3])
def test_recall_of_lone_pairs_over_shards(shards):
    """One big cluster and many lone pairs in several shards: the mean over the queries of their recall in a shard."""
    x, copies = cluster_and_pairs(3000, 3000)
    x = np.concatenate([x, copies])
    shard = np.random.default_rng(3).integers(0, shards, len(x))
    for k in range(shards):
        rows = np.flatnonzero(shard == k)[np.random.default_rng(4).permutation((shard == k).sum())]
        graph = hnsw.Graph.build(x[rows].astype(np.float32))
        q = x[3000:]
        place = np.full(len(x), -1)
        place[rows] = np.arange(len(rows))
        got, want = embedding_dedup.linked(graph, q, x[rows], 0.93, own=place[3000:]), embedding_dedup._exact(q, x[rows], 0.93)
        share = [np.isin(w[w != p], g).mean() for g, w, p in zip(got, want, place[3000:]) if (w != p).any()]
        print("recall of lone pairs, shard", k, round(float(np.mean(share)), 4), "of", len(share))
        assert np.mean(share) >= 0.98
