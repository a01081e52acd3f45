"""A hierarchical navigable small-world graph in numpy: many points are inserted or searched at once.

Layers hold nodes of geometric random levels, the top ones few. A layer is filled in batches, highest
levels first: new points search the layer as it stands, from entry points the layer above has found,
and are joined to a spread of near neighbours both ways. All searches of a batch advance in step.
"""

from __future__ import annotations

import numpy as np

#: Neighbours a node (twice that on the ground layer), beam while building, nodes expanded per step, points per batch.
DEGREE, BUILD_BEAM, EXPAND, BATCH = 16, 48, 4, 512


def _spread(near: np.ndarray, sims: np.ndarray, x: np.ndarray, degree: int) -> tuple[np.ndarray, np.ndarray]:
    """Of candidates (rows sorted by similarity, -1 for none) ``degree`` that point different ways; free places
    go to the nearest of the others."""
    n, width = near.shape
    if width <= degree:
        return near, sims
    between = np.einsum("bid,bjd->bij", x[near], x[near])
    chosen, closest, count = np.zeros((n, width), bool), np.full((n, width), -2.0, np.float32), np.zeros(n, int)
    for c in range(width):
        ok = (near[:, c] >= 0) & (closest[:, c] < sims[:, c]) & (count < degree)
        chosen[:, c], count = ok, count + ok
        closest[ok] = np.maximum(closest[ok], between[ok, c])
    rank = np.where(chosen, 0, 1) * width + np.arange(width)
    rank[near < 0] += 2 * width
    order = np.argsort(rank, axis=1, kind="stable")[:, :degree]
    return np.take_along_axis(near, order, 1), np.take_along_axis(sims, order, 1)


class Graph:
    """An index over the rows of ``x`` (unit vectors, float32), by inner product."""

    def __init__(self, x: np.ndarray, layers: list[tuple[int, np.ndarray]]):
        #: (number of nodes, neighbours): a layer holds the first nodes, as nodes are sorted by level.
        self.x, self.layers = x, layers

    @classmethod
    def build(cls, x: np.ndarray, seed: int = 5) -> "Graph":
        """Rows must already be in random order: the first ``n / DEGREE**k`` are the nodes of layer k."""
        sizes = [len(x)]
        while sizes[-1] > 4 * DEGREE:
            sizes.append(-(-sizes[-1] // DEGREE))
        graph = cls(x, [])
        for n in reversed(sizes):
            degree = 2 * DEGREE if n == len(x) else DEGREE
            graph._fill(n, degree)
        return graph

    def _fill(self, n: int, degree: int) -> None:
        above, x = list(self.layers), self.x
        near = np.full((n, degree), -1, np.int32)
        sims = np.full((n, degree), -2.0, np.float32)
        self.layers.append((n, near))
        done = min(n, 2 * DEGREE)
        begin, first = 0, True
        while begin < n:
            end = done if first else min(n, begin + min(BATCH, max(begin, 1)))
            new = np.arange(begin, end)
            among = x[new] @ x[new].T
            np.fill_diagonal(among, -2.0)
            width = min(degree, len(new))
            local = np.argsort(-among, axis=1, kind="stable")[:, :width]
            ids, s = new[local].astype(np.int32), np.take_along_axis(among, local, 1)
            if len(new) == 1:
                ids[:], s[:] = -1, -2.0
            if not first:
                entry = self._entries(x[new], above, begin)
                found, fs = self._beam(x[new], near, entry, BUILD_BEAM)
                ids, s = np.concatenate((found, ids), 1), np.concatenate((fs, s), 1)
            order = np.argsort(-s, axis=1, kind="stable")
            ids, s = np.take_along_axis(ids, order, 1), np.take_along_axis(s, order, 1)
            ids[s <= -1.5] = -1
            ids, s = _spread(ids, s, x, degree)
            near[new, :ids.shape[1]], sims[new, :ids.shape[1]] = ids, s
            self._join_back(near, sims, np.repeat(new, ids.shape[1]), ids.reshape(-1), s.reshape(-1), degree)
            begin, first = end, False

    def _join_back(self, near, sims, source, target, s, degree) -> None:
        ok = target >= 0
        source, target, s = source[ok], target[ok], s[ok]
        order = np.lexsort((-s, target))
        source, target, s = source[order], target[order], s[order]
        start = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1]))) if len(target) else np.empty(0, int)
        rank = np.arange(len(target)) - np.repeat(start, np.diff(np.concatenate((start, [len(target)]))))
        ok = rank < degree
        source, target, s, rank = source[ok], target[ok], s[ok], rank[ok]
        nodes, row = np.unique(target, return_inverse=True)
        for a in range(0, len(nodes), 2048):
            part = nodes[a:a + 2048]
            ids = np.full((len(part), 2 * degree), -1, np.int32)
            ss = np.full((len(part), 2 * degree), -2.0, np.float32)
            ids[:, :degree], ss[:, :degree] = near[part], sims[part]
            pick = (row >= a) & (row < a + 2048)
            ids[row[pick] - a, degree + rank[pick]], ss[row[pick] - a, degree + rank[pick]] = source[pick], s[pick]
            twice = np.sort(ids, 1)
            if ((twice[:, 1:] == twice[:, :-1]) & (twice[:, 1:] >= 0)).any():  # joined from both sides already
                old = (ids[:, :degree, None] == ids[:, None, degree:]) & (ids[:, :degree, None] >= 0)
                again = old.any(1)
                ids[:, degree:][again], ss[:, degree:][again] = -1, -2.0
            order = np.argsort(-ss, axis=1, kind="stable")
            ids, ss = np.take_along_axis(ids, order, 1), np.take_along_axis(ss, order, 1)
            near[part], sims[part] = _spread(ids, ss, self.x, degree)

    def _entries(self, q: np.ndarray, layers: list, below: int) -> np.ndarray:
        """Entry points (queries x 4) for the layer below ``layers``; nodes from ``below`` on are not there yet."""
        at = np.zeros((len(q), 1), np.int32)
        for _, near in layers:
            at, _ = self._beam(q, near, at, 4)
            at = np.where((at < 0) | (at >= below), 0, at)
        return at

    def _beam(self, q: np.ndarray, near: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``beam`` nodes found for each query (ids, similarities; -1 and -2 where fewer)."""
        n = len(q)
        rows = np.arange(n)[:, None]
        seen = np.zeros((n, len(near) + 1), bool)   # one more column takes the marks of "no neighbour"
        entry = np.sort(entry, 1)
        entry[:, 1:][entry[:, 1:] == entry[:, :-1]] = -1
        width = max(beam, entry.shape[1])
        ids, sims, open_ = np.full((n, width), -1, np.int32), np.full((n, width), -2.0, np.float32), np.zeros((n, width), bool)
        k = entry.shape[1]
        ids[:, :k] = entry
        sims[:, :k] = np.where(entry >= 0, np.einsum("bmd,bd->bm", self.x[entry], q), -2.0)
        open_[:, :k] = entry >= 0
        seen[rows, entry] = True
        live = np.arange(n)
        while len(live):
            s = np.where(open_[live], sims[live], -3.0)
            pick = np.argsort(-s, axis=1, kind="stable")[:, :EXPAND]
            good = np.take_along_axis(s, pick, 1) > -2.5
            node = np.where(good, ids[live[:, None], pick], -1)
            open_[live[:, None], pick] = False
            nb = np.where(node[:, :, None] >= 0, near[node], -1).reshape(len(live), -1)
            nb[seen[live[:, None], nb]] = -1
            nb = np.sort(nb, 1)
            nb[:, 1:][nb[:, 1:] == nb[:, :-1]] = -1
            seen[live[:, None], nb] = True
            ns = np.where(nb >= 0, np.einsum("bmd,bd->bm", self.x[nb], q[live]), -2.0).astype(np.float32)
            all_s = np.concatenate((sims[live], ns), 1)
            best = np.argpartition(-all_s, width - 1, axis=1)[:, :width]
            sims[live] = np.take_along_axis(all_s, best, 1)
            ids[live] = np.take_along_axis(np.concatenate((ids[live], nb), 1), best, 1)
            open_[live] = np.take_along_axis(np.concatenate((open_[live], nb >= 0), 1), best, 1) & (sims[live] > -1.5)
            live = live[open_[live].any(1)]
        order = np.argsort(-sims, axis=1, kind="stable")[:, :beam]
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        beam = min(beam, len(self.x))
        entry = self._entries(q, self.layers[:-1], len(self.x))
        return self._beam(q, self.layers[-1][1], entry, beam)
