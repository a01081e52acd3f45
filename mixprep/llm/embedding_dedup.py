"""Embedding near-dedup (6): small-world graphs per shard, beams widened until recall audits pass, cosine
verified in double precision, components by union-find.

Vectors of a label are dealt by hash into shards of about ``shard_rows``; a graph is built per shard and
written. Every vector queries every shard of its label, in blocks of about ``query_rows``, so a label with a
third of all vectors becomes many tasks. A task audits a sample of its queries against all rows of its shard and
doubles the beam until they agree, query by query; a query whose whole beam is linked is widened on its own, and
past ``max_beam`` it is answered by a scan of the shard, so no number of partners is a cap.
Equal vectors are one node with a weight. A task returns a count per query and a spanning forest of its links.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from mixprep.llm.common import keep_columns, ship, stage
from mixprep.llm.components import connected_components
from mixprep.llm.hnsw import Graph

SHARD_ROWS, QUERY_ROWS = 16_384, 4_096
FIRST_BEAM, MAX_BEAM, AUDITED, RECALL = 32, 256, 64, 0.98
#: What float32 search may be off.
SLACK = 1e-4


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _exact(q: np.ndarray, x: np.ndarray, least: float) -> list[np.ndarray]:
    """Rows of ``x`` linked to each query, by double precision, in blocks."""
    out = []
    for a in range(0, len(q), 256):
        out += [np.flatnonzero(row >= least) for row in q[a:a + 256] @ x.T]
    return out


def _by_graph(graph: Graph, q: np.ndarray, x: np.ndarray, least: float, beam: int, max_beam: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows linked to each query, and which queries were answered by a scan."""
    out: list[np.ndarray] = [np.empty(0, int)] * len(q)
    todo = np.arange(len(q))
    while len(todo) and beam < len(x) and beam <= max_beam:
        full = []
        for a in range(0, len(todo), 512):
            part = todo[a:a + 512]
            ids, sims = graph.search(q[part].astype(np.float32), beam)
            truncated = (sims[:, -1] >= least - SLACK) & (ids[:, -1] >= 0)
            full.append(part[truncated])
            near = (sims >= least - SLACK) & (ids >= 0)
            for i in np.flatnonzero(~truncated):
                found = ids[i, near[i]]
                out[part[i]] = np.sort(found[x[found] @ q[part[i]] >= least]) if len(found) else found
        todo, beam = np.concatenate(full), 2 * beam
    for i, found in zip(todo, _exact(q[todo], x, least) if len(todo) else []):
        out[i] = found
    scanned = np.zeros(len(q), bool)
    scanned[todo] = True
    return out, scanned


def linked(graph: Graph, q: np.ndarray, x: np.ndarray, least: float, first_beam: int = FIRST_BEAM, max_beam: int = MAX_BEAM,
           audited: int = AUDITED, recall: float = RECALL, own: np.ndarray | None = None) -> list[np.ndarray]:
    """Rows of ``x`` with inner product of at least ``least`` for each unit vector of ``q``; ``own`` is the row that is the query itself, or -1.

    Recall is the mean over the audited queries that the graph answers: the share of a query's partners that it found, or, of a
    query without partners, whether the nearest row was in the beam. A query that finds itself, or that a scan answered,
    says nothing about the graph; where a scan answers more than three quarters, it answers all.
    """
    if len(x) <= 2 * first_beam:
        return _exact(q, x, least)
    sample = np.linspace(0, len(q) - 1, min(audited, len(q))).astype(int)
    sims = q[sample] @ x.T
    if own is not None:
        at = np.flatnonzero(own[sample] >= 0)
        sims[at, own[sample][at]] = -np.inf
    want, nearest, beam = [np.flatnonzero(row >= least) for row in sims], sims.argmax(axis=1), first_beam
    while beam <= max_beam:
        got, scanned = _by_graph(graph, q[sample], x, least, beam, max_beam)
        ids, _ = graph.search(q[sample].astype(np.float32), beam)
        share = np.array([np.isin(w, g).mean() if len(w) else float(k in i) for w, g, k, i in zip(want, got, nearest, ids)])[~scanned]
        if 4 * len(share) < len(sample):
            break
        if share.mean() >= recall:
            return _by_graph(graph, q, x, least, beam, max_beam)[0]
        beam *= 2
    return _exact(q, x, least)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For links ``a``-``b``: (node, root) of every node that is not the root of its component."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    i, j = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("h", kind="stable")       # random order that no partitioning changes
    x = unit(np.stack(rows["v"].to_numpy()).astype(np.float64))
    graph = Graph.build(x.astype(np.float32))
    data = pickle.dumps({"id": rows["id"].to_numpy(), "w": rows["w"].to_numpy(), "x": x, "layers": graph.layers}, protocol=4)
    return pd.DataFrame({"part": [rows["part"].iloc[0]], "shard": [rows["shard"].iloc[0]], "graph": [data]})


def _query(least: float):
    def run(index: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(index) or not len(rows):
            return pd.DataFrame({"u": [], "v": [], "n": []}).astype("int64")
        made = pickle.loads(index["graph"].iloc[0])
        x, ids, w = made["x"], made["id"], made["w"]
        rows = rows.sort_values("h", kind="stable")
        own = rows["id"].to_numpy()
        q = unit(np.stack(rows["v"].to_numpy()).astype(np.float64))
        order = np.argsort(ids)
        place = order[np.minimum(np.searchsorted(ids, own, sorter=order), len(ids) - 1)]
        found = linked(Graph(x.astype(np.float32), made["layers"]), q, x, least, own=np.where(ids[place] == own, place, -1))
        n = np.array([w[f].sum() - w[f[ids[f] == i]].sum() for i, f in zip(own, found)], np.int64)
        a = np.repeat(own, [len(f) for f in found])
        b = ids[np.concatenate(found)] if len(a) else a
        u, v = forest(a, b) if len(a) else (a, a)
        return pd.DataFrame({"u": np.concatenate((own, u)), "v": np.concatenate((own, v)), "n": np.concatenate((n, np.full(len(u), -1)))}).astype("int64")
    return run


def embedding_dedup(df: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """One row per vector: id column, n_links, component_id, kept.

    Vectors are compared only where labels are equal and not null and they have as many components. Vectors
    that are null, empty, zero or hold a null or non-finite component link with nothing. ``n_links`` counts the other
    vectors linked directly, equal ones included. Ids must be whole numbers that are not repeated; rows with a null
    id are left out. Other columns are not read. No rows in, no rows out.
    """
    ship(df.sparkSession)
    rows = keep_columns(df, {id_col: "id", vector_col: "v", label_col: "label"}).filter("id is not null")
    rows = rows.select(F.col("id").cast("bigint").alias("id"), F.col("v").cast("array<double>").alias("v"), F.col("label").cast("string").alias("label"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & ~bad & F.exists("v", lambda c: c != 0), F.lit(False))
    # The label's length comes first, so no label can be read as the beginning of another's vector.
    key = F.sha2(F.concat_ws(",", F.length("label").cast("string"), F.col("label"), F.transform("v", lambda c: c.cast("string"))), 256)
    rows = stage(rows.select("id", "v", "label", F.when(usable, key).alias("key")), "vectors")
    same = stage(rows.filter("key is not null").groupBy("key").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("w")), "same")

    reps = rows.join(same.select(F.col("rep").alias("id"), "w"), "id").filter("key is not null")
    reps = reps.select("id", "v", "w", F.concat_ws("#", F.size("v").cast("string"), "label").alias("part"), F.xxhash64(F.lit(3), "id").alias("h"))
    sizes = reps.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    sizes = stage(sizes.select("part", F.ceil(F.col("n") / shard_rows).cast("int").alias("shards"), F.ceil(F.col("n") / query_rows).cast("int").alias("blocks")), "sizes")
    reps = stage(reps.join(sizes, "part").withColumn("shard", F.pmod(F.xxhash64(F.lit(4), "id"), "shards").cast("int")), "reps")

    index = stage(reps.select("id", "v", "w", "h", "part", "shard").groupBy("part", "shard").applyInPandas(_build, "part string, shard int, graph binary"), "graphs")
    asked = reps.select("id", "v", "h", "part", F.pmod(F.xxhash64(F.lit(6), "id"), "blocks").cast("int").alias("block"),
                        F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    index = index.join(sizes.select("part", "blocks"), "part").select("part", "shard", "graph", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    found = index.groupBy("part", "shard", "block").cogroup(asked.groupBy("part", "shard", "block")).applyInPandas(_query(least), "u bigint, v bigint, n bigint")
    found = stage(found, "links")
    counts = found.filter("n >= 0").groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("n"))
    group = connected_components(found.filter("n < 0").select("u", "v"))
    member = rows.select("id", "key").join(same, "key", "left").select("id", F.coalesce("rep", "id").alias("rep"), F.coalesce("w", F.lit(1)).alias("w"))
    of_rep = stage(same.select("rep").join(counts, "rep", "left").join(group.select(F.col("node").alias("rep"), "component"), "rep", "left"), "of-rep")
    out = member.join(of_rep, "rep", "left").select(
        "id", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
