"""Exact top-k search by inner product (12): a pivot-distance index.

Vectors are whole numbers (``floor(scale * c)``). With M the largest norm, a vector v gets a further component sqrt(M^2 - |v|^2) and a query one of 0; then
distance^2 = |q|^2 + M^2 - 2 q.v, so the nearest vectors are those of the highest scores. Every vector is keyed by its nearest pivot p
and its distance r to it; sorted by (pivot, r) the vectors of a pivot are annuli. For a query at distance D from p, the triangle inequality says that nothing
in the annulus [r0, r1] is nearer than max(0, r0 - D, D - r1), so none of its scores is above (|q|^2 + M^2 - that^2) / 2.

1. Pivots: far-apart vectors of a hash sample of at most ``SAMPLE`` rows. They steer the cost alone; every row is in the index.
2. Index: rows are dealt by range of (pivot, r), so a pivot with a third of all rows is many parts, and each part is cut
   into annuli of at most ``block_rows`` rows, a row each: the index is written once.
3. Every query first looks through its own annulus: its k-th score there is its first bound.
4. Queries go in groups of whole parts. A group meets a slice of the index (the annuli of a part) only if the bound of some of its queries allows it: slices and
   groups are joined by pivot, from their extremes. In a task the annuli are taken nearest first, each query leaves those that cannot reach its k-th
   score so far, and the search ends when no query can gain.
5. The best k of a query's slices are taken by (score, id).

A task holds one slice (``part_rows`` rows) and one group of queries (about ``query_rows``, a part more at most). Scores are sums of whole
numbers that float arithmetic holds exactly; the type is chosen by M^2.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from mixprep.llm.common import ship, stage
from mixprep.llm.vectors import matrix, scaled_rows

PIVOTS, SAMPLE = 128, 4_096
PART_ROWS, BLOCK_ROWS, QUERY_ROWS = 65_536, 2_048, 16_384


def far_apart(x: np.ndarray, count: int) -> np.ndarray:
    """``count`` rows of ``x``, each the farthest from those before; fewer where the rest are copies."""
    at, near = [0], ((x - x[0]) ** 2).sum(axis=1)
    while len(at) < min(count, len(x)) and near.max() > 0:
        at.append(int(near.argmax()))
        near = np.minimum(near, ((x - x[at[-1]]) ** 2).sum(axis=1))
    return x[at]


class Space:
    """Distances to the pivots in the space with the further component."""

    def __init__(self, pivots: np.ndarray, m2: int):
        self.pivots, self.m2 = pivots.astype(np.float64), float(m2)
        self.rest = self._rest((self.pivots ** 2).sum(axis=1))

    def _rest(self, norm2: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, self.m2 - norm2))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pivot, distance) of indexed rows."""
        x = x.astype(np.float64)
        d2 = 2 * (self.m2 - x @ self.pivots.T - np.outer(self._rest((x ** 2).sum(axis=1)), self.rest))
        p = d2.argmin(axis=1)
        return p.astype(np.int32), np.sqrt(np.maximum(0, d2[np.arange(len(x)), p]))

    def of_queries(self, q: np.ndarray) -> np.ndarray:
        """Distances of queries (their further component is 0) to all pivots."""
        q = q.astype(np.float64)
        return np.sqrt(np.maximum(0, (q ** 2).sum(axis=1)[:, None] + self.m2 - 2 * q @ self.pivots.T))

    def highest(self, norm2: np.ndarray, gap: np.ndarray) -> np.ndarray:
        """Bound on the scores of rows at least ``gap`` away; rounding is on the safe side."""
        return (norm2 + self.m2 - np.maximum(0, gap * (1 - 1e-9)) ** 2) / 2 * (1 + 1e-9) + 1


def number_type(m2: int) -> type:
    """The type that holds all partial sums of products exactly: none is above ``m2``."""
    return np.float32 if m2 < 2 ** 24 else np.float64 if m2 < 2 ** 53 else object


def best(query: np.ndarray, row: np.ndarray, score: np.ndarray, unnamed: np.ndarray, name: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each query by falling score, then id; rows without an id come last."""
    order = np.lexsort((row, name, unnamed, -score, query))
    q = query[order]
    first = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.empty(0, int)
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.concatenate((first, [len(q)]))))
    return order[rank < k]


def _hits(q: np.ndarray, own: np.ndarray, bound: np.ndarray, block: dict, k: int, dtype: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the block's rows that reach the queries' bounds and may be among their first ``k``; never a query's own row."""
    scores = q.astype(dtype) @ block["x"].astype(dtype).T
    mine = (own >= block["place"]) & (own < block["place"] + len(block["x"]))
    least = bound.copy()
    allowed = np.ones(scores.shape, bool)
    allowed[np.flatnonzero(mine), (own[mine] - block["place"])] = False
    if scores.shape[1] > k and dtype is not object:
        # The row of rank k, one's own out: anything below is not among the first k.
        kth = np.partition(np.where(allowed, scores, -np.inf), scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        least = np.maximum(least, kth)
    at, row = np.nonzero(allowed & (scores >= least[:, None]))
    return at, row, scores[at, row].astype(np.int64)


def _kth(query: np.ndarray, score: np.ndarray, many: int, k: int) -> np.ndarray:
    """The k-th highest score of each of ``many`` queries from its (at most k) best ones; minus infinity with fewer."""
    full = np.bincount(query, minlength=many) == k
    low = np.full(many, np.inf)
    np.minimum.at(low, query, score)
    return np.where(full, low, -np.inf)


def _pack(x: np.ndarray) -> np.ndarray:
    """The smallest whole-number type that holds ``x``."""
    for t in (np.int16, np.int32):
        if abs(x).max(initial=0) < np.iinfo(t).max:
            return x.astype(t)
    return x


def _index(space: Space, part_rows: int, block_rows: int, k: int, every: int, dtype: type):
    """Cuts sorted rows into annuli; an annulus is a row with its vectors, extremes by pivot and its queries with their first bounds."""
    def cut(held: list[pa.Table], part: int, place: int) -> dict:
        t = pa.concat_tables(held).combine_chunks()
        x, name = matrix(t.column("x").combine_chunks()), t.column("id")
        block = {"x": _pack(x), "id": name.fill_null(0).to_numpy(), "unnamed": name.is_null().to_numpy(), "place": place, "pivot": t.column("pivot").to_numpy(), "r": t.column("r").to_numpy()}
        asked = np.flatnonzero(~block["unnamed"] & (block["id"] % every == 0))
        queries = None
        if len(asked):
            q, own = x[asked], place + asked
            at, row, score = _hits(q, own, np.full(len(q), -np.inf), block, k, dtype)
            keep = best(at, row, score, block["unnamed"][row], block["id"][row], k)
            queries = {"x": _pack(q), "id": block["id"][asked], "own": own, "bound": _kth(at[keep], score[keep], len(q), k)}
        return {"slice": part, "place": place, "n": t.num_rows, "block": pickle.dumps(block, protocol=4), "asked": len(asked), "queries": queries and pickle.dumps(queries, protocol=4)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        held, rows, done = [], 0, 0

        def out(many: int) -> pa.RecordBatch:
            nonlocal held, rows, done
            t = pa.concat_tables(held)
            made = cut([t.slice(0, many)], (task << 20) + done // part_rows, (task << 40) + done)
            held, rows, done = ([t.slice(many)] if many < rows else []), rows - many, done + many
            return pa.RecordBatch.from_pylist([made], schema=SCHEMA)
        for b in batches:
            held.append(pa.Table.from_batches([b]))
            rows += b.num_rows
            while rows >= block_rows:
                yield out(block_rows)
        if rows:
            yield out(rows)
    return run


SCHEMA = pa.schema([("slice", pa.int64()), ("place", pa.int64()), ("n", pa.int64()), ("block", pa.binary()), ("asked", pa.int64()), ("queries", pa.binary())])
ENDS = pa.schema([("slice", pa.int64()), ("queries", pa.bool_()), ("pivot", pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("norm2", pa.float64()), ("bound", pa.float64())])


def _extremes(space: Space):
    """Per annulus or its queries: (slice, queries?, pivot, low, high, norm2, bound): what bounds need, and no vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for s, block, queries in zip(b.column("slice").to_pylist(), b.column("block").to_pylist(), b.column("queries").to_pylist()):
                made = pickle.loads(block)
                for p in np.unique(made["pivot"]):
                    r = made["r"][made["pivot"] == p]
                    out.append((s, False, int(p), float(r.min()), float(r.max()), 0.0, 0.0))
                if queries:
                    made = pickle.loads(queries)
                    x = made["x"].astype(np.float64)
                    d = space.of_queries(x)
                    norm2, bound = float((x ** 2).sum(axis=1).max()), float(made["bound"].min())
                    out += [(s, True, p, float(d[:, p].min()), float(d[:, p].max()), norm2, bound) for p in range(d.shape[1])]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), ENDS)], schema=ENDS)
    return run


def _search(space: Space, k: int, dtype: type):
    """One group of queries against one slice."""
    def run(key, asked: pa.Table, annuli: pa.Table) -> pa.Table:
        empty = {c: [] for c in ("query_id", "own", "vec_id", "row", "score")}
        if not asked.num_rows or not annuli.num_rows:
            return pa.Table.from_pydict(empty, schema=FOUND)
        sets = [pickle.loads(x) for x in asked.column("queries").to_pylist()]
        q, ids, own, bound = (np.concatenate([s[c] for s in sets]) for c in ("x", "id", "own", "bound"))
        q = q.astype(np.int64)
        norm2, d = (q.astype(np.float64) ** 2).sum(axis=1), space.of_queries(q)
        blocks = []
        for data in annuli.column("block").to_pylist():
            made = pickle.loads(data)
            gap = np.full(len(q), np.inf)                       # an annulus may hold the ends of several pivots
            for p in np.unique(made["pivot"]):
                r = made["r"][made["pivot"] == p]
                gap = np.minimum(gap, np.maximum(0, np.maximum(r.min() - d[:, p], d[:, p] - r.max())))
            blocks.append((made, gap, space.highest(norm2, gap)))
        blocks.sort(key=lambda x: x[1].min())                    # nearest annuli first
        found = [np.empty(0, np.int64) for _ in range(5)]       # query, row, score, unnamed, id
        for made, _, highest in blocks:
            active = np.flatnonzero(highest >= bound)
            if not len(active):
                continue
            at, row, score = _hits(q[active], own[active], bound[active], made, k, dtype)
            if not len(at):
                continue
            new = (active[at], row + made["place"], score, made["unnamed"][row].astype(np.int64), made["id"][row])
            found = [np.concatenate(c) for c in zip(found, new)]
            keep = best(*found[:4], found[4], k)
            found = [c[keep] for c in found]
            bound = np.maximum(bound, _kth(found[0], found[2], len(q), k))
        at, row, score, unnamed, name = found
        return pa.Table.from_arrays([pa.array(ids[at]), pa.array(own[at]), pa.array(name, mask=unnamed.astype(bool)), pa.array(row), pa.array(score)], schema=FOUND)
    return run


FOUND = pa.schema([("query_id", pa.int64()), ("own", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()), ("score", pa.int64())])


def exact_top_k(df: DataFrame, every: int = 100, k: int = 10, scale: float = 1024.0, id_col: str = "vec_id", vector_col: str = "embedding",
                part_rows: int = PART_ROWS, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS, pivots: int = PIVOTS) -> DataFrame:
    """The ``k`` highest inner products of every row whose id is divisible by ``every`` with all other rows: query_id, rank (from 1), vec_id, score.

    Ties go to the smaller id, rows without an id last. A row is never its own candidate, but another row of the same id is one, and rows
    that repeat an id divisible by ``every`` are queries each. Fewer rows than ``k``: all. Null or non-finite components leave a vector out,
    shorter vectors are filled up with zeros (``vectors.scaled_rows``). A score beyond a long fails the job. Ids are whole numbers. Other columns are not read. No rows in, no rows out.
    """
    spark = df.sparkSession
    ship(spark)
    rows = scaled_rows(df, id_col, vector_col, scale).select(F.col("id").cast("bigint").alias("id"), "x")
    rows = stage(rows, "scaled")
    norm2 = F.aggregate("x", F.lit(0).cast("decimal(38,0)"), lambda a, c: (a + c.cast("decimal(19,0)") * c).cast("decimal(38,0)"))
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.max(norm2).alias("m2")).first()
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not r["n"]:
        return spark.createDataFrame([], schema)
    n, m2 = int(r["n"]), int(r["m2"])
    if m2 >= 2 ** 63:
        raise OverflowError("scores beyond a long")
    dtype = number_type(m2)
    h = F.shiftrightunsigned(F.xxhash64(F.lit(12), "x"), 2)
    drawn = rows.select("x").filter(h < int(min(1.0, SAMPLE / (2 * n)) * 2 ** 62)).limit(SAMPLE).collect() or rows.select("x").limit(1).collect()
    sample = np.array(sorted({tuple(x["x"]) for x in drawn}), np.float64).reshape(-1, len(drawn[0]["x"]))
    space = Space(far_apart(sample, pivots), m2)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, 8192):
                part = b.slice(a, 8192)
                p, dist = space.nearest(matrix(part.column("x")))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("x"), pa.array(p), pa.array(dist)], names=["id", "x", "pivot", "r"])
    keyed = rows.mapInArrow(place, "id bigint, x array<bigint>, pivot int, r double").withColumn("h", F.xxhash64(F.lit(13), "id"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // part_rows))
    keyed = keyed.repartitionByRange(parts, "pivot", "r", "h").sortWithinPartitions("pivot", "r", "h").select("id", "x", "pivot", "r")
    index = stage(keyed.mapInArrow(_index(space, part_rows, block_rows, k, every, dtype), "slice bigint, place bigint, n bigint, block binary, asked bigint, queries binary"), "annuli")

    # Consecutive parts make a group of queries; a row a part, so this window is over one row in `part_rows` vectors.
    w = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    asked = index.groupBy("slice").agg(F.sum("asked").alias("asked"))
    groups = stage(asked.select("slice", F.floor(F.coalesce(F.sum("asked").over(w), F.lit(0)) / query_rows).alias("group")), "groups")
    ends = stage(index.select("slice", "block", "queries").mapInArrow(_extremes(space), "slice bigint, queries boolean, pivot int, low double, high double, norm2 double, bound double"), "extremes")
    slices = ends.filter("not queries").groupBy("slice", "pivot").agg(F.min("low").alias("r0"), F.max("high").alias("r1"))
    of_group = ends.filter("queries").join(groups, "slice").groupBy("group", "pivot").agg(
        F.min("low").alias("d0"), F.max("high").alias("d1"), F.max("norm2").alias("norm2"), F.min("bound").alias("bound"))
    gap = F.greatest(F.lit(0.0), F.col("r0") - F.col("d1"), F.col("d0") - F.col("r1")) * (1 - 1e-9)
    reach = (F.col("norm2") + float(m2) - gap * gap) / 2 * (1 + 1e-9) + 1 >= F.col("bound")
    pairs = stage(slices.join(of_group, "pivot").filter(reach).select("group", "slice").distinct(), "pairs")
    left = index.filter("asked > 0").select("slice", "queries").join(groups, "slice").select("group", "queries")
    left = left.join(pairs, "group").select("group", "slice", "queries")
    right = index.select("slice", "block").join(pairs, "slice").select("group", "slice", "block")
    found = left.groupBy("group", "slice").cogroup(right.groupBy("group", "slice")).applyInArrow(
        _search(space, k, dtype), "query_id bigint, own bigint, vec_id bigint, row bigint, score bigint")
    w = Window.partitionBy("own").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    top = found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return top.select("query_id", "rank", "vec_id", "score")
