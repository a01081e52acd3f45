"""MinHash near-dedup (3): SuperMinHash signatures, banding, verification on full sets, union-find groups.

SuperMinHash (Ertl 2017) gives every element its own random permutation of the slots; slot p of the
signature is the least ``j + r`` over elements whose permutation has p at rank j. Ranks of one element
are all different, which lowers the variance against independent slots. It runs here level by level:
all elements of a batch do rank 0, then those of documents whose signature can still change do rank 1, and
so on. A document stops as soon as its largest slot is below the next rank: no later rank can be lower.

No bucket ever emits its pairs. Documents of equal sets are one representative. Then

1. each representative is verified against one pivot, the smallest id it shares most bands with, and the
   links are grouped;
2. buckets that still hold several groups are cut into cells of two blocks of at most about ``block`` documents;
   the members outside a bucket's largest group meet all others in such cells, which return only a spanning
   forest of the links found.

A pair that shares a band is thus either in one group already or compared on its full sets.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mixprep.llm.common import arrow_map, drop_rows, keep_columns, stage
from mixprep.llm.components import connected_components
from mixprep.llm.exact_dedup import source_path

#: 20 bands of 5 slots: a pair at similarity 0.85 shares no band with probability 8e-6, at 0.8 with 4e-4.
BANDS, ROWS = 20, 5
#: Words of a shingle.
WORDS = 5
#: Elements per numpy batch.
BATCH_ELEMENTS = 400_000
#: Candidate ids up to which their (id, pivot) table is broadcast: 16 MB of longs; beyond, a shuffled join.
BROADCAST_IDS = 1_000_000
#: The column of the row keys, and the bits of a row's number in its file.
ROW, ROW_BITS = "near_dedup_row", 36

_U = np.uint64
_M1, _M2, _GOLD = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB), _U(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; fewer words than ``words`` are one shingle."""
    import xxhash
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and [\x20\x09-\x0D] only
    if not parts:
        return np.empty(0, _U)
    h = np.fromiter(map(xxhash.xxh64_intdigest, parts), _U, len(parts))
    k = min(words, len(parts))
    out = np.full(len(parts) - k + 1, k, _U)
    for i in range(k):
        out = out * _GOLD + h[i:i + len(out)]
    out = np.sort(_mix(out))
    return out[np.concatenate(([True], out[1:] != out[:-1]))] if len(out) > 1 else out


def superminhash(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """Signatures (documents x slots) of sets of hashes; rows of empty sets are infinite."""
    sign = np.full((len(sets), slots), np.inf)
    flat = sign.reshape(-1)
    e = np.concatenate(sets) if sets else np.empty(0, _U)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    swaps: list[np.ndarray] = []
    for j in range(slots):
        if not len(e):
            break
        x = _mix(e + _U((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        r = (x >> _U(11)) * 2.0 ** -53
        k = (_U(j) + (((_mix(x ^ _GOLD) >> _U(32)) * _U(slots - j)) >> _U(32))).astype(np.int32)
        at = k.copy()                        # Fisher-Yates: what stands at place k after the swaps so far
        for i in range(j - 1, -1, -1):
            at[swaps[i] == at] = i
        np.minimum.at(flat, doc * slots + at, j + r)
        swaps.append(k)
        alive = sign.max(axis=1) >= j + 1
        on = alive[doc]
        if not on.all():
            e, doc, swaps = e[on], doc[on], [s[on] for s in swaps]
    return sign


def band_keys(sign: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band (documents x bands)."""
    bits = np.ascontiguousarray(sign).view(_U).reshape(len(sign), bands, rows)
    key = np.arange(bands, dtype=_U)[None, :] * _M1 + _GOLD
    for i in range(rows):
        key = _mix(key * _GOLD + bits[:, :, i])
    return key.view(np.int64)


def signatures(df: DataFrame, words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, doc, n_shingles, set_hash, bands) of (id, doc, text): the band keys are null for empty sets."""
    def make():
        import xxhash

        def step(batch: pa.RecordBatch) -> dict:
            texts = batch.column("text").to_pylist()
            n, hashes, keys = [], [], []
            group: list[np.ndarray] = []

            def flush():
                if group:
                    found = band_keys(superminhash(group, bands * rows), bands, rows)
                    keys.extend(k if len(s) else None for k, s in zip(found.tolist(), group))
                    group.clear()
            held = 0
            for t in texts:
                s = shingle_set(t, words)
                n.append(len(s))
                hashes.append(xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None)
                group.append(s)
                held += len(s)
                if held > BATCH_ELEMENTS:
                    flush()
                    held = 0
            flush()
            return {"id": batch.column("id"), "doc": batch.column("doc"), "n_shingles": pa.array(n, pa.int64()), "set_hash": pa.array(hashes, pa.string()),
                    "bands": pa.array(keys, pa.list_(pa.int64()))}
        return step
    return arrow_map(df, make, "id bigint, doc bigint, n_shingles bigint, set_hash string, bands array<bigint>")


def _numbered(df: DataFrame) -> DataFrame:
    """The rows of ``df``, from their files or a staged copy, with a key of their own: the number of the file and the row in it."""
    spark, path = df.sparkSession, source_path(df)
    back = spark.read.parquet(path)
    names = sorted(r[0] for r in back.select(F.col("_metadata.file_name")).distinct().collect())
    files = spark.createDataFrame(list(enumerate(names)), f"{ROW}_file bigint, {ROW}_name string")
    rows = back.select("*", F.col("_metadata.file_name").alias(f"{ROW}_name"), F.col("_metadata.row_index").alias(f"{ROW}_at"))
    key = F.shiftleft(f"{ROW}_file", ROW_BITS) + F.col(f"{ROW}_at")
    return rows.join(F.broadcast(files), f"{ROW}_name").select(*[F.col(f"`{c}`") for c in df.columns], key.alias(ROW))


def similar(inter, a, b, percent: int):
    """``100 * intersection >= percent * union``."""
    return 100 * inter >= percent * (a + b - inter)


def _verify_star(pairs: DataFrame, percent: int) -> DataFrame:
    """(u, v) of the rows (id, s, pivot, t) whose full sets ``s`` and ``t`` are similar."""
    def make():
        def step(batch: pa.RecordBatch) -> dict:
            ids, pivots = batch.column("id").to_pylist(), batch.column("pivot").to_pylist()
            ok = []
            for s, t in zip(batch.column("s"), batch.column("t")):
                a, b = np.frombuffer(s.as_buffer(), _U), np.frombuffer(t.as_buffer(), _U)
                if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                    ok.append(False)
                    continue
                both = np.concatenate((a, b))
                both.sort()
                ok.append(similar(int((both[1:] == both[:-1]).sum()), len(a), len(b), percent))
            return {"u": pa.array([i for i, k in zip(ids, ok) if k], pa.int64()), "v": pa.array([p for p, k in zip(pivots, ok) if k], pa.int64())}
        return step
    return arrow_map(pairs.select("id", "s", "pivot", "t"), make, "u bigint, v bigint")


def linked_pairs(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Boolean matrix: which sets are similar, by exact intersections."""
    sizes = np.array([len(s) for s in sets])
    flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    values, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    shared = counts[inverse] > 1                       # an element of one set alone is in no intersection
    column = np.cumsum(counts > 1)[inverse[shared]] - 1
    row = row[shared]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    inter = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [begin, begin + width])
        m = np.zeros((len(sets), width), np.float32)
        m[row[a:b], column[a:b] - begin] = 1
        inter += m @ m.T
    inter = np.rint(inter).astype(np.int64)
    return similar(inter, sizes[:, None], sizes[None, :], percent) & (sizes[:, None] > 0) & (sizes[None, :] > 0)


def _cell_links(percent: int):
    """Per cell: a spanning forest (u, v) of the links between documents of different groups."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        ids, comp, part = rows["id"].to_numpy(), rows["comp"].to_numpy(), rows["part"].to_numpy()
        link = linked_pairs([np.frombuffer(s, _U) for s in rows["s"]], percent)
        link &= comp[:, None] != comp[None, :]
        if part.min() != part.max():
            link &= part[:, None] != part[None, :]
        parent = list(range(len(ids)))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i
        first: dict[int, int] = {}
        for i, c in enumerate(comp.tolist()):          # one group is one node
            parent[i] = root(first.setdefault(c, i))
        out = []
        for i, j in np.argwhere(np.triu(link)).tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[a] = b
                out.append((ids[i], ids[j]))
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")
    return run


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, words: int = WORDS,
               bands: int = BANDS, rows: int = ROWS, block: int = 128) -> DataFrame:
    """One row per input row: id column, n_shingles, component_id, kept.

    Linked are documents with ``100 * intersection >= percent * union`` of their sets of distinct word shingles.
    ``component_id`` is the smallest id reachable by links, the own one included; ``kept`` marks one row of it. Null, empty and
    blank texts have the empty set and are linked with nothing. Every row is a document, also where ids repeat or are
    null: null ids come after all others, and a group of null ids alone has a null ``component_id``; of rows that
    repeat the smallest id, the first by file and place is kept. Other columns are not read. No rows in, no rows out.
    """
    return _near(_numbered(df), id_col, text_col, percent, words, bands, rows, block).drop(ROW)


def _near(df: DataFrame, id_col: str, text_col: str, percent: int, words: int = WORDS, bands: int = BANDS, rows: int = ROWS, block: int = 128) -> DataFrame:
    """``near_dedup`` of numbered rows, with their numbers. Here ``id`` is a row's number and ``doc`` its id."""
    docs = keep_columns(df, {ROW: "id", id_col: "doc", text_col: "text"}).select("id", F.col("doc").cast("bigint").alias("doc"), "text")
    sign = stage(signatures(docs, words, bands, rows), "sign")
    first = F.struct(F.col("doc").isNull().alias("none"), "doc", "id")
    same = stage(sign.filter("set_hash is not null").groupBy("set_hash").agg(F.min(first).alias("first")).withColumn("rep", F.col("first.id")), "same")
    member = stage(sign.select("id", "doc", "n_shingles", "set_hash").join(same, "set_hash", "left").select("id", "doc", "n_shingles", "first", "rep"), "member")

    banded = sign.join(same.select(F.col("rep").alias("id"), "set_hash"), ["id", "set_hash"], "left_semi")
    banded = stage(banded.select(F.col("id"), F.explode("bands").alias("key")), "banded")
    buckets = stage(banded.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("pivot")).filter("n > 1"), "buckets")
    held = stage(banded.join(buckets.select("key", "n", "pivot"), "key"), "held")              # rows of shared buckets alone

    votes = held.groupBy("id", "pivot").agg(F.count(F.lit(1)).alias("c"))
    pivots = stage(votes.groupBy("id").agg(F.max(F.when(F.col("pivot") != F.col("id"), F.struct("c", (-F.col("pivot")).alias("p")))).alias("best"))
                   .select(F.col("id").alias("cand"), (-F.col("best.p")).alias("pivot")), "pivots")
    cand = F.broadcast(pivots) if pivots.count() <= BROADCAST_IDS else pivots.hint("shuffle_hash")

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            return {"id": batch.column("id"), "pivot": batch.column("pivot"),
                    "s": pa.array([shingle_set(t, words).tobytes() for t in batch.column("text").to_pylist()], pa.binary())}
        return step
    texts = docs.join(cand, F.col("id") == F.col("cand")).select("id", "pivot", "text")
    sets = stage(arrow_map(texts, make, "id bigint, pivot bigint, s binary"), "sets")

    star = sets.filter("pivot is not null").join(sets.select(F.col("id").alias("pivot"), F.col("s").alias("t")), "pivot")
    links = stage(_verify_star(star, percent), "links")
    group = stage(connected_components(links), "group")

    # Buckets that still hold several groups; of equal buckets one, and none that the star has decided.
    here = held.join(group.select(F.col("node").alias("id"), "component"), "id", "left").select("key", "n", "pivot", "id", F.coalesce("component", "id").alias("comp"))
    by_comp = stage(here.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum(F.shiftright(F.xxhash64("id"), 24)).alias("h"), F.max("id").alias("last"),
                                                    F.min("n").alias("n"), F.min("pivot").alias("pivot")), "by-comp")
    open_ = by_comp.groupBy("key").agg(F.min("n").alias("n"), F.min("pivot").alias("pivot"), F.sum("h").alias("h"), F.max("last").alias("last"),
                                       F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max(F.struct("c", (-F.col("comp")).alias("m"))).alias("main"))
    open_ = open_.filter("lo < hi").groupBy("n", "h", "pivot", "last").agg(F.min(F.struct("key", "main")).alias("b")).select("n", "pivot", "last", "b.key", "b.main")
    decided = pivots.filter("pivot is not null").select(F.col("cand").alias("last"), "pivot", F.lit(2).cast("bigint").alias("n"))
    open_ = stage(open_.join(decided, ["last", "pivot", "n"], "left_anti").select(
        "key", "n", (-F.col("main.m")).alias("main"), F.when(F.col("main.c") > 1, F.col("main.c")).otherwise(F.lit(0)).alias("inside")), "open")

    cells = here.select("key", "id", "comp").join(open_, "key")
    inside = (F.col("inside") > 0) & (F.col("comp") == F.col("main"))
    n_out, n_in = F.ceil((F.col("n") - F.col("inside")) / block).cast("int"), F.ceil(F.col("inside") / block).cast("int")
    own = F.pmod(F.xxhash64(F.lit(11), "id"), F.when(inside, n_in).otherwise(n_out)).cast("int")
    cells = cells.select("key", "id", "comp", inside.alias("inside"), n_out.alias("n_out"), n_in.alias("n_in"), own.alias("own"))
    meets_out = F.transform(F.sequence(F.lit(0), F.col("n_out") - 1), lambda o: F.when(
        F.col("inside"), F.struct(F.lit(1).alias("kind"), o.alias("a"), F.col("own").alias("b"))).otherwise(
        F.struct(F.lit(0).alias("kind"), F.least(o, "own").alias("a"), F.greatest(o, "own").alias("b"))))
    meets_in = F.when(F.col("inside") | (F.col("n_in") == 0), F.array().cast("array<struct<kind:int,a:int,b:int>>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(F.col("n_in") - 1, F.lit(0))), lambda a: F.struct(F.lit(1).alias("kind"), F.col("own").alias("a"), a.alias("b"))))
    cells = cells.select("key", "id", "comp", F.explode(F.concat(meets_out, meets_in)).alias("cell"), F.when(F.col("inside"), F.lit(-1)).otherwise(F.col("own")).alias("part"))
    cells = cells.join(sets.select("id", "s"), "id").select("key", "cell.kind", "cell.a", "cell.b", "id", "comp", "part", "s")
    more = stage(cells.groupBy("key", "kind", "a", "b").applyInPandas(_cell_links(percent), "u bigint, v bigint"), "more")
    if not more.isEmpty():
        own_links = group.select(F.col("node").alias("u"), F.col("component").alias("v"))
        group = stage(connected_components(own_links.unionByName(more)), "group")
    nodes = group.select(F.col("node").alias("rep"), "component")
    nodes = stage(nodes.unionByName(nodes.select(F.col("component").alias("rep"), "component").distinct()), "nodes")
    least = stage(nodes.join(same.select("rep", "first"), "rep").groupBy("component").agg(F.min("first").alias("least")), "least")
    nodes = nodes.join(F.broadcast(least) if least.count() <= BROADCAST_IDS // 4 else least, "component").select("rep", "least")
    out = member.join(nodes, "rep", "left").select("id", "doc", "n_shingles", F.coalesce("least", "first", first).alias("best"))
    return out.select(F.col("doc").alias(id_col), "n_shingles", F.col("best.doc").alias("component_id"), (F.col("id") == F.col("best.id")).alias("kept"), F.col("id").alias(ROW))


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, bands: int = BANDS) -> DataFrame:
    """The rows, with all their columns, that stay: one of every group of linked documents (see ``near_dedup``)."""
    rows = _numbered(df)
    copies = stage(_near(rows, id_col, text_col, percent, bands=bands).filter("not kept").select(ROW), "near-copies")
    return drop_rows(rows, copies, ROW).select(*[F.col(f"`{c}`") for c in df.columns])
