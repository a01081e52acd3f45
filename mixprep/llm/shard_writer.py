"""Token-ID / binary output (10): sequences written in training order, as shards of fixed-stride records.

Every sequence has an index, dense from 0, that depends on the documents' ids and tokens alone. A keyed Feistel network permutes the
next power of four above the number of sequences, and walks on from every value outside until one lies inside
(cycle-walking): that is the sequence's global slot. A shard is a range of slots; its file holds one record of
``stride`` bytes per slot, so record s of a training run is at ``(s - first slot) * stride`` of its shard, and reading
can begin anywhere. The inverse network names the sequence that stands at a slot.

The tokens are written once, compressed, while the counts that make the index are gathered, and cross one shuffle:
compressed blocks of all records that a batch has for a shard.
"""

from __future__ import annotations

import pickle
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from mixprep.llm.common import arrow_map, byte_batches, keep_columns, scratch_path, stage
from mixprep.llm.sharding import BUCKET_ROWS, _offsets, _range
from mixprep.llm.word_tokens import WordTokens, split_words

ROUNDS = 6
#: Words that a worker keeps: tokens are most of the work here, and a task holds little else.
KEPT_WORDS = 1_000_000
SHARD_BYTES = 16 << 20
BATCH_BYTES = 4 << 20
#: Documents up to which (row, first index) is broadcast: about 70 MB as broadcast; beyond, a shuffled join.
BROADCAST_ROWS = 1_000_000
_U = np.uint64


def _round(x: np.ndarray, key: int, r: int) -> np.ndarray:
    x = (x + _U((key * 2 + 1) * (r + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(29))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(32))


def feistel(index: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """The keyed permutation of ``0 .. n - 1``, or its inverse."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask, shift = _U((1 << half) - 1), _U(half)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & mask
        for r in range(ROUNDS):
            if inverse:
                left, right = right ^ (_round(left, key, ROUNDS - 1 - r) & mask), left
            else:
                left, right = right, left ^ (_round(right, key, r) & mask)
        return (left << shift) | right

    out = once(np.asarray(index).astype(_U))
    while True:
        outside = out >= _U(n)
        if not outside.any():
            return out.astype(np.int64)
        out[outside] = once(out[outside])


def _tokens(df: DataFrame, path: str, end_id: int, dtype: str) -> DataFrame:
    id_type = df.schema["id"].dataType.simpleString()

    def make():
        words, end = WordTokens.of(path, "ids", dtype, KEPT_WORDS), np.asarray([end_id], dtype).tobytes()

        def step(batch: pa.RecordBatch) -> dict:
            texts = batch.column("text").to_pylist()
            out = []
            for a, b in byte_batches([len(t or "") for t in texts], BATCH_BYTES):
                split = [split_words(t or "") for t in texts[a:b]]
                got, at = words.values([w for ws in split for w in ws]), 0
                for ws in split:
                    out.append(b"".join(got[at:at + len(ws)] + [end]))
                    at += len(ws)
            size = np.dtype(dtype).itemsize
            return {"id": batch.column("id"), "n": pa.array([len(x) // size for x in out], pa.int64()), "crc": pa.array([zlib.crc32(x) for x in out], pa.int64()),
                    "ids": pa.array(out, pa.binary())}
        return step
    return arrow_map(df, make, f"id {id_type}, n bigint, crc bigint, ids binary")


def first_indices(docs: DataFrame, window: int) -> DataFrame:
    """(row, first): the index of a document's first sequence. Documents are in the order of a hash of their id, length and checksum, dealt into
    hash ranges; counts per range give each its offset, so no task numbers more than a range (documents that are equal in all three lie in one).
    Equal documents may change places, which changes no file."""
    ranges = max(1, -(-docs.count() // BUCKET_ROWS))
    thin = docs.select("row", "id", "n", "crc", F.ceil(F.col("n") / window).alias("windows"), F.shiftrightunsigned(F.xxhash64(F.lit(29), "id", "n", "crc"), 2).alias("h"))
    thin = thin.withColumn("bucket", _range("h", F.lit(ranges))).withColumn("one", F.lit(0))
    before = _offsets(thin.groupBy("one", "bucket").agg(F.sum("windows").alias("n")), ["one"], "bucket").select("bucket", "before")
    w = Window.partitionBy("bucket").orderBy("h", F.col("id").asc_nulls_first(), "n", "crc", "row").rowsBetween(Window.unboundedPreceding, -1)
    found = thin.withColumn("here", F.coalesce(F.sum("windows").over(w), F.lit(0))).join(before, "bucket")
    return found.select("row", (F.col("here") + F.col("before")).alias("first"))


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that Spark gives it, so that every executor means the same folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def _file_system(uri: str):
    """(file system, path in it) of a folder any executor reaches."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:                                 # ``write_shards`` qualifies its folder, so this is a reader's own path
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def write_shards(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = 256, end_id: int = 1, pad_id: int = 0,
                 key: int = 20_240, shard_bytes: int = SHARD_BYTES, dtype: str = "<u2", out: str | None = None) -> DataFrame:
    """Write the sequences of all documents; one row per sequence: id column, start, length, index, slot, shard, byte_offset,
    ids_crc32, file, folder: the manifest.

    The files are written by the tasks that make the manifest's rows, so when the returned frame is first evaluated, as a rule by
    writing it; evaluating it again writes the same bytes again.

    A document's ids, with ``end_id`` behind them, are cut into windows; each is a sequence of ``length`` ids, padded with
    ``pad_id`` to a record of ``window`` ids of ``dtype`` (little-endian unsigned). Files go to ``out``, by default a fresh folder in the
    shared one, each under a name of its own first and then moved, so a task that runs again replaces its file by the same bytes.
    A null or empty text is the end id alone. Rows that repeat an id are sequences each. Other columns are not read. No rows in,
    no file and no rows out. Ids of the tokenizer must fit ``dtype``.
    """
    spark = df.sparkSession
    id_type = df.schema[id_col].dataType.simpleString()
    out = qualified(spark, out or scratch_path(spark, "shards"))
    staged = scratch_path(spark, "tokens")
    tokens = _tokens(keep_columns(df, {id_col: "id", text_col: "text"}), path, end_id, dtype)
    tokens.withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(staged)
    docs = spark.read.parquet(staged)
    firsts = stage(first_indices(docs.select("row", "id", "n", "crc"), window), "firsts")
    total = docs.agg(F.sum(F.ceil(F.col("n") / window)).alias("n")).first()["n"] or 0
    size = np.dtype(dtype).itemsize
    stride = window * size
    per_shard = max(1, shard_bytes // stride)
    shards = max(1, -(-total // per_shard))
    firsts = F.broadcast(firsts) if docs.count() <= BROADCAST_ROWS else firsts

    def make_blocks():
        import zstandard
        squeeze = zstandard.ZstdCompressor(level=3)

        def step(batch: pa.RecordBatch) -> dict:
            ids, first, data = batch.column("id").to_pylist(), batch.column("first").to_numpy(), batch.column("ids").to_pylist()
            n = np.array([len(x) for x in data], np.int64) // size
            pieces = -(-n // window)
            row = np.repeat(np.arange(len(data)), pieces)
            k = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            index = first[row] + k
            slot = feistel(index, total, key)
            length = np.minimum(window, n[row] - k * window)
            order = np.argsort(slot, kind="stable")
            shard = slot[order] // per_shard
            cuts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1])))
            blocks = []
            for a, b in zip(cuts, [*cuts[1:], len(order)]):
                part = order[a:b]
                raw = b"".join([data[i][s * stride:(s + 1) * stride] for i, s in zip(row[part].tolist(), k[part].tolist())])
                blocks.append(squeeze.compress(pickle.dumps((slot[part], [ids[i] for i in row[part].tolist()], k[part].astype(np.int32),
                                                             length[part].astype(np.int32), raw), protocol=4)))
            return {"shard": pa.array(shard[cuts], pa.int32()), "block": pa.array(blocks, pa.binary())}
        return step

    schema = pa.schema([("id", _arrow_type(id_type)), ("start", pa.int64()), ("length", pa.int64()), ("index", pa.int64()), ("slot", pa.int64()),
                        ("shard", pa.int32()), ("byte_offset", pa.int64()), ("ids_crc32", pa.int64()), ("file", pa.string())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        grow = zstandard.ZstdDecompressor()
        held: dict[int, list[bytes]] = {}
        for b in batches:
            for s, block in zip(b.column("shard").to_pylist(), b.column("block").to_pylist()):
                held.setdefault(s, []).append(block)
        for s in sorted(held):
            parts = [pickle.loads(grow.decompress(x)) for x in held.pop(s)]
            slot, k, length = (np.concatenate([p[i] for p in parts]).astype(np.int64) for i in (0, 2, 3))
            order = np.argsort(slot)
            flat = np.frombuffer(b"".join([p[4] for p in parts]), dtype)
            inside = np.arange(window) < length[:, None]
            record = np.full((len(slot), window), pad_id, dtype)
            record[inside] = flat
            record = record[order]
            name = f"shard-{s:06d}.bin"
            put(out, name, record.tobytes())
            ids = [x for p in parts for x in p[1]]
            slot, length = slot[order], length[order]
            yield pa.RecordBatch.from_pydict({
                "id": [ids[i] for i in order.tolist()], "start": k[order] * window, "length": length,
                "index": feistel(slot, total, key, inverse=True), "slot": slot, "shard": np.full(len(slot), s, np.int32),
                "byte_offset": np.arange(len(slot)) * stride,
                "ids_crc32": np.array([zlib.crc32(r[:n]) for r, n in zip(record, length.tolist())], np.int64), "file": [name] * len(slot)}, schema=schema)

    blocks = arrow_map(docs.join(firsts, "row").select("id", "first", "ids"), make_blocks, "shard int, block binary", rows=1 << 20)
    rows = blocks.repartitionById(shards, "shard").mapInArrow(write, f"id {id_type}, start bigint, length bigint, index bigint, slot bigint, shard int, "
                                                              "byte_offset bigint, ids_crc32 bigint, file string")
    return rows.withColumn("folder", F.lit(out)).withColumnRenamed("id", id_col)


def _arrow_type(name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string
    return to_arrow_type(_parse_datatype_string(name))


def put(folder: str, name: str, data: bytes) -> None:
    """Write a file under another name, then move it to its own."""
    system, path = _file_system(folder)
    system.create_dir(path, recursive=True)
    draft = f"{path}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as f:
        f.write(data)
    system.move(draft, f"{path}/{name}")


def read_slots(folder: str, first_slot: int, count: int, window: int, per_shard: int, dtype: str = "<u2") -> Iterator[np.ndarray]:
    """Records ``first_slot .. first_slot + count - 1`` in training order, one array each, padding included: a
    reader that stops at any slot goes on from there."""
    system, path = _file_system(folder)
    stride, slot = window * np.dtype(dtype).itemsize, first_slot
    while slot < first_slot + count:
        shard, at = divmod(slot, per_shard)
        n = min(per_shard - at, first_slot + count - slot)
        name = f"{path}/shard-{shard:06d}.bin"
        if not system.get_file_info(name).is_file:
            return                                   # behind the last shard
        with system.open_input_file(name) as f:
            data = f.read_at(n * stride, at * stride)
        if not data:
            return
        yield from np.frombuffer(data, dtype).reshape(-1, window)
        slot += n


def per_shard(window: int, shard_bytes: int = SHARD_BYTES, dtype: str = "<u2") -> int:
    """Records of a full shard."""
    return max(1, shard_bytes // (window * np.dtype(dtype).itemsize))
