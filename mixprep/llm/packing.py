"""Packing (4): best-fit decreasing into windows of a fixed number of tokens.

A document's ids are cut into full windows, which stand alone, and one remainder. Remainders are
placed, longest first, into the tightest open window of their block: a segment tree indexed by
remaining capacity finds it. Blocks are equal hash ranges of about ``block_rows`` documents, so no
task ever holds more than a block and a document's place does not depend on partitioning. The hash is of id, length and checksum;
rows that are equal in all three are numbered, so a third of all rows with one id and text are many blocks. Which of them gets which
number changes no result. A block wastes about one window in its several thousand.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mixprep.llm.common import arrow_map, byte_batches, keep_columns, stage
from mixprep.llm.word_tokens import WordTokens, split_words
from mixprep.operators.sampling import number_copies

#: Bytes of text encoded at once.
BATCH_BYTES = 4 << 20


class OpenWindows:
    """Open windows by remaining capacity; a segment tree over capacities counts them."""

    def __init__(self, capacity: int):
        self.half = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.half)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, capacity: int, by: int) -> None:
        node = capacity + self.half
        while node:
            self.count[node] += by
            node >>= 1

    def open(self, capacity: int, window: int) -> None:
        if capacity:
            self.windows[capacity].append(window)
            self._add(capacity, 1)

    def tightest(self, least: int) -> tuple[int, int] | None:
        """(capacity, window) of the fullest window that still has ``least`` free; it is taken out."""
        node, count = least + self.half, self.count
        while not count[node]:
            while node & 1:          # a right child: what lies further right hangs on a parent
                node >>= 1
            if not node:
                return None
            node += 1                # the neighbour to the right
        while node < self.half:
            node = 2 * node if count[2 * node] else 2 * node + 1
        capacity = node - self.half
        self._add(capacity, -1)
        return capacity, self.windows[capacity].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """(window, offset) of each piece; ``lengths`` are 1..capacity. Equal lengths go in order."""
    window, offset = [0] * len(lengths), [0] * len(lengths)
    free, made = OpenWindows(capacity), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        found = free.tightest(n)
        if found is None:
            found, made = (capacity, made), made + 1
        window[i], offset[i] = found[1], capacity - found[0]
        free.open(found[0] - n, found[1])
    return window, offset


def encode_windows(df: DataFrame, path: str, window: int, end_id: int, payload: str) -> DataFrame:
    """Per document: id, n (ids with the end id), crc (of all its ids) and ``parts``, a value per window: the crc32 of its ids
    (``payload='crc32'``) or the ids as little-endian unsigned 32-bit bytes (``'ids'``)."""
    id_type = df.schema["id"].dataType.simpleString()

    def make():
        words, end, size = WordTokens.of(path, "ids"), np.asarray([end_id], "<u4").tobytes(), 4 * window
        value = zlib.crc32 if payload == "crc32" else bytes

        def step(batch: pa.RecordBatch) -> dict:
            texts = batch.column("text").to_pylist()
            n, crc, parts = [], [], []
            for a, b in byte_batches([len(t or "") for t in texts], BATCH_BYTES):
                split = [split_words(t or "") for t in texts[a:b]]
                got, at = words.values([w for ws in split for w in ws]), 0
                for ws in split:
                    ids = b"".join(got[at:at + len(ws)]) + end
                    at += len(ws)
                    n.append(len(ids) // 4)
                    crc.append(zlib.crc32(ids))
                    parts.append([value(ids[k:k + size]) for k in range(0, len(ids), size)])
            kind = pa.list_(pa.int64() if payload == "crc32" else pa.binary())
            return {"id": batch.column("id"), "n": pa.array(n, pa.int64()), "crc": pa.array(crc, pa.int64()), "parts": pa.array(parts, kind)}
        return step

    return arrow_map(df, make, f"id {id_type}, n bigint, crc bigint, parts array<{'bigint' if payload == 'crc32' else 'binary'}>")


def pack(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = 2048, end_id: int = 1,
         payload: str = "ids", block_rows: int = 8192) -> DataFrame:
    """One row per piece: id column, start, length, the payload (``ids`` binary or ``ids_crc32``),
    doc_tokens, sequence_id, offset, sequence_length, padded_length.

    Every id of ``text``'s encoding, and ``end_id`` behind it, is in exactly one piece. Pieces of a
    sequence have gapless offsets from 0. A sequence is to be padded to ``window``, except where its
    length is a power of two: then it stays (``padded_length`` says so). A null or empty text is the end
    id alone; a null id is a document like any other; repeated rows are packed each. No rows in, no rows
    out. Other columns are not read. ``sequence_id`` is unique, not dense: block number and
    number in the block. The encoded windows are staged once in the shared folder, without texts.
    """
    spark = df.sparkSession
    docs = stage(encode_windows(keep_columns(df, {id_col: "id", text_col: "text"}), path, window, end_id, payload), "pack")
    blocks = max(1, -(-docs.count() // block_rows))
    id_type, value = docs.schema["id"].dataType.simpleString(), "bigint" if payload == "crc32" else "binary"
    name = "ids_crc32" if payload == "crc32" else "ids"

    def place(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["id", "n", "crc"], kind="stable", na_position="first")
        n = rows["n"].to_numpy()
        full, rest = n // window, n % window
        some = np.flatnonzero(rest)
        of, offset = best_fit_decreasing(rest[some].tolist(), window)
        pieces = full + (rest > 0)
        row = np.repeat(np.arange(len(rows)), pieces)
        k = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        length, begin = np.full(len(row), window), np.zeros(len(row), np.int64)
        sequence, total = np.full(len(row), -1), np.full(len(row), window)
        last = (np.cumsum(pieces) - 1)[some]
        length[last], begin[last], sequence[last] = rest[some], offset, of
        total[last] = np.bincount(of, weights=rest[some]).astype(np.int64)[of] if len(some) else 0
        alone = sequence < 0
        sequence[alone] = (max(of) + 1 if len(of) else 0) + np.arange(alone.sum())
        total = total.astype(np.int64)
        return pd.DataFrame({
            "id": rows["id"].to_numpy()[row], "start": k * window, "length": length,
            name: [parts[i] for parts, m in zip(rows["parts"], pieces) for i in range(m)],
            "doc_tokens": n[row], "sequence_id": sequence + (int(key[0]) << 32), "offset": begin, "sequence_length": total,
            "padded_length": np.where(total & (total - 1) == 0, total, window)})

    key = F.concat_ws("/", F.col("n").cast("string"), F.col("crc").cast("string"), F.concat(F.lit("="), F.col("id").cast("string")))
    docs, unique = docs.withColumn("key", key), "key"
    if not docs.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").isEmpty():
        docs = docs.withColumn("at", F.concat_ws("#", "_metadata.file_name", F.col("_metadata.row_index").cast("string")))
        docs, unique = number_copies(docs, "key", "at", "numbered"), "numbered"
    out = (docs.select("id", "n", "crc", "parts", F.pmod(F.xxhash64(unique), F.lit(blocks)).alias("block"))
           .groupBy("block").applyInPandas(place, f"id {id_type}, start bigint, length bigint, {name} {value}, doc_tokens bigint, "
                                           "sequence_id bigint, offset bigint, sequence_length bigint, padded_length bigint"))
    return out.withColumnRenamed("id", id_col)
