"""Token counts (7): batch encoding in Arrow functions that return lengths only.

Rows of an Arrow batch are dealt into batches balanced by bytes, long texts are split at blanks
(safe boundaries, see ``word_tokens``), and only three numbers per row leave the Python worker.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mixprep.llm.common import arrow_map, byte_batches, keep_columns
from mixprep.llm.word_tokens import WordTokens, safe_pieces, split_words

#: Bytes of text encoded at once, and characters after which a text is split.
BATCH_BYTES, PIECE_CHARS = 4 << 20, 1 << 20


def piece_counter(path: str):
    """``count(texts) -> list of token counts`` of whole texts, by the library of the file's kind."""
    if path.endswith(".model"):
        import sentencepiece
        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in processor.encode(texts, num_threads=1)]
    words = WordTokens.of(path, "count")

    def count(texts: list[str]) -> list[int]:
        pieces = [(i, p) for i, t in enumerate(texts) for p in safe_pieces(t, PIECE_CHARS)]
        total = np.zeros(len(texts), np.int64)
        for a, b in byte_batches([len(p) for _, p in pieces], BATCH_BYTES):
            split = [split_words(p) for _, p in pieces[a:b]]
            n = np.asarray(words.values([w for ws in split for w in ws]), np.int64)
            starts = np.cumsum([0, *(len(ws) for ws in split[:-1])])
            np.add.at(total, [i for i, _ in pieces[a:b]], np.add.reduceat(n, starts))
        return total.tolist()
    return count


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """Per row: the id column, n_bytes, n_tokens, over_limit (``n_tokens > limit``).

    A null text counts as empty (0 bytes, 0 tokens); null ids stay null; repeated rows are counted
    each; other columns of the input are not read. No rows in, no rows out. The counts are those of
    the whole text without begin, end or padding tokens. The file at ``path`` must be present on
    every executor. One pass, no shuffle.
    """
    id_type = df.schema[id_col].dataType.simpleString()

    def make():
        count = piece_counter(path)

        def step(batch: pa.RecordBatch) -> dict:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n_bytes = np.fromiter((len(t) if t.isascii() else len(t.encode()) for t in texts), np.int64, len(texts))
            n = np.zeros(len(texts), np.int64)
            for a, b in byte_batches(n_bytes.tolist(), BATCH_BYTES):
                n[a:b] = count(texts[a:b])
            return {"id": batch.column("id"), "n_bytes": n_bytes, "n_tokens": n}
        return step

    rows = keep_columns(df, {id_col: "id", text_col: "text"})
    out = arrow_map(rows, make, f"id {id_type}, n_bytes bigint, n_tokens bigint")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
