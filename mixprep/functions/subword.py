"""A real sub-word tokenizer in Arrow batches (E1(b)): ids, counts and the place of a border in the text.

``Subword`` names a ``tokenizers`` file and the chat markers that are single tokens of it. Tasks load it once per worker and encode
whole batches, cut by bytes; only what a caller asks for leaves a task. Markers that the file does not know get the ids behind its vocabulary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mixprep.functions.text import IM_END, IM_START, default_empty
from mixprep.session import ship_code

#: Characters encoded at once; a longer text is a batch of its own.
BATCH_CHARS = 1 << 20
#: How tokens that hold characters of both sides of a border count (``encode_texts``).
BORDERS = ("mask", "learn", "prefix")


@dataclass(frozen=True)
class Subword:
    """``path`` of a ``tokenizers`` JSON file and the strings that are single tokens wherever they occur."""

    path: str
    markers: tuple[str, ...] = (IM_START, IM_END)

    def load(self):
        if self not in _LOADED:
            import os
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")      # tasks are the parallelism
            from tokenizers import Tokenizer
            t = Tokenizer.from_file(self.path)
            t.no_padding()
            t.no_truncation()
            t.add_special_tokens(list(self.markers))
            _LOADED[self] = t
        return _LOADED[self]

    def pad_id(self, token: str = "<|endoftext|>") -> int:
        """The id batches are padded with: the end-of-text token's, else 0."""
        return self.load().token_to_id(token) or 0


_LOADED: dict[Subword, object] = {}


def _batches(sizes: list[int]) -> Iterator[tuple[int, int]]:
    a = held = 0
    for i, n in enumerate(sizes):
        if i > a and held + n > BATCH_CHARS:
            yield a, i
            a, held = i, 0
        held += n
    if a < len(sizes):
        yield a, len(sizes)


def _map_texts(df: DataFrame, keep: list[str], texts: dict, fields: str, make: Callable[[], Callable[..., dict]]) -> DataFrame:
    """``df``'s columns ``keep`` and those that the batch function makes of the text columns, row by row."""
    ship_code(df.sparkSession)
    names = [f"_t{i}" for i in range(len(texts))]
    kept = [f"_k{i}" for i in range(len(keep))]
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(keep, kept)], *[c.alias(n) for c, n in zip(texts.values(), names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for b in batches:
            columns = [b.column(n).to_pylist() for n in names]
            for a, z in _batches([sum(map(len, t)) for t in zip(*columns)]):
                made = step(*[c[a:z] for c in columns])
                part = b.slice(a, z - a)
                yield pa.RecordBatch.from_arrays([part.column(k) for k in kept] + list(made.values()), names=kept + list(made))
    types = [f"{k} {rows.schema[k].dataType.simpleString()}" for k in kept]
    out = rows.mapInArrow(run, ", ".join([*types, fields]))
    return out.select(*[F.col(k).alias(c) for c, k in zip(keep, kept)], *[f.split()[0] for f in fields.split(", ")])


def token_counts(df: DataFrame, tokenizer: Subword, cols=("system", "prompt", "response"), out: str = "n_tokens", keep=None) -> DataFrame:
    """``df`` (or its columns ``keep``) with the number of tokens of the concatenated text columns, nulls as empty, no special tokens added."""
    keep = [c for c in df.columns if c != out] if keep is None else list(keep)

    def make():
        t = tokenizer.load()
        return lambda texts: {"_n": pa.array([len(e.ids) for e in t.encode_batch_fast(texts, add_special_tokens=False)], pa.int64())}
    return _map_texts(df, keep, {"text": F.concat(*[default_empty(c) for c in cols])}, "_n bigint", make).withColumnRenamed("_n", out)


def encode_texts(df: DataFrame, tokenizer: Subword, prefix, rest, max_len: int, keep=(), border: str = "mask") -> DataFrame:
    """Ids of ``prefix + rest`` as one text, and where the prefix ends in them.

    Returns ``keep``, input_ids (the first ``max_len``), n_tokens_full (of the whole text), n_prefix (tokens before the first learned one) and n_border: how many
    tokens hold characters of both sides, 0 or 1. With a sub-word tokenizer the ids of the prefix alone need not be the
    first ids of the whole text: a merge may cross the border. The place is therefore found by character offsets in the whole text, and a crossing token is

    * ``"mask"``: part of the prefix (it cannot be predicted from a prompt that already holds some of its characters),
    * ``"learn"``: part of the rest, so every character of the rest is learned,
    * ``"prefix"``: whatever the count of the prefix's own tokens says, as a tokenizer call per text does.
    """
    if border not in BORDERS:
        raise ValueError(f"unknown border {border!r}")

    def make():
        t = tokenizer.load()

        def step(before: list[str], after: list[str]) -> dict:
            found = t.encode_batch([a + b for a, b in zip(before, after)], add_special_tokens=False)
            alone = t.encode_batch_fast(before, add_special_tokens=False) if border == "prefix" else [None] * len(found)
            n, place, crossing, ids = [], [], [], []
            for e, a, own in zip(found, before, alone):
                k = _token_at(e, len(a))
                crosses = k < len(e.ids) and e.token_to_chars(k)[0] < len(a)
                n.append(len(e.ids))
                crossing.append(int(crosses))
                place.append(len(own.ids) if own is not None else k + (crosses and border == "mask"))
                ids.append(np.asarray(e.ids[:max_len], np.int32))
            ends = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            return {"input_ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32))),
                    "n_tokens_full": pa.array(n, pa.int32()), "n_prefix": pa.array(place, pa.int32()), "n_border": pa.array(crossing, pa.int32())}
        return step
    return _map_texts(df, list(keep), {"prefix": prefix, "rest": rest}, "input_ids array<int>, n_tokens_full int, n_prefix int, n_border int", make)


def _token_at(encoding, char: int) -> int:
    """The first token that ends behind ``char``; the number of tokens if none does. Characters that the tokenizer drops belong to no token."""
    k = encoding.char_to_token(char)
    if k is None:
        ends = np.fromiter((e for _, e in encoding.offsets), np.int64, len(encoding.ids))
        k = int(np.searchsorted(ends, char, side="right"))
    return k
