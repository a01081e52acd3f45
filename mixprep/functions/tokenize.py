"""Tokenization (E1): a native JVM tokenizer and a pluggable Arrow-batched one.

(a) ``native_tokens``: ``regexp_extract_all`` with one pattern; chat markers, item
    tokens, thinking tags and CJK characters are single tokens. Ids come from a
    stable hash into a fixed vocabulary size (special tokens have fixed ids). It
    runs inside the JVM and an independent SQL engine computes the same lists.
(b) ``python_token_ids``: a ``pandas_udf`` that builds a user-supplied tokenizer
    once per Python worker (e.g. a real sub-word tokenizer loaded from a file)
    and encodes whole Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, functions as F

# Whitespace class (Python's str.isspace set), token pattern, special ids.
_WS = (r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
       r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
TOKEN_PATTERN = (r"<\|[a-z_]+\|>|<s_[abc]_[0-9]+>|</?think>|[\x{4e00}-\x{9fff}]|[\p{L}\p{N}_]+"
                 r"|[^" + _WS + r"\p{L}\p{N}_]")
SPECIAL_IDS = {"<|endoftext|>": 0, "<|im_start|>": 1, "<|im_end|>": 2}
VOCAB_SIZE = 151_643
PAD_ID = SPECIAL_IDS["<|endoftext|>"]   # pad falls back to the end-of-text id


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def native_tokens(text) -> Column:
    """E1(a): token strings of ``text`` (array<string>)."""
    return F.regexp_extract_all(F.coalesce(_c(text), F.lit("")), F.lit(TOKEN_PATTERN), 0)


def token_id(t: Column, vocab_size: int = VOCAB_SIZE) -> Column:
    n_special = len(SPECIAL_IDS)
    h = F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("bigint")
    expr = None
    for tok, i in SPECIAL_IDS.items():
        expr = F.when(t == F.lit(tok), F.lit(i)) if expr is None else expr.when(t == F.lit(tok), F.lit(i))
    return expr.otherwise((F.lit(n_special) + h % F.lit(vocab_size - n_special)).cast("int"))


def token_ids(tokens, vocab_size: int = VOCAB_SIZE) -> Column:
    """Ids of a token array (array<int>)."""
    return F.transform(_c(tokens), lambda t: token_id(t, vocab_size))


def token_count(text) -> Column:
    """Number of native tokens (no special tokens added); counts matches without building the list."""
    return F.regexp_count(F.coalesce(_c(text), F.lit("")), F.lit(TOKEN_PATTERN))


def python_token_ids(text, factory: Callable[[], Callable[[str], list[int]]]) -> Column:
    """E1(b): ids from a user tokenizer, built once per Python worker, Arrow-batched.

    ``factory()`` returns ``encode(text) -> list[int]``; it must be picklable
    (e.g. a top-level function that loads a tokenizer file).
    """
    state: dict = {}

    @F.pandas_udf("array<int>")
    def _encode(s: pd.Series) -> pd.Series:
        enc = state.get("enc")
        if enc is None:
            enc = state["enc"] = factory()
        return s.map(lambda x: list(enc(x if x is not None else "")))

    return _encode(_c(text))
