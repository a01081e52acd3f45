"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mixprep.functions.text import char_len


def sample_len(system="system", prompt="prompt", response="response") -> Column:
    return char_len(system, prompt, response)


def filter_max_len(df: DataFrame, max_char: int, length: Column | None = None) -> DataFrame:
    """keep ``char_len <= max_char`` (inclusive)."""
    return df.filter((length if length is not None else sample_len()) <= F.lit(int(max_char)))


def filter_band(df: DataFrame, min_char: int, max_char: int, length: Column | None = None) -> DataFrame:
    """keep ``min_char < char_len <= max_char``."""
    n = length if length is not None else sample_len()
    return df.filter((n > F.lit(int(min_char))) & (n <= F.lit(int(max_char))))


def filter_min_tokens(df: DataFrame, ids_col: str = "input_ids", min_exclusive: int = 10) -> DataFrame:
    """keep rows with more than ``min_exclusive`` tokens."""
    return df.filter(F.size(ids_col) > F.lit(int(min_exclusive)))


def long_policy(df: DataFrame, max_len: int, policy: str = "truncate", n_col: str = "n_tokens_full") -> DataFrame:
    """``drop`` removes rows whose *untruncated* length exceeds ``max_len``;
    ``truncate`` keeps them (already right-truncated by the encoder)."""
    if policy == "drop":
        return df.filter(F.col(n_col) <= F.lit(int(max_len)))
    if policy == "truncate":
        return df
    raise ValueError(f"unknown policy {policy!r}")


def filter_min_count(df: DataFrame, n_col: str, k: int) -> DataFrame:
    """keep rows (users) with at least ``k`` resolved items."""
    return df.filter(F.col(n_col) >= F.lit(int(k)))
