"""Training-set preparation: resample train by weight, render, encode, mask, filter.

Eval rows are never resampled. Encoding is row-wise; resampling is one equi-join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from mixprep.functions.subword import Subword
from mixprep.functions.text import IM_END, chat_prefix_text, default_empty, weight_by_content
from mixprep.functions.tokenize import token_count
from mixprep.operators.encode import encode
from mixprep.operators.filters import long_policy
from mixprep.operators.sampling import class_weights, weighted_draws
from mixprep.session import stage


def weights_column(weights: Sequence[tuple[str, float]], mode: str = "by_column", category_col: str = "category",
                   scope: str = "joined"):
    """``by_column`` looks the category column up; ``by_content`` is N12."""
    if mode == "by_column":
        return class_weights(list(weights), category_col)
    if mode == "by_content":
        return weight_by_content(list(weights), scope=scope)
    raise ValueError(f"unknown mode {mode!r}")


def _long_enough(df: DataFrame, max_len: int, policy: str, min_exclusive: int = 10) -> DataFrame:
    """F3 and F4 before encoding, from counted matches: a filter on the encoded arrays would be pushed below shuffles and
    joins and make the arrays a second time there."""
    n = token_count(chat_prefix_text("system", "prompt")) + token_count(F.concat(default_empty("response"), F.lit(f"{IM_END}\n")))
    n = F.least(n, F.lit(int(max_len))) if policy == "truncate" else n
    df = df.withColumn("_n", n)
    return long_policy(df, max_len, policy, "_n").filter(F.least("_n", F.lit(int(max_len))) > F.lit(min_exclusive)).drop("_n")


def prepare_train(df: DataFrame, id_col: str, weights: Sequence[tuple[str, float]] | None = None,
                  mode: str = "by_column", max_len: int = 2048, policy: str = "truncate", seed=42,
                  keep=(), tokenizer: Subword | None = None) -> DataFrame:
    """Draws are made from ids and weights alone; a row that is drawn is rendered and tokenized once, and only
    then multiplied by its draws (all by joins on the id, so its text crosses one shuffle). Ids must be unique.
    With a ``tokenizer`` (``encode``) the length rules go by its tokens, counted while they are made."""
    if not weights:
        return prepare_eval(df, id_col, max_len, policy, keep, tokenizer)
    thin = stage(df.select(id_col, weights_column(weights, mode).alias("_w")), "weights")
    draws = stage(weighted_draws(thin, "_w", id_col, seed=seed, max_classes=len(weights) + 1), "draws")
    picked = draws.select(F.col("_mp_pick_id").alias("_pick")).distinct()
    # Dealt by id first: the joins on the id keep that, and tokenizing runs as wide as the shuffle, however few files there are.
    rows = df if tokenizer else _long_enough(df, max_len, policy)
    rows = rows.repartition(F.col(id_col)).join(picked, F.col(id_col) == F.col("_pick"), "left_semi")
    enc = _encoded(rows, max_len, policy, [id_col, *keep], tokenizer)
    return draws.join(enc, F.col("_mp_pick_id") == F.col(id_col)).drop("_mp_pick_id")


def prepare_eval(df: DataFrame, id_col: str, max_len: int = 2048, policy: str = "truncate", keep=(), tokenizer: Subword | None = None) -> DataFrame:
    df = df if tokenizer else _long_enough(df, max_len, policy)
    return _encoded(df.withColumn("draw_id", F.col(id_col)), max_len, policy, ["draw_id", id_col, *keep], tokenizer)


def _encoded(df: DataFrame, max_len: int, policy: str, keep: list[str], tokenizer: Subword | None, min_exclusive: int = 10) -> DataFrame:
    """Encoded rows; those of a ``tokenizer`` are filtered here (F3, F4), by the counts that come with the ids."""
    enc = encode(df, max_len=max_len, keep=keep, tokenizer=tokenizer)
    if tokenizer is None:
        return enc
    return long_policy(enc, max_len, policy, "n_tokens_full").filter(F.size("input_ids") > F.lit(min_exclusive))
