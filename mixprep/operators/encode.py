"""Chat encoding, label masking and batch padding.

The prefix text (system + user + generation prompt) is a literal prefix of the
full text and ends on a separator, so with the native tokenizer the full token list is the prefix tokens
followed by the response tokens: each part is tokenized once, and the label mask
is exact (the reference's prefix-of-ids assumption, D10, holds by construction). A sub-word tokenizer may merge
across the border; there the mask goes by character offsets in the full text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from mixprep.functions.subword import Subword, encode_texts
from mixprep.functions.text import IM_END, chat_prefix_text, default_empty
from mixprep.functions.tokenize import PAD_ID, native_tokens, token_ids
from mixprep.operators.sampling import hash_rank

IGNORE_INDEX = -100


def encode(df: DataFrame, max_len: int = 2048, system="system", prompt="prompt", response="response",
           keep=(), tokenizer: Subword | None = None, border: str = "mask") -> DataFrame:
    """E2 + E3: ``input_ids``, ``attention_mask``, ``labels`` right-truncated to ``max_len``.

    Also ``n_tokens_full`` (untruncated length, for F3), ``n_prefix`` and
    ``n_supervised`` (0 when the prefix fills the window, D10). With a ``tokenizer`` the ids are its own, the mask goes by character
    offsets, and ``n_border`` tells rows where a merge crosses the border; ``border`` says how that token counts (``subword.encode_texts``).
    """
    if tokenizer is not None:
        return _with_masks(encode_texts(df, tokenizer, chat_prefix_text(system, prompt), F.concat(default_empty(response), F.lit(f"{IM_END}\n")),
                                        int(max_len), keep, border), [*keep], ["n_border"])
    p_tok = native_tokens(chat_prefix_text(system, prompt))
    r_tok = native_tokens(F.concat(default_empty(response), F.lit(f"{IM_END}\n")))
    t = df.select(*keep, p_tok.alias("_pt"), r_tok.alias("_rt"))
    t = t.select(*keep, F.size("_pt").alias("n_prefix"), (F.size("_pt") + F.size("_rt")).alias("n_tokens_full"),
                 token_ids(F.slice(F.concat("_pt", "_rt"), 1, int(max_len))).alias("input_ids"))
    return _with_masks(t, [*keep])


def _with_masks(t: DataFrame, keep: list[str], more: list[str] = []) -> DataFrame:
    n = F.size("input_ids")
    return t.select(
        *keep, "input_ids",
        F.array_repeat(F.lit(1), n).alias("attention_mask"),
        F.transform("input_ids", lambda x, i: F.when(i < F.col("n_prefix"), F.lit(IGNORE_INDEX)).otherwise(x)).alias("labels"),
        "n_tokens_full", F.least(F.col("n_prefix"), n).alias("n_prefix"),
        F.greatest(n - F.col("n_prefix"), F.lit(0)).alias("n_supervised"), *more)


def pad_batches(df: DataFrame, batch_size: int, id_col: str, max_len: int | None = None, pad_id: int = PAD_ID,
                seed=42) -> DataFrame:
    """Rows in seeded order, cut into batches of ``batch_size``, right-padded to the
    batch's longest row (capped at ``max_len``): ids with ``pad_id``, mask 0, labels -100.

    The batch window partitions by ``batch_id``: groups of ``batch_size`` rows. Only ids and the length of the
    unsupervised part cross the shuffles; mask and labels are made behind them. Labels must be -100 over a prefix and the
    ids behind it, as ``encode`` makes them.
    """
    other = [c for c in df.columns if c not in ("input_ids", "attention_mask", "labels")]
    ignored = F.size(F.filter("labels", lambda x: x == IGNORE_INDEX)).alias("_ignored")
    r = hash_rank(df.select(*other, "input_ids", ignored), [], id_col, seed=seed, out="_rank")
    r = r.withColumn("batch_id", F.floor((F.col("_rank") - 1) / F.lit(int(batch_size))).cast("long"))
    width = F.max(F.size("input_ids")).over(Window.partitionBy("batch_id"))
    if max_len is not None:
        width = F.least(width, F.lit(int(max_len)))
    r = r.withColumn("width", width.cast("int")).withColumn("_ids", F.slice("input_ids", 1, F.col("width")))
    pad = F.col("width") - F.size("_ids")
    labels = F.transform("_ids", lambda x, i: F.when(i < F.col("_ignored"), F.lit(IGNORE_INDEX)).otherwise(x))
    return r.select(
        *other, "batch_id", (F.col("_rank") - 1 - F.col("batch_id") * F.lit(int(batch_size))).cast("int").alias("row_in_batch"),
        "width",
        F.concat("_ids", F.array_repeat(F.lit(int(pad_id)), pad)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), F.size("_ids")), F.array_repeat(F.lit(0), pad)).alias("attention_mask"),
        F.concat(labels, F.array_repeat(F.lit(IGNORE_INDEX), pad)).alias("labels"))
