"""Length report per category (A2-A6 over E1), from one histogram."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from mixprep.functions.subword import Subword, token_counts
from mixprep.functions.tokenize import token_count
from mixprep.operators import stats
from mixprep.operators.sampling import top_k_per_group

THRESHOLDS = (1024, 2048, 4096, 8192)


def with_token_len(df: DataFrame, tokenizer: Subword | None = None) -> DataFrame:
    """E1 on ``system + prompt + response`` (no special tokens), by the native tokenizer or the one given."""
    if tokenizer is not None:
        return token_counts(df, tokenizer)
    text = F.concat(*[F.coalesce(F.col(c), F.lit("")) for c in ("system", "prompt", "response")])
    return df.withColumn("n_tokens", token_count(text))


def length_report(df: DataFrame, category_col: str = "category", thresholds: Sequence[int] = THRESHOLDS,
                  tokenizer: Subword | None = None) -> DataFrame:
    """One row per category: n, share, min/max/avg, P50/P90/P99, rows over each threshold.

    All statistics come from one aggregation of the (category, length) histogram with its running counts; the
    window runs over distinct lengths only.
    """
    if tokenizer is not None:       # of the rows, only category and count leave the tokenizer's tasks
        t = token_counts(df, tokenizer, keep=[category_col])
    else:
        t = with_token_len(df)
    hist = stats.length_histogram(t, [category_col], "n_tokens")
    by = Window.partitionBy(category_col)
    v, c = F.col("n_tokens"), F.col("_cnt")
    hist = hist.withColumn("_cum", F.sum(c).over(by.orderBy(v).rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("_n", F.sum(c).over(by))
    out = hist.groupBy(category_col).agg(
        F.sum(c).cast("long").alias("n"), F.min(v).alias("min_len"), F.max(v).alias("max_len"),
        F.floor(F.sum(v * c) / F.sum(c)).cast("long").alias("avg_len"),
        *[F.sum(F.when(v > F.lit(int(x)), c).otherwise(F.lit(0))).cast("long").alias(f"over_{x}") for x in thresholds],
        *[F.min(F.when(F.col("_cum") > F.floor(F.col("_n") * F.lit(p)), v)).alias(f"p{int(round(p * 100))}") for p in (0.5, 0.9, 0.99)])
    out = out.withColumn("share_pct", F.floor(F.col("n") * 100 / F.sum("n").over(Window.partitionBy())).cast("long"))
    for x in thresholds:
        out = out.withColumn(f"over_{x}_pct", F.floor(F.col(f"over_{x}") * 100 / F.col("n")).cast("long"))
    return out


def subtypes(df: DataFrame, category_col: str = "category", k: int = 5) -> DataFrame:
    """The report's sub-types: the ``k`` most frequent beginnings of the system text per category, with their share."""
    total = Window.partitionBy(category_col)
    counts = stats.subtype_counts(df, [category_col]).withColumn("_n", F.sum("n").over(total))
    top = top_k_per_group(counts, [category_col], [F.col("n").desc(), F.col("subtype")], k)
    return top.select(category_col, "rank", "subtype", "n", F.floor(F.col("n") * 100 / F.col("_n")).cast("long").alias("pct"))
