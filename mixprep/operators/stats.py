"""Aggregations for mixture statistics and length profiles.

Everything is a hash aggregation with map-side partial aggregation; percentiles
come from a (group, value) histogram, so no group's raw rows are ever sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

TOTAL = "TOTAL"


def split_counts(df: DataFrame, group_col: str = "category", split_col: str = "split",
                 total_label: str = TOTAL) -> DataFrame:
    """A1: train/eval rows per group plus a grand-total row (ROLLUP)."""
    g = F.when(F.col("_g") == 1, F.lit(total_label)).otherwise(F.col(group_col))
    return (df.rollup(group_col)
            .agg(F.count_if(F.col(split_col) == "train").alias("n_train"),
                 F.count_if(F.col(split_col) == "eval").alias("n_eval"),
                 F.grouping(group_col).alias("_g"))
            .select(g.alias(group_col), "n_train", "n_eval"))


def length_histogram(df: DataFrame, group_cols: Sequence[str], value_col: str) -> DataFrame:
    """(group, value) -> rows; the basis of exact percentiles and exceedance counts."""
    return df.groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("_cnt"))


def length_summary(df: DataFrame, group_cols: Sequence[str], value_col: str) -> DataFrame:
    """A2: count, min, max and ``sum // n`` per group."""
    v = F.col(value_col)
    return df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"), F.min(v).alias("min_len"), F.max(v).alias("max_len"),
        F.floor(F.sum(v) / F.count(F.lit(1))).cast("long").alias("avg_len"))


def rank_percentiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                     probs: Sequence[float] = (0.5, 0.9, 0.99), names: Sequence[str] | None = None,
                     hist: DataFrame | None = None) -> DataFrame:
    """A3: ``sorted(values)[int(n*p)]`` per group (zero-based; not ``percentile_disc``).

    Computed on the histogram: the smallest value whose running count exceeds
    ``floor(n*p)``. The window runs over distinct values only.
    """
    names = list(names or [f"p{int(round(p * 100))}" for p in probs])
    h = hist if hist is not None else length_histogram(df, group_cols, value_col)
    w = Window.partitionBy(*group_cols).orderBy(value_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = h.withColumn("_cum", F.sum("_cnt").over(w)).withColumn("_n", F.sum("_cnt").over(Window.partitionBy(*group_cols)))
    aggs = [F.min(F.when(F.col("_cum") > F.floor(F.col("_n") * F.lit(float(p))), F.col(value_col))).alias(nm)
            for p, nm in zip(probs, names)]
    return h.groupBy(*group_cols).agg(*aggs)


def exceedance(df: DataFrame, group_cols: Sequence[str], value_col: str,
               thresholds: Sequence[int] = (1024, 2048, 4096, 8192), hist: DataFrame | None = None) -> DataFrame:
    """A4: rows above each threshold and their integer percentage ``over*100 // n``."""
    h = hist if hist is not None else length_histogram(df, group_cols, value_col)
    t = h.withColumn("threshold", F.explode(F.array(*[F.lit(int(x)) for x in thresholds])))
    agg = t.groupBy(*group_cols, "threshold").agg(
        F.sum(F.when(F.col(value_col) > F.col("threshold"), F.col("_cnt")).otherwise(F.lit(0))).cast("long").alias("n_over"),
        F.sum("_cnt").cast("long").alias("_n"))
    return agg.select(*group_cols, "threshold", "n_over",
                      F.floor(F.col("n_over") * 100 / F.col("_n")).cast("long").alias("pct_over"))


def subtype_counts(df: DataFrame, group_cols: Sequence[str], text_col: str = "system", width: int = 30) -> DataFrame:
    """A5: rows per sub-type = first ``width`` characters of ``text_col``."""
    sub = F.substring(F.coalesce(F.col(text_col), F.lit("")), 1, width)
    return df.groupBy(*group_cols, sub.alias("subtype")).agg(F.count(F.lit(1)).alias("n"))


def top_subtypes(df: DataFrame, group_cols: Sequence[str], text_col: str = "system", k: int = 5,
                 width: int = 30) -> DataFrame:
    """A5 + R5: the ``k`` most frequent sub-types per group, ties by sub-type text."""
    from mixprep.operators.sampling import top_k_per_group
    c = subtype_counts(df, group_cols, text_col, width)
    return top_k_per_group(c, group_cols, [F.col("n").desc(), F.col("subtype")], k, out="rank")


def category_share(df: DataFrame, group_col: str = "category") -> DataFrame:
    """Rows per group and ``n*100 // total`` over all groups present."""
    c = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("share_pct", F.floor(F.col("n") * 100 / F.sum("n").over(Window.partitionBy())).cast("long"))


def funnel(df: DataFrame, group_col: str, flags: Sequence[str]) -> DataFrame:
    """Rows per group before any step and after each boolean step flag, in one pass."""
    return df.groupBy(group_col).agg(F.count(F.lit(1)).alias("n_in"),
                                     *[F.count_if(F.col(f)).alias(f"n_{f}") for f in flags])
