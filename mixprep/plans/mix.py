"""Mixture recipes (W1 mix v2, W2 mix v3): normalise, filter, sample, split, union.

One lazy plan per recipe. Every source is normalised to the SFT schema, filtered
by length, optionally sampled; all sources are split train/eval in ONE
``split_eval`` over their union (grouped by category or by source), so the
bucket counts of every group come from a single aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from mixprep.functions.text import alias_merge, char_len
from mixprep.operators.normalize import alpaca_to_sft, to_sft
from mixprep.operators.sampling import sample_n, split_eval

OUT_COLS = ["source", "category", "sample_key", "system", "prompt", "response"]


@dataclass
class Source:
    name: str                       # e.g. "rec", "item_ext", "world_ext"
    df: DataFrame                   # rows with an id column
    id_col: str
    fmt: str = "auto"               # "sft" | "alpaca" | "auto" (schema-aware, D5)
    category: str | None = None     # default: name with "_ext" removed (N15)
    min_char: int | None = None     # exclusive lower bound (F2)
    max_char: int | None = None     # inclusive upper bound (F1)
    sample: int | None = None       # R2 sample size
    name_col: str | None = None     # several sources in one frame: the column that names them (``name`` is then unused)
    names: tuple[str, ...] = ()     # and their names


@dataclass
class Recipe:
    sources: list[Source] = field(default_factory=list)
    split_by: str = "category"      # "category" (v2) or "source" (v3)
    eval_ratio: float = 0.05
    min_eval: int = 1
    seed: int | str = 42
    drop_empty: bool = True         # reject rows with neither prompt nor response (D5)
    stage: bool = True              # write the prepared union once to the shared checkpoint folder


def prepare_source(src: Source, seed) -> DataFrame:
    name = F.col(src.name_col) if src.name_col else F.lit(src.name)
    key = F.concat(name, F.lit(":"), F.col(src.id_col).cast("string")).alias("sample_key")
    name = name.alias("source")
    if src.fmt == "alpaca":
        df = alpaca_to_sft(src.df, keep=[key, name]).withColumn("is_empty", F.lit(False))
    elif src.fmt == "sft":
        df = src.df.select(key, name, "system", "prompt", "response").withColumn("is_empty", F.lit(False))
        df = df.fillna("", ["system", "prompt", "response"])
    else:
        df = to_sft(src.df, keep=[key, name])
    df = df.withColumn("category", F.lit(src.category) if src.category else alias_merge(F.col("source")))
    n = char_len("system", "prompt", "response")
    if src.min_char is not None:
        df = df.filter(n > F.lit(int(src.min_char)))
    if src.max_char is not None:
        df = df.filter(n <= F.lit(int(src.max_char)))
    if src.sample is not None:
        df = sample_n(df, src.sample, "sample_key", seed=f"{seed}:sample")
    return df


def funnel(recipe: Recipe, mixed: DataFrame) -> DataFrame:
    """A7 of a recipe: per source the raw rows, those kept by filters and sampling, and the train and eval rows of ``mixed``.

    The raw rows are counted from the inputs alone: no column is read but a name column.
    """
    raw = None
    for s in recipe.sources:
        one = s.df.select((F.col(s.name_col) if s.name_col else F.lit(s.name)).alias("source"))
        one = one.groupBy("source").agg(F.count(F.lit(1)).alias("n_raw"))
        raw = one if raw is None else raw.unionByName(one)
    after = mixed.groupBy("source").agg(F.count(F.lit(1)).alias("n_kept"), F.count_if(F.col("split") == "train").alias("n_train"),
                                        F.count_if(F.col("split") == "eval").alias("n_eval"))
    zero = {c: 0 for c in ("n_kept", "n_train", "n_eval")}
    return raw.join(after, "source", "left").fillna(zero)


def run_recipe(recipe: Recipe, observation=None) -> DataFrame:
    """Union of all prepared sources with a ``split`` column ('train' / 'eval').

    ``observation`` (a ``pyspark.sql.Observation``) receives, per source, the rows
    that passed normalisation, filters and sampling (A7), collected during the
    same job that stages the union, without an extra pass.
    """
    names = [n for s in recipe.sources for n in (s.names or (s.name,))]
    parts = [prepare_source(s, recipe.seed) for s in recipe.sources]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    if recipe.drop_empty:
        u = u.filter(~F.col("is_empty"))
    if observation is not None:
        u = u.observe(observation, *[F.count_if(F.col("source") == n).alias(n) for n in names])
    u = u.select(*OUT_COLS)
    if recipe.stage:
        # The split reads its input three times (counts, boundary threshold, labels).
        # A parquet table in the shared checkpoint folder computes the sources once,
        # cuts the lineage (a lost executor re-reads files, not generators), and the
        # two key-only passes read two columns of it.
        from mixprep.session import stage
        u = stage(u, "mix-stage")
    group = "category" if recipe.split_by == "category" else "source"
    return split_eval(u, [group], "sample_key", ratio=recipe.eval_ratio, min_eval=recipe.min_eval, seed=recipe.seed)
