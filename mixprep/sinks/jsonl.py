"""JSONL and statistics sinks (K1-K4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SFT_COLS = ("system", "prompt", "response")


def write_jsonl(df: DataFrame, path: str, array_per_line: bool = False, partition_by: str | None = None,
                mode: str = "overwrite", cols=SFT_COLS) -> None:
    """K1 (object per line) / K2 (one-element array per line) / K4 (``partition_by='split'``).

    NULL fields are written as ``null`` (``ignoreNullFields=false``); text stays raw UTF-8.
    """
    extra = [partition_by] if partition_by else []
    if array_per_line:
        line = F.to_json(F.array(F.struct(*cols)), {"ignoreNullFields": "false"}).alias("value")
        w = df.select(line, *extra).write.mode(mode)
        if partition_by:
            w = w.partitionBy(partition_by)
        w.text(path)
    else:
        w = df.select(*cols, *extra).write.mode(mode).option("ignoreNullFields", "false")
        if partition_by:
            w = w.partitionBy(partition_by)
        w.json(path)


def write_jsonl_named(spark: SparkSession, df: DataFrame, root: str, name_col: str,
                      array_per_line: bool = False, cols=SFT_COLS) -> list[str]:
    """Land rows as ``{root}/{name}_{i:05d}.jsonl`` files, one name per value of ``name_col``
    (the layout the directory scan and file-name categories expect), published by one rename (``published``)."""
    from mixprep.sinks.published import publish_jsonl
    return publish_jsonl(spark, df, root, name_col, cols, layout="flat", array_per_line=array_per_line)


def stats_row(mixed: DataFrame, max_char: int, world_sample_size: int, eval_ratio: float,
              category_col: str = "category", split_col: str = "split") -> DataFrame:
    """K3: one row: total_train, total_eval, categories (JSON text, keys sorted), parameters."""
    per = mixed.groupBy(category_col).agg(F.count_if(F.col(split_col) == "train").alias("train"),
                                          F.count_if(F.col(split_col) == "eval").alias("eval"))
    cats = F.to_json(F.map_from_entries(F.array_sort(F.collect_list(
        F.struct(F.col(category_col), F.struct("train", "eval"))))))
    return per.agg(F.sum("train").cast("long").alias("total_train"), F.sum("eval").cast("long").alias("total_eval"),
                   cats.alias("categories")).select(
        "total_train", "total_eval", "categories", F.lit(int(max_char)).cast("long").alias("max_char"),
        F.lit(int(world_sample_size)).cast("long").alias("world_sample_size"),
        F.lit(float(eval_ratio)).alias("eval_ratio"))


def write_stats(stats: DataFrame, path: str) -> None:
    stats.coalesce(1).write.mode("overwrite").json(path)


def land_parquet(df: DataFrame, path: str, partition_col: str = "category", mode: str = "overwrite") -> None:
    """Land parsed samples once as parquet partitioned by ``partition_col``.

    Later jobs then get partition pruning on the category, column pruning and
    statistics, none of which JSON offers.
    """
    df.write.mode(mode).partitionBy(partition_col).parquet(path)
