"""Keyed map sources with last-wins semantics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from mixprep.sources import files


def dedupe_last_wins(df: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the values of the row that is last by ``order``.

    ``max_by`` over the order columns: partial aggregation merges a hot key map-side; there is no window. Values of
    variable length make it a sort aggregation; ``read_keyed_last`` avoids that for files.
    """
    best = F.max_by(F.struct(*values), F.struct(*order)).alias("_v")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values])


#: Rows a file may hold where its number and the row share one long.
ROWS_PER_FILE = 1 << 40


def read_keyed_last(spark: SparkSession, directory: str, keys: Sequence[str], values: Sequence[str],
                    max_files: int | None = None, key_casts: dict | None = None) -> DataFrame:
    """S7 + S8: parquet files of a map table read in name order; a duplicate key keeps
    the row of the later file / later row.

    A row's place is one long, the file's number in name order and the row in the file; the greatest place per key is a
    hash aggregation of keys and longs, and the values are fetched by a join on the place.
    """
    paths = files.first_files(spark, directory, max_files, "*.parquet")
    if not paths:
        raise FileNotFoundError(f"No .parquet files found in {directory}")
    names = [p.rsplit("/", 1)[-1] for p in paths]
    number = F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (n, i)])
    casts = key_casts or {}
    place = (number[F.col("_metadata.file_name")].cast("long") * ROWS_PER_FILE + F.col("_metadata.row_index")).alias("_place")
    df = spark.read.parquet(*paths)
    cols = [F.col(k).cast(casts[k]).alias(k) if k in casts else F.col(k) for k in keys]
    last = df.select(*cols, place).groupBy(*keys).agg(F.max("_place").alias("_place")).select("_place")
    return df.select(*cols, *values, place).join(last, "_place").select(*keys, *values)
