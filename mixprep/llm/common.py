"""Helpers shared by the operators: staged tables, held-out folds, bounded samples, Arrow maps."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mixprep.session import scratch_path, stage

#: ASCII white space of the contracts, ``[\x20\x09-\x0D]``, as a Java regex.
ASCII_SPACE = "[\\x20\\x09-\\x0D]+"

__all__ = ["ASCII_SPACE", "arrow_map", "byte_batches", "drop_rows", "filter_rows", "fold", "free_name", "keep_columns", "rate_sample", "scratch_path", "ship", "stage", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: Column | str, mod: int) -> Column:
    """``crc32(id as text) mod m``: the held-out folds of the contracts."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit(""))) % mod


def rate_sample(df: DataFrame, key: str, expected: int, total: int, seed: int = 7) -> DataFrame:
    """About ``expected`` of ``total`` rows, chosen by a hash of ``key`` (no sort, no window).

    The size is bounded in expectation by ``expected`` whatever the input; the choice depends
    on the key and seed alone, so a retry or another partitioning picks the same rows.
    """
    if total <= expected:
        return df
    cut = int(expected / total * 2**62)
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 2)
    return df.filter(h < F.lit(cut))


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once a context, so that they need not have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "mixprep_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.join(tempfile.mkdtemp(prefix="mixprep-"), "mixprep_code.zip")
    with zipfile.ZipFile(name, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.join("mixprep", os.path.relpath(path, root)))
    sc.addPyFile(name)
    sc.mixprep_shipped = True


#: Rows of an Arrow batch that become Python objects at once.
STEP_ROWS = 1_024


def arrow_map(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str, rows: int = STEP_ROWS) -> DataFrame:
    """``mapInArrow`` with a per-task set-up: ``make()`` runs once a task and gives the batch function,
    which returns columns (name -> list or array) in the order of ``schema``. It gets ``rows`` rows at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for b in batches:
            for k in range(0, b.num_rows, rows):
                yield pa.RecordBatch.from_pydict(step(b.slice(k, rows)))
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def byte_batches(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges ``[a, b)`` of about ``limit`` bytes each (a larger row is alone)."""
    a = total = 0
    for i, n in enumerate(sizes):
        if i > a and total + n > limit:
            yield a, i
            a, total = i, 0
        total += n
    if a < len(sizes):
        yield a, len(sizes)


def keep_columns(df: DataFrame, needed: dict[str, str]) -> DataFrame:
    """Only the columns an operator reads, under its own names: clashing or extra columns of
    the input can then never meet the operator's working columns."""
    return df.select(*[F.col(f"`{c}`").alias(name) for c, name in needed.items()])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with as many signs behind it as no column of ``df`` has, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Rows of keys up to which a table of dropped rows is broadcast (at most about 100 MB); beyond, a shuffled join.
BROADCAST_KEYS = 1_000_000


def drop_rows(df: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """``df`` without the rows whose ``key`` is in ``dropped`` (one column, written already). Null keys stay."""
    name = free_name(df, "dropped_key")
    dropped = dropped.select(F.col(key).alias(name)).filter(F.col(name).isNotNull())
    if dropped.count() <= BROADCAST_KEYS:
        dropped = F.broadcast(dropped)
    return df.join(dropped, F.col(f"`{key}`") == F.col(name), "left_anti")


def filter_rows(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], list[bool]]], text_col: str = "text") -> DataFrame:
    """Rows of ``df``, with all columns, for which the batch function of ``make()`` says True. ``text`` is its only input."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = make()
        for b in batches:
            for k in range(0, b.num_rows, STEP_ROWS):
                part = b.slice(k, STEP_ROWS)
                yield part.filter(pa.array(test(part.column(text_col)), pa.bool_()))
    ship(df.sparkSession)
    return df.mapInArrow(run, df.schema)
