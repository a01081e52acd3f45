"""Vectors of a table as rows of whole numbers: what the whitening and the exact search share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Scaled components beyond this (2^40) are refused: sums of their products would leave what the operators hold exactly.
LARGEST = 2.0 ** 40


def scaled_rows(df: DataFrame, id_col: str, vector_col: str, scale: float, shift: int = 0) -> DataFrame:
    """(id, x): ``floor(scale * c) + shift`` of every component ``c`` taken as double.

    Left out are vectors that are null or hold a null or non-finite component. Shorter vectors are filled up with components
    of 0 to the longest one's length, so all rows have one length. A finite component whose scaled value is beyond
    ``LARGEST`` fails the job. Other columns are not read.
    """
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = df.select(F.col(f"`{id_col}`").alias("id"), v.alias("v")).filter("v is not null")
    rows = rows.filter(~F.coalesce(F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))), F.lit(True)))
    width = rows.agg(F.max(F.size("v")).alias("n")).first()["n"] or 0
    v = F.concat("v", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("v")))
    error = F.raise_error(F.lit(f"a scaled component is beyond {LARGEST:.0f}")).cast("bigint")
    return rows.select("id", F.transform(v, lambda c: F.when(F.abs(c * scale) <= LARGEST, F.floor(c * scale).cast("bigint") + shift).otherwise(error)).alias("x"))


def matrix(column: pa.Array, dtype=np.int64) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
