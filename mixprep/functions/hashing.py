"""Deterministic hashing used for every reproducible shuffle, sample and draw.

A row's position never depends on partitioning, task order or retries: it is a
pure function of ``seed`` and the row's id. md5 is used (not ``xxhash64``/``hash``)
because the same numbers can be computed by an independent SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

TWO_POW_52 = float(2 ** 52)


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_hex(id_col, seed) -> Column:
    """md5 hex of ``'{seed}:{id}'``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _as_col(id_col).cast("string")))


def uniform01(id_col, seed) -> Column:
    """Uniform double in [0, 1) from the first 13 hex digits (52 bits) of the hash."""
    h = hash_hex(id_col, seed)
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("bigint") / F.lit(TWO_POW_52)
