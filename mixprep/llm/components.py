"""Connected components by alternating large-star and small-star steps (union-find over tables).

Nothing is collected: each step is a join of the edge table with the smallest neighbour of its nodes. The
minima are written before they are joined, so both sides of a join are plain shuffles and a hub with a
third of all edges is split by adaptive execution. Every round is written to the shared folder, which
cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mixprep.llm.common import stage


def _least(edges: DataFrame) -> DataFrame:
    """(u, m), written: the smallest ``v`` of each ``u``."""
    return stage(edges.groupBy("u").agg(F.min("v").alias("m")), "cc-min")


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v: longs) -> (node, component): the smallest node reachable, for every node that is not itself that node.

    Loops, repeated edges, either direction, null ends (left out) and an empty table are fine.
    """
    now = stage(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    mark = None
    while True:
        r = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.shiftright(F.xxhash64("u", "v"), 24)).alias("h")).first()
        if (r["n"], r["h"]) == mark or not r["n"]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = (r["n"], r["h"])
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stage(both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(), "cc-large")
        least = _least(large)
        own = least.select("u", F.col("m").alias("v"))
        now = stage(large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own).distinct(), "cc")
