"""Sharding (5): proportional stratified interleaving, with DataFrame functions alone.

Rows of a source are shuffled by a seeded hash and ranked; rank r of n rows stands at ``(r - 1 + u) / n``, where u in [0, 1) is
a hash of the source, so that sources of equally few rows do not all stand at the same places. All rows
sorted by that place are an interleaving in which every stretch holds the sources in the proportion of the whole, and
equal cuts of it are the shards: counts differ by one at most, and every shard matches the mixture.

Neither rank needs a source, or all rows, in one task. A source is dealt into as many hash ranges as it needs for
``bucket_rows`` rows each; counts per range give every range its offset, and rows are numbered within their range.
The place is dealt into ranges in the same way for the order of all rows. Ranges of a hash hold about as many rows
each however large a source is; the tables of counts have one row per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mixprep.llm.common import keep_columns, stage

BUCKET_ROWS = 2_000
#: Ranges of counts that one task adds up.
GROUP = 1_024
#: Bits of the hash that shifts the places of a source.
SHIFT_BITS = 21


def _offsets(counts: DataFrame, by: list[str], bucket: str) -> DataFrame:
    """``counts`` (by..., bucket, n) with ``before``: the rows of smaller buckets of the same ``by``.

    In two levels: buckets within groups of ``GROUP``, then the groups, so no task orders more than that many
    buckets, or one row per ``GROUP`` of them.
    """
    grouped = counts.withColumn("group", F.floor(F.col(bucket) / GROUP))
    w = Window.partitionBy(*by, "group").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    inner = grouped.withColumn("in_group", F.coalesce(F.sum("n").over(w), F.lit(0)))
    sums = grouped.groupBy(*by, "group").agg(F.sum("n").alias("of_group"))
    w = Window.partitionBy(*by).orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    outer = sums.withColumn("groups_before", F.coalesce(F.sum("of_group").over(w), F.lit(0))).drop("of_group")
    return inner.join(outer, [*by, "group"]).select(*by, bucket, (F.col("in_group") + F.col("groups_before")).alias("before"))


def interleave(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", shards: int = 8, seed: int = 17,
               bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per input row: id column, size, text_crc32, source, place, shard, slot.

    ``size`` is the UTF-8 bytes of the text plus 1 (null: none, so 1); ``text_crc32`` that of the text (null: empty).
    ``shard`` is 0 to ``shards - 1``, ``slot`` counts from 0 within it, in the interleaved order. Rows of a null source
    are a source of their own. Ties of the hash are settled by id, then text checksum and size: rows that are equal in
    all of these may change places, which changes nothing in the result. A source with fewer rows than shards
    spreads out as far as it goes; with fewer rows than shards in all, the last ones differ by one row at most like any
    others. Other columns are not read. No rows in, no rows out.
    """
    rows = keep_columns(df, {id_col: "id", text_col: "text", source_col: "source"}).select(
        "id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("crc"), "source")
    rows = rows.select("id", (F.col("bytes") + 1).alias("size"), "crc", "source", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("key"),
                       F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id", "crc"), 2).alias("h"))
    rows = stage(rows, "rows")
    sizes = stage(rows.groupBy("key").agg(F.count(F.lit(1)).alias("total")).withColumn("ranges", F.ceil(F.col("total") / bucket_rows)), "sources")
    dealt = rows.join(sizes, "key").withColumn("bucket", _range("h", F.col("ranges")))
    dealt = stage(dealt, "dealt")
    before = stage(_offsets(dealt.groupBy("key", "bucket").agg(F.count(F.lit(1)).alias("n")), ["key"], "bucket"), "before")
    within = Window.partitionBy("key", "bucket").orderBy("h", F.col("id").asc_nulls_first(), "crc", "size")
    ranked = dealt.withColumn("r", F.row_number().over(within)).join(before, ["key", "bucket"])
    # The place as a whole number: 2^40 steps of the unit interval; ties go by source, then rank.
    rank = F.col("r") + F.col("before")
    step = (rank - 1) * 2 ** SHIFT_BITS + F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit("shift"), "key"), 64 - SHIFT_BITS)
    place = F.floor(step.cast("decimal(38,0)") * F.lit(2 ** 40) / (F.col("total") * 2 ** SHIFT_BITS)).cast("long")
    ranked = stage(ranked.select("id", "size", "crc", "source", "key", rank.alias("rank"), place.alias("place")), "ranked")

    n = ranked.count()
    ranges = max(1, -(-n // bucket_rows))
    ranked = ranked.withColumn("one", F.lit(0)).withColumn("bucket", F.shiftright(F.shiftright("place", 10) * ranges, 30).cast("long"))
    before = stage(_offsets(ranked.groupBy("one", "bucket").agg(F.count(F.lit(1)).alias("n")), ["one"], "bucket"), "before")
    within = Window.partitionBy("bucket").orderBy("place", "key", "rank")
    numbered = ranked.withColumn("r", F.row_number().over(within)).join(before.select("bucket", "before"), "bucket")
    position = F.col("r") + F.col("before") - 1
    # n // shards rows each, and one more in the first n % shards.
    small, more = n // shards, n % shards
    shard = F.when(position < more * (small + 1), F.floor(position / (small + 1))).otherwise(F.floor((position - more) / max(small, 1)))
    first = F.col("shard") * small + F.least(F.col("shard"), F.lit(more))
    out = numbered.select("id", "size", "crc", "source", "place", position.alias("position"), shard.cast("int").alias("shard"))
    return out.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "source", "place", "shard", (F.col("position") - first).cast("long").alias("slot"))


def _range(h: str, ranges: Column) -> Column:
    """The equal range of ``0 .. 2**62`` that a hash falls into, by its upper 31 bits."""
    return F.shiftright(F.shiftright(F.col(h), 31) * ranges, 31).cast("long")
