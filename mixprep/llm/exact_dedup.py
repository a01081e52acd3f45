"""Exact dedup (9): stateful streaming over disk-backed keyed state, bytes checked on every hit.

A Structured Streaming query reads the documents and keeps, per digest of the normalised text, a
count and the best row (most code points, then smallest id) with its content locator: the digest,
the stable id and the place of the text are retained, never the text. The state is the keyed state of
a streaming aggregation without a watermark, so no entry expires; it lives in RocksDB on the
executors' disks and is checkpointed to the shared folder. Spark combines the rows of a digest in each
map task first, so a text with a third of all rows reaches the state as one row per task.

Digests only propose. Every row of a digest with two rows or more is a hit: its normalised bytes
are compared with those of the retained row, and rows that differ form groups of their own by the bytes.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from contextlib import contextmanager
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mixprep.llm.common import ASCII_SPACE, drop_rows, free_name, scratch_path, stage

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",  # a store's native memory goes with its task
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else every partition reserves megabytes of disk
}

#: Hits up to which their locators are broadcast (about 50 MB); beyond, a shuffled join.
BROADCAST_HITS = 200_000


def normalized(text: Column) -> Column:
    """The text without white space of ``[\\x20\\x09-\\x0D]``; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), ASCII_SPACE, "")


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@contextmanager
def _conf(spark: SparkSession, values: dict[str, str]):
    """Session settings for one streaming query, put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def row_locator(spark: SparkSession, path: str) -> Column:
    """File and row of a row of the Parquet files at ``path``: the file's place under ``path``, folders of partitions included, as one task
    writes files of the same name into several of them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    root = fs.makeQualified(at if fs.getFileStatus(at).isDirectory() else at.getParent()).toString()
    plain = lambda uri: re.sub("^file:/+", "/", uri)
    file = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/")
    return F.concat_ws("#", F.replace(file, F.lit(plain(quote(root, safe="/:")).rstrip("/") + "/"), F.lit("")), F.col("_metadata.row_index"))


def located(df: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column], locator: Column) -> DataFrame:
    """(id, norm, points, digest, locator) of a Parquet scan (``row_locator``)."""
    text = F.col(f"`{text_col}`")
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), normalized(text).alias("norm"),
                     F.char_length(F.coalesce(text, F.lit(""))).cast("long").alias("points"),
                     locator.alias("locator"))
    return rows.withColumn("digest", digest(F.col("norm")))


def retained(spark: SparkSession, path: str, schema, id_col: str, text_col: str, digest: Callable[[Column], Column],
             checkpoint: str, max_bytes_per_batch: str | None = None) -> DataFrame:
    """Run the streaming query over the Parquet files at ``path`` and return what its state holds: per digest
    ``n`` rows and the row that stays: ``keep_id`` and ``keep_at``, its locator.

    Started again with the same ``checkpoint``, it goes on where it was: only new files are read.
    """
    reader = spark.readStream.schema(schema)
    if max_bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_batch)
    locator = row_locator(spark, path)
    if not _status(spark, path).isDirectory():  # streams read folders: the one file of its folder
        path, name = path.rsplit("/", 1)
        reader = reader.option("pathGlobFilter", name)
    best = F.max(F.struct("points", (-F.col("id")).alias("minus_id"), "locator"))
    state = located(reader.parquet(path), id_col, text_col, digest, locator).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), best.alias("best"))
    out = f"{checkpoint}/updates"

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    with _conf(spark, ROCKSDB):
        query = (state.writeStream.outputMode("update").option("checkpointLocation", f"{checkpoint}/state")
                 .trigger(availableNow=True).foreachBatch(put).start())
        query.awaitTermination()
    if _status(spark, out) is None:  # no file, no row
        return spark.createDataFrame([], "digest string, n bigint, keep_id bigint, keep_at string")
    updates = spark.read.schema("digest string, n bigint, best struct<points: bigint, minus_id: bigint, locator: string>, batch bigint").parquet(out)
    if query.lastProgress is None or query.lastProgress["batchId"] > 0:  # the last update of a digest holds
        updates = updates.groupBy("digest").agg(F.max(F.struct("batch", "n", "best")).alias("u")).select("digest", "u.n", "u.best")
    return updates.select("digest", "n", (-F.col("best.minus_id")).alias("keep_id"), F.col("best.locator").alias("keep_at"))


def _status(spark: SparkSession, path: str):
    """Hadoop's status of a path, or None where nothing is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getFileStatus(at) if fs.exists(at) else None


def exact_dedup(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text",
                digest: Callable[[Column], Column] = sha256_hex, max_bytes_per_batch: str | None = None) -> DataFrame:
    """One row per row of the Parquet files at ``path``: id column, keep_id, group_size, kept, text_sha256, locator.

    Equal are texts whose normalised bytes are equal. Of a group the row with the most code points in the
    original text stays, then the one with the smallest id; of rows that repeat both, the one with the greatest locator, so
    exactly one row of a group is ``kept``. Null and empty texts are equal to each other and to texts of white space.
    Ids must be whole numbers; a null id counts as larger than any other. No rows in, no rows out. Other columns are not read.
    """
    checkpoint = scratch_path(spark, "exact-dedup")
    table = spark.read.parquet(path)
    groups = retained(spark, path, table.schema, id_col, text_col, digest, checkpoint, max_bytes_per_batch)
    rows = located(table, id_col, text_col, digest, row_locator(spark, path))
    thin = rows.select("id", "digest", "locator", (F.col("digest") if digest is sha256_hex else sha256_hex(F.col("norm"))).alias("sha"))
    thin.write.mode("overwrite").parquet(f"{checkpoint}/thin")
    thin = spark.read.parquet(f"{checkpoint}/thin")

    # Every hit against the bytes of the retained row. Digests and locators alone are joined to find the hits; only their texts are read, made
    # again and shuffled. Locators that are too many to send are joined by a shuffle, which then moves the other texts as well.
    copies = groups.filter("n > 1").select("digest", "keep_at")
    thin.select("digest", "locator").join(copies, "digest").write.mode("overwrite").parquet(f"{checkpoint}/hit-rows")
    wanted = spark.read.parquet(f"{checkpoint}/hit-rows").withColumnRenamed("locator", "at")
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_HITS else wanted
    source = table.select(normalized(F.col(f"`{text_col}`")).alias("norm"), row_locator(spark, path).alias("locator"))
    source.join(wanted, F.col("locator") == F.col("at")).select("norm", "digest", "locator", "keep_at").write.mode("overwrite").parquet(f"{checkpoint}/hits")
    hits = spark.read.parquet(f"{checkpoint}/hits")
    kept = hits.filter("locator = keep_at").select("digest", F.col("norm").alias("kept_norm"))
    clash = hits.join(kept, "digest").filter("norm <> kept_norm").select("digest").distinct()
    cols = ["id", "n", "keep_id", "keep_at", "locator", "sha"]
    fine = thin
    if clash.isEmpty():
        return _result(fine.join(groups, "digest").select(*cols), id_col)
    # Two texts share a digest: such digests are grouped by the bytes themselves.
    clash.write.mode("overwrite").parquet(f"{checkpoint}/clash")
    clash = spark.read.parquet(f"{checkpoint}/clash")
    mixed = rows.join(clash, "digest", "left_semi")
    own = mixed.groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("points", (-F.col("id")).alias("minus_id"), "locator")).alias("best"))
    own = own.select("digest", "norm", "n", (-F.col("best.minus_id")).alias("keep_id"), F.col("best.locator").alias("keep_at"))
    mixed = mixed.join(own, ["digest", "norm"]).withColumn("sha", sha256_hex(F.col("norm")))
    fine = fine.join(clash, "digest", "left_anti").join(groups, "digest")
    return _result(fine.select(*cols).unionByName(mixed.select(*cols)), id_col)


def _result(out: DataFrame, id_col: str) -> DataFrame:
    return out.select(F.col("id").alias(id_col), "keep_id", F.col("n").alias("group_size"), (F.col("locator") == F.col("keep_at")).alias("kept"),
                      F.col("sha").alias("text_sha256"), "locator")


def plain_path(df: DataFrame) -> str | None:
    """The one Parquet folder or file that ``df`` reads as it is, all rows and columns; None for any other frame.

    Spark's plan tells: it is a bare scan, without options, partition folders or a schema other than that of the files.
    """
    plan = df._jdf.queryExecution().analyzed()
    if plan.getClass().getSimpleName() != "LogicalRelation" or plan.relation().getClass().getSimpleName() != "HadoopFsRelation":
        return None
    scan = plan.relation()
    roots = scan.location().rootPaths()
    options = scan.options().size() - int(scan.options().contains("path"))
    if scan.fileFormat().toString() != "Parquet" or options or scan.partitionSchema().length() or roots.size() != 1:
        return None
    path = roots.head().toString()
    return path if df.sparkSession.read.parquet(path).schema == df.schema else None


def source_path(df: DataFrame) -> str:
    """The Parquet folder or file that ``df`` is a plain read of; for any other frame a staged copy."""
    path = plain_path(df)
    if path is None:
        path = scratch_path(df.sparkSession, "source")
        df.write.parquet(path)
    return path


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, that stay: one of every group of equal texts (see ``exact_dedup``)."""
    spark, path = df.sparkSession, source_path(df)
    at = free_name(df, "copy_at")
    copies = stage(exact_dedup(spark, path, id_col, text_col).filter("not kept").select(F.col("locator").alias(at)), "copies")
    return drop_rows(spark.read.parquet(path).select("*", row_locator(spark, path).alias(at)), copies, at).select(*[F.col(f"`{c}`") for c in df.columns])
