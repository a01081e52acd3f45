"""A growing item map, last wins, without reading old files again.

A streaming query takes the map's new files and keeps, per key, the greatest place seen and its values in keyed state without expiry. The place is
the reference's reading order: file name, then row. Each micro-batch writes the keys it changed into a folder of its own, which a batch that
runs again overwrites. Started again with the same state folder it goes on where it was; two arrivals give what one full read gives, even when
a later arrival brings files whose names come earlier.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from mixprep.sources import files

_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class GrowingMap:
    """The map of the parquet files at ``directory``; ``state_dir`` (shared, one per map) holds checkpoint, state and changes."""

    def __init__(self, spark: SparkSession, directory: str, state_dir: str, keys: Sequence[str], values: Sequence[str], schema: StructType | str, key_casts: dict | None = None):
        self.spark, self.directory, self.state_dir = spark, directory, state_dir.rstrip("/")
        self.keys, self.values, self.schema, self.casts = list(keys), list(values), schema, key_casts or {}

    def refresh(self, max_files: int = 1_000) -> None:
        """Take the files that have come since the last time, at most ``max_files`` a micro-batch."""
        spark = self.spark
        conf = {"spark.sql.streaming.stateStore.providerClass": _STORE, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
        before = {k: spark.conf.get(k, None) for k in conf}
        rows = spark.readStream.schema(self.schema).option("maxFilesPerTrigger", max_files).option("pathGlobFilter", "*.parquet").parquet(self.directory)
        keys = [F.col(k).cast(self.casts[k]).alias(k) if k in self.casts else F.col(k) for k in self.keys]
        place = F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
        last = rows.select(*keys, *self.values, place.alias("place")).groupBy(*self.keys).agg(F.max_by(F.struct("place", *self.values), F.col("place")).alias("last"))
        changed = f"{self.state_dir}/changed"

        def put(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{changed}/batch={number}")
        for k, v in conf.items():
            spark.conf.set(k, v)
        try:
            w = last.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", f"{self.state_dir}/checkpoint")
            w.trigger(availableNow=True).start().awaitTermination()
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)

    def table(self) -> DataFrame:
        """One row per key. Changes of several batches meet by their place, which only grows, so no order of batches is needed."""
        changed = f"{self.state_dir}/changed"
        if not files.exists(self.spark, changed):
            empty = self.spark.createDataFrame([], self.schema)
            return empty.select(*[F.col(k).cast(self.casts[k]).alias(k) if k in self.casts else F.col(k) for k in self.keys], *self.values)
        rows = self.spark.read.parquet(changed).groupBy(*self.keys).agg(F.max_by("last", F.col("last.place")).alias("last"))
        return rows.select(*self.keys, *[F.col(f"last.`{v}`").alias(v) for v in self.values])
