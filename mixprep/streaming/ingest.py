"""File-source stream: JSONL sample drops -> normalised, length-filtered parquet."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from mixprep.functions.text import char_len
from mixprep.operators.normalize import to_sft
from mixprep.schemas import ALPACA, SFT
from mixprep.sources.jsonl import _SCALAR, CORRUPT, _with_mixed_arrays


def sample_stream_schema() -> StructType:
    """Union of the SFT and Alpaca fields, so either form is accepted."""
    fields = {f.name: f for f in list(SFT.fields) + list(ALPACA.fields)}
    return StructType(list(fields.values()))


def start_ingest(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                 max_char: int | None = None, max_files_per_trigger: int = 100,
                 available_now: bool = False, quarantine_dir: str | None = None) -> StreamingQuery:
    """Start the stream; all folders must be on shared storage.

    Lines that do not parse are kept, with the name of their file, in ``quarantine_dir`` (by default beside the sink). Both
    tables have a folder per micro-batch, which a batch that runs again overwrites: rows are there exactly once.
    """
    quarantine_dir = quarantine_dir or f"{sink_dir.rstrip('/')}_quarantine"
    schema = StructType([*sample_stream_schema().fields, StructField(CORRUPT, StringType())])
    raw = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).option("pathGlobFilter", "*.jsonl")
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(source_dir))
    raw = raw.withColumn("file_name", F.col("_metadata.file_name"))

    def put(batch, number: int) -> None:
        rows = _with_mixed_arrays(batch, sample_stream_schema())
        out = to_sft(rows.filter(F.col(CORRUPT).isNull()), keep=["file_name"]).filter(~F.col("is_empty")).drop("is_empty")
        if max_char is not None:
            out = out.filter(char_len("system", "prompt", "response") <= F.lit(int(max_char)))
        out.write.mode("overwrite").parquet(f"{sink_dir}/batch={number}")
        bad = rows.filter(F.col(CORRUPT).isNotNull() & ~F.col(CORRUPT).rlike(_SCALAR))
        bad.select("file_name", F.col(CORRUPT).alias("line"), F.length("prompt").alias("n")).drop("n").write.mode("overwrite").parquet(f"{quarantine_dir}/batch={number}")

    w = raw.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
