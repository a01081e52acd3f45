"""The first samples of each file (S4), reading no more of it than they take.

A Python data source with one partition per file. A task reads its file line by line, as the reference does (strip, skip blank lines, an array is
its entries, an object is a sample, other values are dropped), and stops after ``max_samples``. What lies behind is never read, so unlike a whole scan it
does not fail on a malformed line there. Samples leave the task as JSON text with the byte offset of their line; fields are parsed by Spark.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from mixprep.session import ship_code
from mixprep.sources.stores import file_system

#: Bytes asked of a store at once.
CHUNK = 1 << 16


class FilePart(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


def lines(file, chunk: int = CHUNK) -> Iterator[tuple[int, bytes]]:
    """(offset, line) of a binary file, reading as far as it is asked."""
    held, at = b"", 0
    while True:
        data = file.read(chunk)
        held += data
        *whole, held = held.split(b"\n")
        for line in whole:
            yield at, line
            at += len(line) + 1
        if not data:
            break
    if held:
        yield at, held


def head(file, max_samples: int, name: str = "") -> Iterator[tuple[int, int, str]]:
    """(line offset, place in the line, JSON text) of the first ``max_samples`` samples."""
    n = 0
    if n >= max_samples:
        return
    for offset, raw in lines(file):
        text = raw.decode("utf-8").strip()
        if not text:
            continue
        try:
            value = json.loads(text)
        except ValueError as e:
            raise ValueError(f"malformed JSONL line in {name} at byte {offset}: {text[:200]}") from e
        for k, sample in enumerate(value if isinstance(value, list) else [value]):
            if isinstance(sample, dict):
                yield offset, k, json.dumps(sample, ensure_ascii=False) if isinstance(value, list) else text
                n += 1
                if n >= max_samples:
                    return


class HeadReader(DataSourceReader):
    def __init__(self, paths: list[str], max_samples: int):
        self.paths, self.max_samples = paths, max_samples

    def partitions(self) -> Sequence[InputPartition]:
        return [FilePart(p) for p in self.paths]

    def read(self, partition: FilePart) -> Iterator[tuple]:
        system, path = file_system(partition.path)
        name = path.rsplit("/", 1)[-1]
        with system.open_input_file(path) as f:
            for n, (offset, k, text) in enumerate(head(f, self.max_samples, name)):
                yield name, n, offset, k, text


class HeadSource(DataSource):
    """``spark.read.format("jsonl_head")``; options ``paths`` (a JSON list) and ``max_samples``."""

    @classmethod
    def name(cls) -> str:
        return "jsonl_head"

    def schema(self) -> str:
        return "file_name string, sample_no bigint, line_offset bigint, line_item int, sample string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return HeadReader(json.loads(self.options["paths"]), int(self.options["max_samples"]))


def read_heads(spark: SparkSession, paths: Sequence[str], schema: StructType | str, max_samples: int) -> DataFrame:
    """The first ``max_samples`` samples of each file: the fields of ``schema``, file_name, sample_no (from 0, in file order) and
    line_offset (byte of the sample's line). Files of a store that only Spark reads are an error (``stores.file_system``)."""
    from mixprep.sources.jsonl import as_schema
    schema = as_schema(schema)
    ship_code(spark)
    spark.dataSource.register(HeadSource)
    df = spark.read.format("jsonl_head").option("paths", json.dumps(list(paths))).option("max_samples", int(max_samples)).load()
    df = df.select(F.from_json("sample", schema).alias("_s"), "file_name", "sample_no", "line_offset")
    return df.select(*[F.col(f"_s.`{f.name}`").alias(f.name) for f in schema.fields], "file_name", "sample_no", "line_offset")
