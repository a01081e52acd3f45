"""Named JSONL files by a commit protocol (K1, K4): tasks write drafts, the job's commit publishes them all by one rename.

A Python data source writer. A task writes the lines of each name into a hidden draft of its own attempt and gives a draft its file name when it is whole, so a
task that fails, runs again or runs twice leaves every row once: attempts of a task write the same file. The drafts lie in a folder beside the
target; ``commit`` runs when all tasks are done and moves that folder to the target, ``abort`` deletes it. So the target is never half
written, and the driver's work does not grow with the number of files.

One plain file per name (``publish_plain``) is written by many tasks: ranges of the order are published beside the target as parts, and every part is
copied to its place in its file.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from mixprep.session import scratch_path, ship_code
from mixprep.sources import files
from mixprep.sources.stores import file_system, qualified

#: Layouts: a folder of part files per name, one plain file per name, or numbered files side by side.
LAYOUTS = {"folders": "{name}.jsonl/part-{task:05d}.jsonl", "plain": "{name}.jsonl", "flat": "{name}_{task:05d}.jsonl"}
#: Names that one task may have open; a name is a file, not a key.
MAX_NAMES = 1_000
#: Bytes of lines in one range of a plain file, and bytes copied at once.
PART_BYTES, COPY_BYTES = 32 << 20, 1 << 20


@dataclass
class Written(WriterCommitMessage):
    rows: dict[str, int]


class NamedWriter(DataSourceArrowWriter):
    def __init__(self, root: str, layout: str, overwrite: bool):
        self.root, self.layout, self.overwrite = root.rstrip("/"), layout, overwrite
        self.drafts = f"{self.root}.drafts-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        from pyspark import TaskContext
        context = TaskContext.get()
        return self.write_part(iterator, context.partitionId(), f"{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}")

    def write_part(self, iterator: Iterator, task: int, attempt: str) -> Written:
        """The lines of one task; ``attempt`` tells its attempts apart."""
        system, root = file_system(self.drafts)
        system.create_dir(root, recursive=True)
        open_files, rows = {}, {}
        try:
            for batch in iterator:
                for name, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if name not in open_files:
                        if len(open_files) >= MAX_NAMES:
                            raise ValueError(f"more than {MAX_NAMES} names in one task")
                        draft = f"{root}/.{quote(name, safe='')[:80]}-{task:05d}-{attempt}-{len(open_files)}"
                        open_files[name] = draft, system.open_output_stream(draft)
                        rows[name] = 0
                    open_files[name][1].write(line.encode("utf-8") + b"\n")
                    rows[name] += 1
        finally:
            for _, f in open_files.values():
                f.close()
        for name, (draft, _) in open_files.items():
            final = f"{root}/{LAYOUTS[self.layout].format(name=file_name(name), task=task)}"
            system.create_dir(final.rsplit("/", 1)[0], recursive=True)
            system.move(draft, final)
        return Written(rows)

    def commit(self, messages: list) -> None:
        system, drafts = file_system(self.drafts)
        _, root = file_system(self.root)
        system.create_dir(drafts, recursive=True)                    # a job without rows publishes an empty folder
        if self.layout == "plain":
            names = [n for m in messages if m for n in m.rows]
            if len(names) != len(set(names)):
                self.abort(messages)
                raise ValueError("rows of one name came from several tasks")
        self._sweep(system, drafts)
        if not replace(system, drafts, root, self.overwrite):
            self.abort(messages)
            raise FileExistsError(self.root)

    def _sweep(self, system, drafts: str) -> None:
        """Drafts of attempts that failed: hidden files, which readers pass over anyway."""
        from pyarrow import fs
        for f in system.get_file_info(fs.FileSelector(drafts)):
            if f.is_file and f.base_name.startswith("."):
                system.delete_file(f.path)

    def abort(self, messages: list) -> None:
        system, drafts = file_system(self.drafts)
        if _there(system, drafts):
            system.delete_dir(drafts)


def replace(system, drafts: str, root: str, overwrite: bool) -> bool:
    """Move the folder ``drafts`` to ``root``; False, and nothing done, where ``root`` is there and stays."""
    if not _there(system, root):
        system.create_dir(root.rsplit("/", 1)[0], recursive=True)
        system.move(drafts, root)
        return True
    if not overwrite:
        return False
    old = f"{root}.old-{uuid.uuid4().hex}"
    system.move(root, old)
    system.move(drafts, root)
    system.delete_dir(old)
    return True


def _there(system, path: str) -> bool:
    from pyarrow import fs
    return system.get_file_info(path).type != fs.FileType.NotFound


def file_name(name: str) -> str:
    """A name as a file's: slashes and a leading dot or underscore (hidden from readers) are escaped."""
    name = name.replace("/", "%2F") or "%"
    return f"%{ord(name[0]):02X}{name[1:]}" if name[0] in "._" else name


class NamedSource(DataSource):
    """``df.write.format("named_jsonl")`` of (name, line); options ``path`` and ``layout``."""

    @classmethod
    def name(cls) -> str:
        return "named_jsonl"

    def writer(self, schema: StructType, overwrite: bool):
        return NamedWriter(self.options["path"], self.options.get("layout", "folders"), overwrite)


def places(system, parts: str) -> dict[str, list[tuple[str, int, int]]]:
    """Per file name: (path, begin in the file, size) of its parts in the published folder ``parts``, in the order of the tasks that wrote them."""
    from pyarrow import fs
    found: dict[str, list] = {}
    for f in system.get_file_info(fs.FileSelector(parts, recursive=True)):
        if f.is_file:
            found.setdefault(f.path.rsplit("/", 2)[-2], []).append((len(f.base_name), f.base_name, f.path, f.size))
    out = {}
    for name, own in found.items():
        at, out[name] = 0, []
        for _, _, path, size in sorted(own):
            out[name].append((path, at, size))
            at += size
    return out


def put(path: str, final: str, begin: int) -> None:
    """Copy a part to its place in a file that other tasks write as well; done again or twice, it writes the same bytes."""
    with open(path, "rb") as part, open(os.open(final, os.O_WRONLY | os.O_CREAT, 0o666), "wb") as out:
        out.seek(begin)
        shutil.copyfileobj(part, out, COPY_BYTES)


def join(parts: list[str], final: str, uri: str) -> None:
    """A file of its parts, on a store whose files are written from the first byte to the last."""
    system, _ = file_system(uri)
    with system.open_output_stream(final) as out:
        for path in parts:
            with system.open_input_stream(path) as part:
                shutil.copyfileobj(part, out, COPY_BYTES)


def publish_plain(spark: SparkSession, rows: DataFrame, root: str, overwrite: bool) -> None:
    """One file per name of (name, line, further columns): rows in the order of the further columns, whatever the number of rows of a name.

    The rows are written once and numbered, so that ranges of about ``PART_BYTES`` split rows of equal order as well. Tasks sort a range each and publish it as a part;
    then tasks copy a part each to its place. Only stores without random access (any but ``file:``) have one task join the parts of a file, as a stream.
    """
    rows, staged = rows.withColumn("_bytes", F.octet_length("line") + F.lit(1)), scratch_path(spark, "publish")
    rows.write.parquet(staged)
    back = spark.read.schema(rows.schema).parquet(staged)
    total = back.agg(F.sum("_bytes")).first()[0] or 0
    back = back.drop("_bytes").withColumns({"_file": F.col("_metadata.file_name"), "_at": F.col("_metadata.row_index")})
    keys = [c for c in back.columns if c != "line"]
    ranges = back.repartitionByRange(max(1, -(-total // PART_BYTES)), *keys).sortWithinPartitions(*keys)
    number = uuid.uuid4().hex
    system, target = file_system(root)
    _, parts = file_system(f"{root}.parts-{number}")
    _, drafts = file_system(f"{root}.drafts-{number}")
    try:
        ranges.select("name", "line").write.format("named_jsonl").mode("append").option("path", f"{root}.parts-{number}").option("layout", "folders").save()
        found = places(system, parts)
        system.create_dir(drafts, recursive=True)
        if system.type_name == "local":
            jobs = [(path, f"{drafts}/{name}", begin) for name, own in found.items() for path, begin, _ in own]
            if jobs:
                spark.sparkContext.parallelize(jobs, len(jobs)).foreach(lambda job: put(*job))
        elif found:
            jobs = [([path for path, _, _ in own], f"{drafts}/{name}", root) for name, own in found.items()]
            spark.sparkContext.parallelize(jobs, len(jobs)).foreach(lambda job: join(*job))
        for name, own in found.items():
            if system.get_file_info(f"{drafts}/{name}").size != sum(size for _, _, size in own):
                raise OSError(f"{name} has not the size of its parts")
        if not replace(system, drafts, target, overwrite):
            raise FileExistsError(root)
    finally:
        for folder in (parts, drafts):
            if _there(system, folder):
                system.delete_dir(folder)
        files.delete(spark, staged)


def publish_jsonl(spark: SparkSession, df: DataFrame, root: str, name_col: Column | str, cols, layout: str = "folders", array_per_line: bool = False,
                  mode: str = "overwrite", order: tuple = ()) -> list[str]:
    """Write ``cols`` of every row, as one JSON object (or one-element array) per line, to ``{root}/{name}.jsonl``; the paths of what was published.

    ``layout``: ``"folders"`` makes ``{name}.jsonl`` a folder of part files in the order of the frame's partitions; ``"plain"`` makes it one file in the rising order
    of the columns ``order``, written by many tasks (``publish_plain``); ``"flat"`` makes files ``{name}_00007.jsonl``.
    A null name is ``null``. With ``mode="errorifexists"`` an existing target is an error and stays.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}")
    ship_code(spark)
    spark.dataSource.register(NamedSource)
    root = qualified(spark, root)
    name = F.col(name_col) if isinstance(name_col, str) else name_col
    line = F.struct(*cols)
    line = F.to_json(F.array(line) if array_per_line else line, {"ignoreNullFields": "false"})
    if mode == "errorifexists" and files.exists(spark, root):
        raise FileExistsError(root)
    keys = [(F.col(c) if isinstance(c, str) else c).alias(f"_order{k}") for k, c in enumerate(order)] if layout == "plain" else []
    rows = df.select(F.coalesce(name.cast("string"), F.lit("null")).alias("name"), *keys, line.alias("line"))
    if layout == "plain":
        publish_plain(spark, rows, root, mode == "overwrite")
    else:
        rows.write.format("named_jsonl").mode("overwrite" if mode == "overwrite" else "append").option("path", root).option("layout", layout).save()
    return sorted(files.list_files(spark, root) if layout != "folders" else files.list_dirs(spark, root))
