"""Driver-side file listing through the Hadoop FileSystem (metadata only, no rows)."""

from __future__ import annotations

from fnmatch import fnmatch

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_files(spark: SparkSession, directory: str, pattern: str = "*") -> list[str]:
    """Files directly under ``directory`` whose name matches ``pattern``, sorted by name."""
    fs, p = _fs(spark, directory)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        if st.isFile():
            name = st.getPath().getName()
            if fnmatch(name, pattern):
                out.append((name, st.getPath().toString()))
    return [full for _, full in sorted(out)]


def list_dirs(spark: SparkSession, directory: str) -> list[str]:
    fs, p = _fs(spark, directory)
    return sorted(st.getPath().toString() for st in fs.listStatus(p) if st.isDirectory())


def rename(spark: SparkSession, src: str, dst: str) -> str:
    """Move a file, making the folder it goes to; a refusal is an error, never a lost file."""
    fs, p = _fs(spark, src)
    to = spark._jvm.org.apache.hadoop.fs.Path(dst)
    fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"could not move {src} to {dst}")
    return dst


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def first_files(spark: SparkSession, directory: str, n: int | None, pattern: str = "*") -> list[str]:
    """The first ``n`` files of a table directory in name order (all when ``n`` is None)."""
    files = list_files(spark, directory, pattern)
    return files if n is None else files[:n]


def size_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes under a path (a directory written by Spark or a file)."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0
