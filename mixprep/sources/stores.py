"""Files of a store that tasks open themselves (the Python data sources): a URI's file system and path."""

from __future__ import annotations


def file_system(uri: str):
    """(file system, path in it) of ``uri``, as Hadoop writes it: ``file:/x``, ``file:///x``, a plain path, or a scheme that pyarrow knows
    (hdfs, s3, gs, abfss). Any other scheme is an error: only Spark's own readers reach such a store."""
    from pyarrow import fs
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def qualified(spark, path: str) -> str:
    """``path`` with the scheme and folder that Spark gives it, so that tasks mean the same place."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
