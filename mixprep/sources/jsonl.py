"""JSONL sample sources.

A line holds one sample object or an array of them; blank lines are ignored.
Spark's JSON reader flattens top-level arrays into rows. Lines and array entries that are JSON
scalars are dropped silently (as the reference does); malformed lines fail the
job (``on_bad='fail'``, like ``json.loads``) or are returned separately
(``'quarantine'``) or dropped (``'drop'``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from mixprep.functions.text import category_from_name
from mixprep.schemas import SFT
from mixprep.sources import files

CORRUPT = "_corrupt_record"


def as_schema(schema: StructType | str) -> StructType:
    """A StructType from itself or from a DDL string such as ``"system STRING, prompt STRING"``."""
    if isinstance(schema, StructType):
        return schema
    from pyspark.sql.types import _parse_datatype_string
    return _parse_datatype_string(schema)
_SCALAR = r'^\s*(-?[0-9][0-9.eE+-]*|"(?:[^"\\]|\\.)*"|true|false|null)\s*$'


def read_jsonl(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str = SFT, on_bad: str = "fail",
               name_glob: str | None = None, lineage: bool = True):
    """Samples from JSONL files; returns a DataFrame (or ``(good, bad)`` for quarantine)."""
    schema = as_schema(schema)
    full = StructType(list(schema.fields) + [StructField(CORRUPT, StringType())])
    r = (spark.read.schema(full).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", CORRUPT).option("encoding", "UTF-8"))
    if name_glob:
        r = r.option("pathGlobFilter", name_glob)
    df = r.json(list(paths) if not isinstance(paths, str) else paths)
    if lineage:
        df = df.withColumn("file_name", F.col("_metadata.file_name"))
    df = _with_mixed_arrays(df, schema)
    bad = F.col(CORRUPT).isNotNull()
    scalar = F.col(CORRUPT).rlike(_SCALAR)
    malformed = bad & ~scalar
    # Spark refuses a JSON scan whose only required column is the corrupt-record
    # column (e.g. a bare count). Tie every filter to one real field as well.
    parsed = F.length(F.coalesce(F.col(schema.fields[0].name).cast("string"), F.lit(""))) >= 0
    if on_bad == "quarantine":
        good = df.filter(~bad & parsed).drop(CORRUPT)
        return good, df.filter(malformed & parsed).select(*(["file_name"] if lineage else []), CORRUPT)
    if on_bad == "drop":
        return df.filter(~bad & parsed).drop(CORRUPT)
    if on_bad == "fail":
        msg = F.concat(F.lit("malformed JSONL line: "), F.substring(F.col(CORRUPT), 1, 200))
        keep = F.when(malformed, F.raise_error(msg).cast("boolean")).when(bad, F.lit(False)).otherwise(parsed)
        return df.filter(keep).drop(CORRUPT)
    raise ValueError(f"unknown on_bad {on_bad!r}")


def _with_mixed_arrays(df: DataFrame, schema: StructType) -> DataFrame:
    """Objects of lines like ``[{...}, 3]``, which the reader rejects as a whole: the entries are parsed one by one."""
    entries = F.from_json(F.col(CORRUPT), "array<string>")
    mixed = F.col(CORRUPT).rlike(r"^\s*\[") & entries.isNotNull()
    objects = F.filter(entries, lambda x: F.coalesce(x.rlike(r"^\s*\{"), F.lit(False)))
    row = lambda x: F.struct(*[x[f.name].alias(f.name) for f in schema.fields], F.lit(None).cast("string").alias(CORRUPT))
    own = F.struct(*[F.col(f.name) for f in schema.fields], F.col(CORRUPT))
    rows = F.when(F.coalesce(mixed, F.lit(False)), F.transform(objects, lambda x: row(F.from_json(x, schema)))).otherwise(F.array(own))
    rest = [c for c in df.columns if c not in schema.fieldNames() and c != CORRUPT]
    return df.select(*rest, F.explode(rows).alias("_r")).select(*[f"_r.{f.name}" for f in schema.fields], f"_r.{CORRUPT}", *rest)


def category_of_file(name_col) -> Column:
    """The category a file's name gives by itself: the name without ending and part number (``x_00003.jsonl`` -> ``x``)."""
    stem = F.regexp_replace(name_col, r"\.[A-Za-z0-9.]+$", "")
    return F.regexp_replace(stem, r"(_?part)?[_-]?[0-9]+$", "")


def read_dir(spark: SparkSession, directory: str, categories: Sequence[str] | None = None,
             max_files: int | None = None, schema: StructType | str = SFT, on_bad: str = "fail",
             with_category: Sequence[str] | bool | None = None, other: str | None = None, first: int | None = None) -> DataFrame:
    """S2 + S3 (+ S6, S8): every ``*.jsonl`` of a directory, in name order.

    ``categories`` keeps files whose name starts with one of them; the file list
    is pruned on the driver, so unmatched files are never opened. ``with_category``
    adds a ``category`` column from the file-name prefix (first match wins); rows of
    unmatched files get the category ``other``, or are left out where that is None.
    ``with_category=True`` takes every file's category from its own name. ``first`` reads the first samples of each
    file alone (S4, ``heads.read_heads``), which adds ``sample_no`` and ``line_offset``.
    """
    schema = as_schema(schema)
    paths = files.list_files(spark, directory, "*.jsonl")
    if not paths:
        raise FileNotFoundError(f"No .jsonl files found in {directory}")
    if categories is not None:
        paths = [p for p in paths if any(p.rsplit("/", 1)[-1].startswith(c) for c in categories)]
    if max_files is not None:
        paths = paths[:max_files]
    if not paths:
        return spark.createDataFrame([], StructType(list(schema.fields) + [StructField("file_name", StringType())]))
    if first is not None:
        from mixprep.sources.heads import read_heads
        df = read_heads(spark, paths, schema, first)
    else:
        df = read_jsonl(spark, paths, schema, on_bad=on_bad)
    if with_category is True:
        return df.withColumn("category", category_of_file(F.col("file_name")))
    if with_category:
        cat = category_from_name(F.col("file_name"), with_category)
        df = df.withColumn("category", cat if other is None else F.coalesce(cat, F.lit(other)))
        df = df.filter(F.col("category").isNotNull())
    return df


def read_sources(spark: SparkSession, mapping: dict[str, Sequence[str]], schema: StructType | str = SFT,
                 on_bad: str = "fail") -> DataFrame:
    """Named lists of files per category; missing files are skipped quietly."""
    schema = as_schema(schema)
    out = None
    for cat, paths in mapping.items():
        present = [p for p in paths if files.exists(spark, p)]
        if not present:
            continue
        df = read_jsonl(spark, present, schema, on_bad=on_bad).withColumn("category", F.lit(cat))
        out = df if out is None else out.unionByName(df)
    if out is None:
        return spark.createDataFrame([], StructType(list(schema.fields) + [
            StructField("file_name", StringType()), StructField("category", StringType())]))
    return out


#: Text fields of both sample forms: a key over fewer would be one and the same for all rows of the other form.
KEY_FIELDS = ("system", "prompt", "response", "instruction", "input", "output")


def with_content_key(df: DataFrame, out: str = "sample_key") -> DataFrame:
    """A row key for sources without ids: md5 of all text fields and the history.

    Equal rows share a key; ``sampling.number_copies`` then tells them apart.
    """
    none = F.lit("\u0002")
    parts = [F.coalesce(F.col(c), none) for c in KEY_FIELDS if c in df.columns]
    if "history" in df.columns:
        pairs = F.transform("history", lambda p: F.coalesce(F.array_join(p, "\u0003", "\u0002"), none))
        parts.append(F.coalesce(F.array_join(pairs, "\u0004"), none))
    return df.withColumn(out, F.md5(F.concat_ws("\u0001", *parts)))


def staged_with_ids(df: DataFrame, name: str, partition_by: str | None = None, out: str = "sample_key") -> DataFrame:
    """``df`` written once in the shared folder, with a unique id per row from its content (copies numbered)."""
    from mixprep.operators.sampling import number_copies
    from mixprep.session import stage_rows
    keyed = with_content_key(df, "_key")
    if partition_by:
        keyed = keyed.withColumn("_key", F.concat_ws(":", F.col(partition_by), F.col("_key")))
    return number_copies(stage_rows(keyed, name, partition_by), "_key", "_row", out).drop("_key", "_row")


def cap_per_file(df: DataFrame, max_samples: int | None, key: str = "sample_key", seed=42) -> DataFrame:
    """At most ``max_samples`` rows per file (the same rows under any partitioning)."""
    if max_samples is None:
        return df
    from mixprep.operators.sampling import cap_per_group
    return cap_per_group(df, max_samples, ["file_name"], key, seed=seed)


def read_landed(spark: SparkSession, path: str, categories: Sequence[str] | None = None) -> DataFrame:
    """Samples landed by ``land_parquet``; a category list becomes a partition filter."""
    df = spark.read.parquet(path)
    if categories:
        df = df.filter(F.col("category").isin(list(categories)))
    return df
