"""Session helpers: a tuned local/cluster session and shared scratch folders."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings that every job of this package relies on; cluster launchers may
# override the sizes, never the semantics (UTC, ANSI, AQE).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Sizes for a large cluster (~1000 executors, ~100 TB of input): start every shuffle
# wide and let AQE coalesce to ~256 MB partitions; split skewed join partitions;
# read ~256 MB per scan task; broadcast only what AQE measures below 64 MB.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "-1",      # no broadcast from static estimates
}


def get_spark(app: str = "mixprep", master: str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None,
              profile: str = "local") -> SparkSession:
    """Session with the package's settings; ``profile='cluster'`` adds ``CLUSTER_CONF``."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    for k, v in conf.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str = "/tmp/mixprep-checkpoints") -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    A folder of our own is set only when a local session has none. On a cluster a folder of one machine
    would hold only what that machine's executors write, so there an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf and not (sc.master or "").split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(conf or fallback)
    return sc.getCheckpointDir()


def ship_code(spark: SparkSession) -> None:
    """Send this package's code to the executors, once a context, so that Python tasks need not have it installed."""
    import os
    import tempfile
    import zipfile
    sc = spark.sparkContext
    if getattr(sc, "mixprep_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    name = os.path.join(tempfile.mkdtemp(prefix="mixprep-"), "mixprep_code.zip")     # the code alone; addPyFile copies it to every executor
    with zipfile.ZipFile(name, "w") as z:
        for folder, _, names in os.walk(root):
            for f in names:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.join("mixprep", os.path.relpath(path, root)))
    sc.addPyFile(name)
    sc.mixprep_shipped = True


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    _SCRATCH.append(f"{base}/mixprep-{name}-{uuid.uuid4().hex[:12]}")
    return _SCRATCH[-1]


def remove_scratch(spark: SparkSession, keep: int = 0) -> int:
    """Delete the scratch folders this process has asked for after the first ``keep``; nothing lazy may read them any more.

    The command line calls it when a command has written its output.
    """
    n = 0
    while len(_SCRATCH) > keep:
        path = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        n += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return n


def stage(df, name: str):
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    Used where a plan reads the same input several times: the input is computed
    once, lineage is cut (a lost executor re-reads files), and later passes that
    need few columns read only those.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stage_rows(df, name: str, partition_by: str | None = None, row_col: str = "_row"):
    """``stage`` with a unique row id: the name of the staged file and the row in it, the same in every later pass.

    ``partition_by`` lays the copy out by a column, so a filter on it reads only its folders.
    """
    from pyspark.sql import functions as F
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = df.write.mode("overwrite")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    schema = df.schema
    back = spark.read.schema(schema).parquet(path)
    at = F.concat_ws("/", *([F.col(partition_by).cast("string")] if partition_by else []), F.col("_metadata.file_name"), F.col("_metadata.row_index").cast("string"))
    return back.select(*df.columns, at.alias(row_col))
