"""Task balance of the ranking/splitting operators on a skewed input, from Spark's event log.

Usage: python tools/skew_report.py [rows]   (default 2,000,000; one group holds 90% of them)
Runs hash_rank, split_eval and resample_weighted, then prints, per stage that reads a shuffle, the
largest and the median number of shuffle records read by one task. With the
hash-bucket design no task receives the hot group: max and median stay close.
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _events(path: str):
    import zstandard
    with open(path, "rb") as f:
        raw = f.read()
    if path.endswith(".zstd"):
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    for line in raw.decode("utf-8").splitlines():
        yield json.loads(line)


def main() -> None:
    from pyspark.sql import functions as F
    from mixprep.session import get_spark
    from mixprep.operators import sampling

    n = int(sys.argv[1]) if len(sys.argv) > 1 else 2_000_000
    logdir = tempfile.mkdtemp(prefix="skew-events-", dir="/tmp")
    spark = get_spark("skew-report", master="local[8]", shuffle_partitions=32,
                      extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
                             "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    df = spark.range(n).withColumn("g", F.when(F.col("id") % 10 == 0, "small").otherwise("hot"))
    weighted = df.withColumn("w", F.when(F.col("g") == "hot", 1.0).otherwise(9.0))
    for name, out in (("hash_rank", sampling.hash_rank(df, ["g"], "id")),
                      ("split_eval", sampling.split_eval(df, ["g"], "id")),
                      ("resample", sampling.resample_weighted(weighted, "w", "id", max_classes=2))):
        spark.sparkContext.setJobDescription(name)
        out.write.format("noop").mode("overwrite").save()
    spark.stop()

    per_stage: dict[int, list[int]] = {}
    desc: dict[int, str] = {}
    for f in glob.glob(os.path.join(logdir, "**", "events_*"), recursive=True) + \
            glob.glob(os.path.join(logdir, "local-*")):
        for e in _events(f):
            if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                rec = e["Task Metrics"].get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                per_stage.setdefault(e["Stage ID"], []).append(rec)
            elif e["Event"] == "SparkListenerJobStart":
                d = e.get("Properties", {}).get("spark.job.description", "")
                for s in e.get("Stage IDs", []):
                    desc[s] = d
    print(f"rows={n:,}, hot group = 90% of rows, 32 shuffle partitions")
    print("stage  job         tasks  max_records  median_records")
    for sid, recs in sorted(per_stage.items()):
        if max(recs) == 0:
            continue
        print(f"{sid:5d}  {desc.get(sid, ''):10s} {len(recs):5d}  {max(recs):11,d}  {int(statistics.median(recs)):14,d}")


if __name__ == "__main__":
    main()
