"""Item maps laid out by key once (J1-J3): bucketed tables whose joins shuffle neither map.

The reference keeps its maps in dicts and looks every item up there. A map that many runs join is written here once, dealt by the hash of its keys into files, sorted
inside; two maps dealt alike are then joined file by file, and a look-up shuffles the asking side alone. A folder tells how it is dealt, so a later
session opens it without reading it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from mixprep.functions.text import sid_token
from mixprep.operators.lookup import KEYS

#: Rows of a bucket, about.
BUCKET_ROWS = 1_000_000


def land_bucketed(df: DataFrame, path: str, keys: Sequence[str] = KEYS, buckets: int | None = None, like: str | None = None) -> DataFrame:
    """Write ``df`` at ``path`` dealt by ``keys`` and return it as a table. ``like`` names a landed map whose number of buckets is taken, so that both join without a
    shuffle; by default the number follows from the rows (counted here). Key types must agree between maps: ``pid`` becomes BIGINT."""
    spark = df.sparkSession
    df = df.withColumn("pid", F.col("pid").cast("bigint")) if "pid" in keys else df
    n = buckets or (_spec(spark, like)["buckets"] if like else max(1, -(-df.count() // BUCKET_ROWS)))
    rows = df.repartition(n, *keys).sortWithinPartitions(*keys)
    # As many tasks as buckets, dealt by the same hash: a file per bucket.
    rows.write.mode("overwrite").bucketBy(n, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(_name())
    spec = json.dumps({"buckets": n, "keys": list(keys), "schema": df.schema.json()})
    spark.range(1).select(F.lit(spec).alias("value")).coalesce(1).write.mode("overwrite").text(_beside(path))
    return open_bucketed(spark, path)


def open_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A landed map as a table that knows its buckets."""
    from pyspark.sql.types import StructType
    spec = _spec(spark, path)
    schema = StructType.fromJson(json.loads(spec["schema"]))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    keys, name = ", ".join(f"`{k}`" for k in spec["keys"]), _name()
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {spec['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def _spec(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(_beside(path)).first()["value"])


def _beside(path: str) -> str:
    return f"{path.rstrip('/')}_layout"


def _name() -> str:
    return f"mixprep_map_{uuid.uuid4().hex[:12]}"


def look_up(long_df: DataFrame, items: DataFrame, keys: Sequence[str] = KEYS, hot_rows: int = 1_000_000) -> DataFrame:
    """Rows of ``long_df`` that have an item in the landed map ``items``, with its columns; the map is not shuffled.

    A shuffle-free join cannot split a bucket, so keys asked for more than ``hot_rows`` times (counted first; one in ``hot_rows`` rows at most) are answered
    by a table of their own, broadcast if its rows are few (checked), and only the others meet the buckets.
    """
    from mixprep.operators.sampling import _checked, _join_on
    rows = long_df.withColumn("pid", F.col("pid").cast("bigint")) if "pid" in keys else long_df
    values = [c for c in items.columns if c not in keys]
    asked = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows).select(*keys)
    hot = _checked(asked, "hot-items")
    answers = _checked(items.join(hot, list(keys)).select(*keys, F.struct(*values).alias("_hot")), "hot-answers")
    cold = rows.join(hot, list(keys), "left_anti").join(items, list(keys))
    found = _join_on(rows, answers, list(keys)).select(*rows.columns, *[F.col(f"_hot.`{v}`").alias(v) for v in values])
    return cold.select(*rows.columns, *values).unionByName(found)


def sequence_lookup_bucketed(long_df: DataFrame, sids: DataFrame, user_col: str = "user_id", cap: int = 20, hot_rows: int = 1_000_000) -> DataFrame:
    """J3 (``lookup.sequence_lookup``) on a landed map."""
    j = look_up(long_df.filter(F.col("pos") < F.lit(int(cap))), sids, hot_rows=hot_rows).withColumn("token", sid_token(F.col("domain"), F.col("sid_three")))
    return j.filter(F.col("token").isNotNull()).groupBy(user_col, "domain").agg(F.sort_array(F.collect_list(F.struct("pos", "token", "ts"))).alias("seq"))
