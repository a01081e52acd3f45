"""Ranking, sampling, splitting, resampling: golden counts, invariants, distribution."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mixprep.operators import sampling

# (rows, eval) pairs published for the reference's mixtures (int(n*0.05), at least 1).
GOLDEN = [(14989, 749), (10384, 519), (995, 49), (30000, 1500), (2892, 144), (30384, 1519), (22892, 1144),
          (39204, 1960), (60000, 3000), (20000, 1000), (1, 1), (19, 1), (20, 1), (40, 2)]


@pytest.mark.parametrize("n,n_eval", GOLDEN)
def test_split_eval_golden_counts(spark, n, n_eval):
    df = spark.range(n).withColumn("g", F.lit("c"))
    out = sampling.split_eval(df, ["g"], "id")
    c = dict((r[0], r[1]) for r in out.groupBy("split").count().collect())
    assert c.get("eval", 0) == n_eval and c.get("train", 0) == n - n_eval


def test_split_disjoint_complete_and_partition_independent(spark):
    df = spark.range(5000).withColumn("g", (F.col("id") % 3).cast("string"))
    a = {(r.id, r.split) for r in sampling.split_eval(df, ["g"], "id").collect()}
    b = {(r.id, r.split) for r in sampling.split_eval(df.repartition(7), ["g"], "id").collect()}
    assert a == b and len(a) == 5000 and len({i for i, _ in a}) == 5000


def test_empty_group_gives_no_rows(spark):
    df = spark.range(10).withColumn("g", F.lit("c")).filter("id < 0")
    assert sampling.split_eval(df, ["g"], "id").count() == 0


def test_hash_rank_is_a_permutation_matching_brute_force(spark):
    import hashlib
    df = spark.range(3000).withColumn("g", (F.col("id") % 2).cast("string"))
    got = {(r.id, r.rn) for r in sampling.hash_rank(df, ["g"], "id", seed=7, digits=2).collect()}
    exp = set()
    for g in (0, 1):
        ids = sorted((i for i in range(3000) if i % 2 == g), key=lambda i: (hashlib.md5(f"7:{i}".encode()).hexdigest(), i))
        exp |= {(i, k + 1) for k, i in enumerate(ids)}
    assert got == exp


def test_hash_rank_null_group_and_global(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id long, g string")
    r = sorted((x.g, x.rn) for x in sampling.hash_rank(df, ["g"], "id").collect() if x.g is None)
    assert [rn for _, rn in r] == [1, 2]
    assert sorted(x.rn for x in sampling.hash_rank(df, [], "id").collect()) == [1, 2, 3]


def test_sample_n_small_group_keeps_all(spark):
    df = spark.range(100).withColumn("g", F.when(F.col("id") < 5, "small").otherwise("big"))
    c = dict((r[0], r[1]) for r in sampling.sample_n(df, 10, "id", ["g"]).groupBy("g").count().collect())
    assert c == {"small": 5, "big": 10}


def test_resample_size_and_class_frequencies(spark):
    n = 20000
    df = spark.range(n).withColumn("cat", F.when(F.col("id") % 10 < 5, "a").when(F.col("id") % 10 < 8, "b").otherwise("c"))
    weights = [("a", 1.0), ("b", 2.0), ("c", 5.0)]
    df = df.withColumn("w", sampling.class_weights(weights, "cat"))
    out = sampling.resample_weighted(df, "w", "id", max_classes=4)
    rows = out.select("draw_id", "cat").collect()
    assert len(rows) == n and len({r.draw_id for r in rows}) == n
    freq = Counter(r.cat for r in rows)
    nc = {"a": n * 0.5, "b": n * 0.3, "c": n * 0.2}
    W = sum(nc[c] * w for c, w in weights)
    for c, w in weights:
        p = nc[c] * w / W
        assert abs(freq[c] - n * p) <= 4 * math.sqrt(n * p * (1 - p))


def test_recipe_observation_counts_per_source(spark):
    from pyspark.sql import Observation
    from mixprep.plans.mix import Recipe, Source, run_recipe
    a = spark.range(100).select(F.col("id"), F.lit("s").alias("system"), F.lit("p").alias("prompt"),
                                F.lit("r").alias("response"))
    b = spark.range(10).select(F.col("id"), F.lit("s").alias("system"), F.repeat(F.lit("x"), 60).alias("prompt"),
                               F.lit("r").alias("response"))
    obs = Observation("funnel")
    out = run_recipe(Recipe([Source("a", a, "id", fmt="sft", max_char=50), Source("b", b, "id", fmt="sft", max_char=50)]),
                     observation=obs)
    assert out.count() == 100
    assert obs.get == {"a": 100, "b": 0}


def test_skewed_group_split_rank_and_resample(spark):
    """One group holds 90% of the rows: results stay exact."""
    n = 200_000
    df = spark.range(n).withColumn("g", F.when(F.col("id") % 10 == 0, "small").otherwise("hot"))
    c = {(r.g, r.split): r["count"] for r in sampling.split_eval(df, ["g"], "id")
         .groupBy("g", "split").count().collect()}
    assert c[("hot", "eval")] == int(180_000 * 0.05) and c[("small", "eval")] == int(20_000 * 0.05)
    r = sampling.hash_rank(df, ["g"], "id").groupBy("g").agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).collect()
    assert {(x[0], x[1], x[2], x[3]) for x in r} == {("hot", 1, 180_000, 180_000), ("small", 1, 20_000, 20_000)}
    s = sampling.resample_weighted(df.withColumn("w", F.when(F.col("g") == "hot", 1.0).otherwise(9.0)), "w", "id",
                                   max_classes=2)
    assert s.count() == n


def test_copies_are_numbered_once_each(spark):
    """One key has 90 % of the rows: all get ids of their own, and the split of them is exact."""
    df = spark.range(20_000).withColumn("key", F.when(F.col("id") % 10 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")))
    ids = sampling.number_copies(df, "key", "id", "uid")
    assert ids.count() == 20_000 and ids.select("uid").distinct().count() == 20_000
    hot = {r.uid for r in ids.filter("key = 'hot'").collect()}
    assert hot == {"hot"} | {f"hot#{i}" for i in range(1, 18_000)}
    split = sampling.split_eval(ids.withColumn("g", F.lit("x")), ["g"], "uid")
    assert split.filter("split = 'eval'").count() == 1_000


def test_result_does_not_depend_on_which_copy_got_which_number(spark):
    rows = [("a", "x")] * 30 + [("b", "y")] * 5 + [(f"k{i}", "z") for i in range(40)]
    sets = []
    for order in (1, -1):
        df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(rows[::order])], "key string, v string, row long")
        out = sampling.split_eval(sampling.number_copies(df, "key", "row", "uid").withColumn("g", F.lit(0)), ["g"], "uid", ratio=0.3)
        sets.append(Counter((r.key, r.v, r.split) for r in out.collect()))
    assert sets[0] == sets[1]


def test_a_large_bucket_table_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(sampling, "BROADCAST_ROWS", 10)
    df = spark.range(5000).withColumn("g", (F.col("id") % 50).cast("string"))
    out = sampling.split_eval(df, ["g"], "id")
    assert out.filter("split = 'eval'").count() == 50 * 5


def test_scratch_is_removed_and_a_cluster_needs_a_shared_folder(spark):
    from mixprep import session
    before = len(session._SCRATCH)
    path = session.scratch_path(spark, "t-remove")
    spark.range(3).write.parquet(path)
    assert session.remove_scratch(spark, keep=before) == 1 and len(session._SCRATCH) == before

    class Fake:
        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda k, d=None: d)
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Fake)
