"""Scale properties of the physical plans (checked on the executed adaptive plans)."""

import re

from pyspark.sql import functions as F

from mixprep.operators import sampling


def _plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


def _skewed(spark, n=50_000):
    return spark.range(n).withColumn("g", F.when(F.col("id") % 10 == 0, "small").otherwise("hot"))


def test_split_eval_never_shuffles_rows_by_group_alone(spark):
    # the labels come from the written per-bucket table: no window, no shuffle of rows, one broadcast join
    plan = _plan(sampling.split_eval(_skewed(spark), ["g"], "id", digits=2))
    assert not any(x in plan for x in ("SortMergeJoin", "NestedLoop", "Cartesian", "Window", "Exchange hashpartitioning"))
    assert plan.count("BroadcastHashJoin") == 1


def test_ranking_with_a_limit_is_a_partial_top_k(spark):
    plan = _plan(sampling.sample_n(_skewed(spark), 5, "id", ["g"], digits=1))
    assert "WindowGroupLimit" in plan


def test_items_are_joined_once_for_both_directions(spark):
    from mixprep.plans import fixtures as fx, generate as W3
    sf = "/root/testdata/sf0.001"
    plan = _plan(W3.item_samples(fx.item_caption(spark, sf), fx.item_sid(spark, sf)))
    assert len(re.findall(r"(?:SortMerge|BroadcastHash|ShuffledHash)Join", plan)) == 2     # documents to captions, captions to ids


def test_hash_rank_and_resample_windows_use_buckets(spark):
    df = _skewed(spark)
    for out in (sampling.hash_rank(df, ["g"], "id"),
                sampling.resample_weighted(df.withColumn("w", F.when(F.col("g") == "hot", 1.0).otherwise(3.0)),
                                           "w", "id", max_classes=2)):
        plan = _plan(out)
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "EvalPython" not in plan
        specs = re.findall(r"row_number\(\) windowspecdefinition\(([^)]*?)ASC", plan)
        assert specs and all("_mp_b" in s for s in specs)


def test_profile_head_uses_partial_top_k(spark):
    from mixprep.plans import fixtures as fx
    plan = _plan(fx.behaviour_head(spark, "/root/testdata/sf0.001", 20))
    assert "WindowGroupLimit" in plan and "Partial" in plan
