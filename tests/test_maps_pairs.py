"""Bucketed item maps without an exchange, growing maps in two arrivals, and conversations cut into stretches."""

import pytest
from pyspark.sql import functions as F

from mixprep.operators import lookup
from mixprep.operators.normalize import chat_pairs, chat_to_alpaca
from mixprep.session import scratch_path
from mixprep.sources import item_maps
from mixprep.sources.keyed import read_keyed_last
from mixprep.streaming.keyed_map import GrowingMap

NO_BROADCAST = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture()
def shuffled_joins(spark):
    spark.conf.set(NO_BROADCAST, "-1")
    yield
    spark.conf.unset(NO_BROADCAST)


@pytest.fixture(scope="module")
def maps(spark):
    sids = spark.range(5000).select(F.col("id").alias("pid"), F.when(F.col("id") % 2 == 0, "goods").otherwise("live").alias("domain"),
                                    F.array(F.col("id").cast("int"), F.lit(1), F.lit(2)).alias("sid_three"))
    captions = spark.range(0, 6000, 3).select(F.col("id").cast("int").alias("pid"), F.when(F.col("id") % 2 == 0, "goods").otherwise("live").alias("domain"),
                                              F.concat(F.lit("c"), F.col("id").cast("string")).alias("caption"))
    root = scratch_path(spark, "t-maps")
    a = item_maps.land_bucketed(sids, f"{root}/sid", buckets=6)
    b = item_maps.land_bucketed(captions, f"{root}/caption", like=f"{root}/sid")
    return root, sids, captions, a, b


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


def test_landed_maps_join_without_an_exchange(spark, maps, shuffled_joins):
    root, sids, captions, a, b = maps
    joined = lookup.join_items(b, a)
    assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, lookup.join_items(captions.withColumn("pid", F.col("pid").cast("bigint")), sids).collect()))
    assert "Exchange" not in plan(lookup.semi_items(b, a)) and lookup.semi_items(b, a).count() == lookup.semi_items(captions, sids).count()
    again = lookup.join_items(item_maps.open_bucketed(spark, f"{root}/caption"), item_maps.open_bucketed(spark, f"{root}/sid"))    # as a later session does
    assert "Exchange" not in plan(again) and again.count() == joined.count()


def test_one_file_a_bucket(spark, maps):
    from mixprep.sources.files import list_files
    assert len(list_files(spark, f"{maps[0]}/sid", "*.parquet")) <= 6


@pytest.mark.parametrize("hot_rows", [3, 10 ** 6])
def test_look_up_shuffles_the_asking_side_alone(spark, maps, shuffled_joins, hot_rows):
    """A third of all rows ask for one item."""
    _, sids, _, a, _ = maps
    asked = spark.range(3000).select((F.col("id") % 40).alias("user_id"), F.when(F.col("id") % 3 == 0, 8).otherwise(F.col("id") * 2).alias("pid"),
                                     F.when(F.col("id") % 7 == 0, "live").otherwise("goods").alias("domain"),
                                     (F.col("id") / 40).cast("int").alias("pos"), F.lit(None).cast("bigint").alias("ts"))
    got = item_maps.look_up(asked, a, hot_rows=hot_rows)
    want = asked.join(sids, ["pid", "domain"]).select(*asked.columns, "sid_three")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    seq = item_maps.sequence_lookup_bucketed(asked, a, cap=20, hot_rows=hot_rows)
    assert sorted(map(str, seq.collect())) == sorted(map(str, lookup.sequence_lookup(asked, sids, cap=20).collect()))
    joins = [line for line in plan(got).splitlines() if "Exchange hashpartitioning" in line]
    assert all("sid_three" not in line for line in joins)
    scans = [line for line in plan(got).splitlines() if "FileScan parquet" in line and "sid_three" in line and "mixprep_map" in line]
    assert any("Bucketed: true" in line for line in scans)


def arrive(rows, spark, root, name):
    from mixprep.sources import files
    spark.createDataFrame(rows, "pid int, domain string, v string").coalesce(1).write.parquet(f"{root}/in-{name}")
    files.rename(spark, files.list_files(spark, f"{root}/in-{name}", "part-*")[0], f"{root}/map/{name}.parquet")


def test_two_arrivals_equal_one_full_read(spark):
    root = scratch_path(spark, "t-growing")
    make = lambda: GrowingMap(spark, f"{root}/map", f"{root}/state", ["pid", "domain"], ["v"], "pid int, domain string, v string", {"pid": "bigint"})
    spark.range(0).write.parquet(f"{root}/map/.none")
    assert make().table().count() == 0
    full = lambda: sorted(map(tuple, read_keyed_last(spark, f"{root}/map", ["pid", "domain"], ["v"], key_casts={"pid": "bigint"}).filter("pid is not null and domain is not null and v is not null").collect()))
    arrive([(i % 50, "g", f"m{i}") for i in range(200)] + [(None, "g", "n1"), (7, None, "n2")], spark, root, "m")
    make().refresh()
    assert sorted(map(tuple, make().table().filter("pid is not null and domain is not null").collect())) == [r for r in full() if None not in r]
    arrive([(i, "g", None if i == 3 else f"z{i}") for i in range(10)], spark, root, "z")       # later names win, a null value too
    arrive([(i, "g", f"a{i}") for i in range(40, 70)], spark, root, "a")                      # earlier names do not, but for new keys
    make().refresh(max_files=1)                                                               # started again from its checkpoint
    got = {(r.pid, r.domain): r.v for r in make().table().collect()}
    assert got[3, "g"] is None and got[4, "g"] == "z4" and got[45, "g"] == "m195" and got[65, "g"] == "a65" and got[None, "g"] == "n1" and got[7, None] == "n2"
    assert sorted((k, d, v) for (k, d), v in got.items() if None not in (k, d, v)) == [r for r in full() if None not in r]
    before = len(list(spark.read.parquet(f"{root}/state/changed").select("batch").distinct().collect()))
    make().refresh()                                                                          # nothing new, nothing read
    assert len(list(spark.read.parquet(f"{root}/state/changed").select("batch").distinct().collect())) == before


def pairs_of(rows):
    """(conv, turn, u, a, is_last) one conversation after another."""
    out = []
    for c in {r[0] for r in rows if r[0] is not None}:
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: r[1])
        found = [(c, a[1], a[3], b[3]) for a, b in zip(mine, mine[1:]) if a[2] == "user" and b[2] == "assistant"]
        out += [(*p, p == found[-1]) for p in found]
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 5, 30])
def test_pairs_of_a_conversation_over_many_stretches(spark, parts):
    rows = [(1, t, ("user", "assistant", "user")[t % 3], f"one {t}") for t in range(1000)]
    rows += [(c, t, ("system", "user", "assistant", "user", "assistant")[t % 5], f"{c} {t}") for c in range(2, 400) for t in range(c % 7)] + [(None, 1, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").repartition(3)
    got = chat_pairs(df, parts=parts)
    assert sorted(map(tuple, got.collect())) == pairs_of(rows)
    alpaca = {r.conv_id: (r.input, r.output, len(r.history or [])) for r in chat_to_alpaca(df).collect()}
    last = {r.conv_id: (r.u, r.a) for r in got.filter("is_last").collect()}
    assert {c: v[:2] for c, v in alpaca.items()} == last


def test_a_conversation_with_most_turns_is_many_tasks(spark):
    df = spark.range(20_000).select(F.when(F.col("id") < 15_000, 1).otherwise(F.col("id")).alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.col("id").cast("string").alias("text"))
    seen = []
    from mixprep import session
    real = session.stage
    session.stage = lambda d, name: seen.append((name, real(d, name))) or seen[-1][1]
    try:
        assert chat_pairs(df, parts=20).count() == 7_500
    finally:
        session.stage = real
    sizes = {r.part: r["count"] for r in dict(seen)["stretches"].filter("c = 1").groupBy("part").count().collect()}
    assert len(sizes) >= 10 and max(sizes.values()) < 3_000
    assert chat_pairs(df.filter("turn < 0")).count() == 0
