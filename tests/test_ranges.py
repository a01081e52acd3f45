"""Ranges sized by the data: no window above a set number of rows at any skew, the same results; splits by a key that rows share."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from mixprep.operators import sampling


def order(ids, seed=42):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))


def groups(spark, n, hot=0.9, few=40):
    """One group with ``hot`` of all rows, many small ones and a null one."""
    g = F.when(F.col("id") % 100 < 100 * hot, "hot").when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("g"), (F.col("id") % few).cast("string")))
    return spark.range(n).withColumn("g", g)


@pytest.mark.parametrize("rows", [40, 300, 10 ** 6])
def test_rank_is_the_same_at_every_range_size(spark, rows):
    df = groups(spark, 6000)
    want = {}
    by = defaultdict(list)
    for r in df.collect():
        by[r.g].append(r.id)
    for ids in by.values():
        want |= {i: k for k, i in enumerate(order(ids), 1)}
    got = sampling.hash_rank(df, ["g"], "id", bucket_rows=rows, keep_total="n").collect()
    assert {r.id: r.rn for r in got} == want and all(r.n == len(by[r.g]) for r in got)
    for limit in (1, 17, 2000):
        kept = sampling.hash_rank(df, ["g"], "id", bucket_rows=rows, limit=limit).collect()
        assert {r.id: r.rn for r in kept} == {i: k for i, k in want.items() if k <= limit}
    one = sampling.hash_rank(df, [], "id", bucket_rows=rows, keep_total="n").collect()
    assert {r.id: r.rn for r in one} == {i: k for k, i in enumerate(order(range(6000)), 1)} and {r.n for r in one} == {6000}


@pytest.mark.parametrize("n, rows", [(60_000, 20), (20_000, 500)])
def test_no_window_task_above_the_set_number_of_rows(spark, n, rows):
    """90 % of all rows in one group; 20 rows a range make more than the 4096 ranges of one level."""
    df = groups(spark, n)
    sizes, most = sampling.group_sizes(df, ["g"], bucket_rows=rows)
    assert most == (4 if rows == 20 else 2)
    ranged = sampling._ranged(sampling._hashed(df, "id", 42), sizes, ["g"], most)
    largest = ranged.groupBy("g", "_mp_b").count().agg(F.max("count")).first()[0]
    assert largest <= 2 * rows
    offsets = sampling.range_offsets(ranged, ["g"], most)
    want, seen = defaultdict(int), 0
    for r in sorted(offsets.filter("g = 'hot'").collect(), key=lambda r: r["_mp_b"]):
        assert r["_mp_off"] == seen
        seen += r["_mp_c"]
    assert seen == df.filter("g = 'hot'").count()
    plan = offsets._jdf.queryExecution().toString()
    assert ("_mp_p#" in plan) and not any(x in plan for x in ("CartesianProduct", "NestedLoop"))


@pytest.mark.parametrize("rows", [30, 10 ** 6])
def test_split_is_the_same_at_every_range_size(spark, rows):
    df = groups(spark, 4000)
    by = defaultdict(list)
    for r in df.collect():
        by[r.g].append(r.id)
    want = {i for ids in by.values() for i in order(ids)[:max(1, int(len(ids) * 0.05))]}
    out = sampling.split_eval(df, ["g"], "id", bucket_rows=rows).collect()
    assert {r.id for r in out if r.split == "eval"} == want and len(out) == 4000
    out = sampling.split_eval(df, [], "id", ratio=0.2, bucket_rows=rows).collect()
    assert {r.id for r in out if r.split == "eval"} == set(order(range(4000))[:800])
    everything = sampling.split_eval(df, ["g"], "id", ratio=1.0, bucket_rows=rows)
    assert everything.filter("split = 'train'").count() == 0


def split_of(rows, ratio=0.05, seed=42):
    """(group, key, row) -> eval row numbers by the rule, one key after another."""
    out = set()
    by = defaultdict(lambda: defaultdict(list))
    for g, key, i in rows:
        by[g]["" if key is None else f"={key}"].append(i)
    for keys in by.values():
        n = sum(map(len, keys.values()))
        budget, before = max(1, int(n * ratio)), 0
        for k in order([k for k in keys if len(keys[k]) <= max(budget, min(map(len, keys.values())))], seed):
            if before >= budget:
                break
            out |= set(keys[k])
            before += len(keys[k])
    return out


@pytest.mark.parametrize("rows", [8, 10 ** 6])
def test_split_by_key_by_brute_force(spark, rows):
    data = []
    for i in range(3000):
        g = ("a", "b", None)[i % 3]
        key = None if i % 41 == 0 else 7 if i % 3 == 0 and i % 2 else i // 2 % 400 if g == "b" else i // 9
        data.append((g, key, i))
    df = spark.createDataFrame(data, "g string, key int, id int")
    out = sampling.split_by_key(df, ["g"], "key", bucket_rows=rows).collect()
    assert {r.id for r in out if r.split == "eval"} == split_of(data) and len(out) == 3000
    sides = defaultdict(set)
    for r in out:
        sides[r.g, r.key].add(r.split)
    assert all(len(s) == 1 for s in sides.values())
    for g in ("a", "b", None):
        n, n_eval = sum(r.g == g for r in out), sum(r.g == g and r.split == "eval" for r in out)
        assert int(n * 0.05) <= n_eval < 2 * int(n * 0.05)
    out = sampling.split_by_key(df, [], "key", ratio=0.1, bucket_rows=rows).collect()
    assert {r.id for r in out if r.split == "eval"} == split_of([(0, k, i) for _, k, i in data], 0.1)


def test_split_by_key_edges(spark, monkeypatch):
    monkeypatch.setattr(sampling, "BROADCAST_ROWS", 1)
    df = spark.createDataFrame([("one", 1, i) for i in range(30)] + [("two", i // 2, 100 + i) for i in range(8)], "g string, key int, id int")
    out = sampling.split_by_key(df, ["g"], "key").collect()
    assert Counter((r.g, r.split) for r in out) == {("one", "eval"): 30, ("two", "eval"): 2, ("two", "train"): 6}   # a group of one key has only that to give
    assert sampling.split_by_key(df.filter("id < 0"), ["g"], "key").count() == 0
    assert sampling.split_by_key(df.filter("id < 0"), [], "key").count() == 0
