"""Draws by a weight per row: exact against plain inverse-CDF sampling, skewed and tiny weights, frequencies."""

import bisect
import hashlib
import math
from collections import Counter
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from mixprep.operators import sampling


def picks(weights, seed=42, units=1_000_000):
    """draw id -> row id by a plain running sum over the rows in hash order."""
    h = lambda kind, i: hashlib.md5(f"{seed}:{kind}:{i}".encode()).hexdigest()
    rows = sorted(weights, key=lambda i: (h("row", i), i))
    ends = list(accumulate(math.floor((weights[i] or 0) * units + 0.5) for i in rows))
    return {i: rows[bisect.bisect_right(ends, int(h("draw", i)[:13], 16) * ends[-1] >> 52)] for i in weights} if ends and ends[-1] else {}


SHAPES = {
    "even": lambda i, n: 1.0,
    "own": lambda i, n: 0.1 + (i * 7919 % 1000) / 37,
    "one row of a third": lambda i, n: n / 2 if i == 5 else 1.0,
    "nearly all of one": lambda i, n: 1e9 if i == 17 else 1e-6,
    "many of none": lambda i, n: 0.0 if i % 10 else 3.5,
    "nulls": lambda i, n: None if i % 3 else 2.0,
}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("rows", [25, 10 ** 6])
def test_draws_by_brute_force(spark, shape, rows):
    n = 1500
    weights = {i: SHAPES[shape](i, n) for i in range(n)}
    df = spark.createDataFrame(list(weights.items()), "id long, w double").repartition(3)
    got = sampling.weighted_draws_by_row(df, "w", "id", bucket_rows=rows).collect()
    assert len(got) == n and {r.draw_id: r._mp_pick_id for r in got} == picks(weights)


def test_more_ranges_than_one_level(spark):
    n = 40_000
    df = spark.range(n).withColumn("w", F.when(F.col("id") == 3, F.lit(float(n))).otherwise(1.0))
    got = {r.draw_id: r._mp_pick_id for r in sampling.weighted_draws_by_row(df, "w", "id", bucket_rows=12).collect()}
    assert got == picks({i: float(n) if i == 3 else 1.0 for i in range(n)})


def test_no_window_holds_much_more_than_a_range(spark, monkeypatch):
    """One row has half of all weight: its draws are dealt into cells."""
    seen = []
    real = sampling._merged
    monkeypatch.setattr(sampling, "_merged", lambda a, b, cell: seen.append(a.select(*cell).unionByName(b.select(*cell)).groupBy(*cell).count()) or real(a, b, cell))
    n, rows = 8000, 50
    df = spark.range(n).withColumn("w", F.when(F.col("id") == 3, F.lit(float(n))).otherwise(1.0))
    assert sampling.weighted_draws_by_row(df, "w", "id", bucket_rows=rows).count() == n
    assert all(s.agg(F.max("count")).first()[0] <= 6 * rows for s in seen) and len(seen) == 2


def test_frequencies_within_four_sigma(spark):
    n = 20_000
    df = spark.range(n).withColumn("w", 0.5 + F.col("id") % 300 / 7.0)
    freq = Counter(r.id % 300 for r in sampling.resample_by_row(df, "w", "id").select("id").collect())
    sizes, w = Counter(i % 300 for i in range(n)), {c: 0.5 + c / 7 for c in range(300)}
    total = sum(sizes[c] * w[c] for c in w)
    late = sum(abs(freq[c] - n * sizes[c] * w[c] / total) > 4 * math.sqrt(n * sizes[c] * w[c] / total) for c in w)
    assert sum(freq.values()) == n and late == 0


def test_nothing_to_draw_and_bad_weights(spark):
    df = spark.createDataFrame([(1, 0.0), (2, None)], "id long, w double")
    assert sampling.resample_by_row(df, "w", "id").count() == 0
    assert sampling.resample_by_row(df.filter("id < 0"), "w", "id").columns == ["draw_id", "id", "w"]
    assert sampling.resample_by_row(df.filter("id < 0"), "w", "id").count() == 0
    for w in (-1.0, math.nan, math.inf, 1e300):
        with pytest.raises(Exception, match="weight"):
            sampling.resample_by_row(spark.createDataFrame([(1, 1.0), (2, w)], "id long, w double"), "w", "id").count()
