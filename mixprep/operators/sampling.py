"""Deterministic ranking, sampling, splitting and weighted resampling.

The reference shuffles Python lists with a seeded generator. Here a row's place in a
shuffle is the order of ``md5('{seed}:{id}')`` (ties broken by id), which is the
same under any partitioning and any retry.

Scale: a category can hold a third of all rows, so no window here runs over more than about ``BUCKET_ROWS`` rows. Groups are
counted first. Those with more rows (at most one in ``BUCKET_ROWS`` rows of the input) are cut into ranges by as many digits of the hash as their own size
asks for; counts per range give each its offset, by prefix sums in two levels. Groups with fewer rows are one range, and
where no group is large, no range is counted at all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from mixprep.functions.hashing import hash_hex, uniform01

_H, _B, _C, _OFF, _N = "_mp_h", "_mp_b", "_mp_c", "_mp_off", "_mp_n"
_D, _E, _P, _S = "_mp_d", "_mp_ne", "_mp_p", "_mp_s"
#: Rows of a window task, about: the expected size of a range is between a 32nd and a half of it.
BUCKET_ROWS = 8_192
#: Hash digits that one level of prefix sums takes: 4096 ranges a window.
LEVEL = 3
#: Rows up to which a per-bucket table, written and counted, is broadcast (about 50 MB); beyond, a shuffled join.
BROADCAST_ROWS = 500_000


def _keys(group_cols) -> list[str]:
    if group_cols is None:
        return []
    if isinstance(group_cols, str):
        return [group_cols]
    return list(group_cols)


def _hashed(df: DataFrame, id_col: str, seed) -> DataFrame:
    return df.withColumn(_H, hash_hex(id_col, seed))


def group_sizes(df: DataFrame, keys: list[str], weight: str | None = None, bucket_rows: int | None = None) -> tuple[DataFrame, int]:
    """(group, rows, weight, ``_mp_d``: the hash digits its size asks for), written once, and the most digits of any group."""
    from pyspark.sql import Observation

    from mixprep.session import stage
    rows = bucket_rows or BUCKET_ROWS
    n = F.count(F.lit(1))
    sizes = df.groupBy(*keys).agg(n.alias(_N), (F.sum(weight) if weight else n).cast("long").alias(_S))
    # Expected rows of a range: half of ``rows`` at most, so none is above it but by the hash's chance.
    digits = F.greatest(F.lit(0), F.ceil(F.log2(F.col(_N) * (2.0 / rows)) / 4)).cast("int")
    sizes = sizes.filter(F.col(_N) > 0).withColumn(_D, F.when(F.col(_N) <= rows, 0).otherwise(digits))
    seen = Observation()
    table = stage(sizes.observe(seen, F.max(_D).alias("digits")), "group-sizes")
    return table, seen.get["digits"] or 0


def _ranged(hashed: DataFrame, sizes: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Rows with ``_mp_b``, the beginning of their hash that names their range in the group: nothing where the group is one range."""
    if not most:
        return hashed.withColumn(_B, F.substring(F.col(_H), 1, 0))
    large = _checked(sizes.filter(F.col(_D) > 0).select(*keys, _D), "large-groups")
    return _with_group(hashed, large, keys, "left").withColumn(_B, F.expr(f"substring({_H}, 1, coalesce({_D}, 0))")).drop(_D)


def range_offsets(ranged: DataFrame, keys: list[str], most: int, weight: str | None = None) -> DataFrame:
    """(group, range) -> weight, weight before the range; ranges of large groups alone. Windows run over 4096 ranges at most, in two levels
    (16.7 million ranges a group; with more, the upper level is longer) where a group has more."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counts = ranged.filter(F.length(_B) > 0).groupBy(*keys, _B).agg(n.cast("long").alias(_C))
    before = lambda *by: Window.partitionBy(*by).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(_C).over(before(*keys, _P)), F.lit(0)).cast("long")
    if most <= LEVEL:
        return counts.withColumn(_P, F.substring(F.col(_B), 1, 0)).withColumn(_OFF, inside).drop(_P)
    from mixprep.session import stage
    counts = stage(counts.withColumn(_P, F.expr(f"substring({_B}, 1, length({_B}) - {LEVEL})")), "range-counts")
    upper = counts.groupBy(*keys, _P).agg(F.sum(_C).alias("_mp_pc"))
    w = Window.partitionBy(*keys).orderBy(_P).rowsBetween(Window.unboundedPreceding, -1)
    upper = upper.select(*keys, _P, F.coalesce(F.sum("_mp_pc").over(w), F.lit(0)).cast("long").alias("_mp_po"))
    return _join_on(counts, upper, [*keys, _P]).withColumn(_OFF, F.col("_mp_po") + inside).drop(_P, "_mp_po")


def hash_rank(df: DataFrame, group_cols, id_col: str, seed=42, digits: int | None = None, out: str = "rn",
              limit: int | None = None, keep_total: str | None = None, bucket_rows: int | None = None) -> DataFrame:
    """1-based position of each row inside its group under ``md5(seed:id)``, ties by id.

    Equals ``row_number() over (partition by g order by md5(seed||':'||id), id)``.
    With ``limit``, rows of ranges that start at or after ``limit`` are dropped
    before the ranking window, so ``rank <= limit`` never sorts the rest.
    ``keep_total`` names an output column with the group's row count. ``digits`` fixes the hash digits of a range for all groups; by
    default each group's size decides. Groups are counted when this is called.
    """
    keys = _keys(group_cols)
    sizes, most = group_sizes(df, keys, bucket_rows=bucket_rows)
    if digits is not None:
        sizes, most = sizes.withColumn(_D, F.lit(int(digits))), int(digits)
    r = _ranged(_hashed(df, id_col, seed), sizes, keys, most)
    if most:
        offs = range_offsets(r, keys, most).select(*keys, _B, _OFF)
        offs = offs.filter(F.col(_OFF) < F.lit(int(limit))) if limit is not None else offs
        # Ranges of small groups are in no table; with a limit, those of large groups must be in it.
        r = _join_on(r, _checked(offs, "offsets"), [*keys, _B], "left")
        if limit is not None:
            r = r.filter((F.length(_B) == 0) | F.col(_OFF).isNotNull())
    else:
        r = r.withColumn(_OFF, F.lit(0).cast("long"))
    w = Window.partitionBy(*keys, _B).orderBy(_H, id_col)
    r = r.withColumn(out, F.row_number().over(w))
    if limit is not None:  # offsets are never negative: the rank in the range alone already bounds it (partial top-k)
        r = r.filter(F.col(out) <= F.lit(int(limit)))
    r = r.withColumn(out, (F.col(out) + F.coalesce(F.col(_OFF), F.lit(0))).cast("long"))
    if limit is not None:
        r = r.filter(F.col(out) <= F.lit(int(limit)))
    r = r.drop(_H, _B, _OFF)
    if keep_total:
        totals = sizes.select(*keys, F.col(_N).alias(keep_total))
        r = _with_group(r, _checked(totals, "totals"), keys)
    return r


def sample_n(df: DataFrame, n: int, id_col: str, group_cols=(), seed=42, digits: int | None = None) -> DataFrame:
    """R2: ``n`` rows without replacement per group (all rows when the group is smaller)."""
    return hash_rank(df, group_cols, id_col, seed=seed, digits=digits, out="_mp_rn", limit=n).drop("_mp_rn")


def cap_per_group(df: DataFrame, n: int, group_cols, id_col: str, seed=42, digits: int | None = None) -> DataFrame:
    """At most ``n`` rows per group, the same rows under any partitioning."""
    return sample_n(df, n, id_col, group_cols=group_cols, seed=seed, digits=digits)


def number_copies(df: DataFrame, key_col: str, row_col: str, out: str) -> DataFrame:
    """Unique ids from keys that repeat: ``key`` for the first row of a key, ``key#1``, ``key#2``, ... for the others.

    Copies are numbered in the order of ``md5(copy:row)``, ``row_col`` being unique (e.g. ``session.stage_rows``). Rows that
    share a key and all fields may change numbers, which changes nothing in a result. Only rows of repeated keys
    are ranked, in hash buckets, so a line repeated a billion times is spread over all tasks.
    """
    from mixprep.session import stage
    thin = df.select(key_col, row_col)
    many = stage(thin.groupBy(key_col).agg(F.count(F.lit(1)).alias(_C)).filter(F.col(_C) > 1).select(F.col(key_col).alias("_mp_key")), "repeated-keys")
    dup = thin.join(many, F.col(key_col) == F.col("_mp_key")).select(key_col, row_col)
    copy = hash_rank(dup, [key_col], row_col, seed="copy", out="_mp_rn").select(F.col(row_col).alias("_mp_row"), (F.col("_mp_rn") - 1).alias("_mp_copy"))
    j = df.join(copy, F.col(row_col) == F.col("_mp_row"), "left")
    key = F.col(key_col).cast("string")
    unique = F.when(F.col("_mp_copy") > 0, F.concat(key, F.lit("#"), F.col("_mp_copy").cast("string"))).otherwise(key)
    return j.withColumn(out, unique).drop("_mp_row", "_mp_copy")


def _checked(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once; broadcast if it has few rows, else as it is."""
    from mixprep.session import stage
    df = stage(df, name)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def cut_points(df: DataFrame, keys: list[str], id_col: str, seed, sizes: DataFrame, most: int, budget: Column, weight: str | None = None) -> DataFrame:
    """(group, ``_mp_th``, ``_mp_tid``): hash and id of the last row, in hash order, that has less than the group's budget before it.

    ``sizes`` and ``most`` are those of ``group_sizes``, ``budget`` a column over them. Two passes at most over group, id and weight: one
    adds up the ranges of large groups, if there are any; one orders the rows of the single range per group in which its budget ends.
    """
    thin = _hashed(df.select(*keys, id_col, *([weight] if weight else [])), id_col, seed)
    r = _ranged(thin, sizes, keys, most)
    budgets = sizes.select(*keys, budget.cast("long").alias(_E), F.col(_S))
    if most:
        offs = range_offsets(r, keys, most, weight)
        offs = _with_group(offs, budgets, keys)
        last = F.col(_OFF) + F.col(_C) >= F.least(F.col(_E), F.col(_S))
        edge = offs.filter((F.col(_OFF) < F.col(_E)) & last).select(*keys, _B, _OFF, _E)
        small = sizes.filter(F.col(_D) == 0).select(*keys, F.lit("").alias(_B), F.lit(0).cast("long").alias(_OFF), budget.cast("long").alias(_E))
        budgets = edge.unionByName(small)
        on = [*keys, _B]
    else:
        budgets, on = budgets.withColumn(_OFF, F.lit(0).cast("long")).drop(_S), keys
    budgets = _checked(budgets, "budgets")
    r = _with_group(r, budgets, on)
    order = Window.partitionBy(*keys, _B).orderBy(_H, id_col)
    if weight:
        before = F.coalesce(F.sum(weight).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col(_OFF)
    else:
        before = F.row_number().over(order) - 1 + F.col(_OFF)
    r = r.withColumn("_mp_before", before).filter(F.col("_mp_before") < F.col(_E))
    cut = r.groupBy(*keys).agg(F.max(F.struct(F.col(_H).alias("h"), F.col(id_col).alias("i"))).alias("_mp_cut"))
    return cut.select(*keys, F.col("_mp_cut.h").alias("_mp_th"), F.col("_mp_cut.i").alias("_mp_tid"))


def _upto(id_col: str) -> Column:
    """Rows up to the group's cut point."""
    return (F.col(_H) < F.col("_mp_th")) | ((F.col(_H) == F.col("_mp_th")) & (F.col(id_col) <= F.col("_mp_tid")))


def eval_size(ratio: float, min_eval: int, n: str = _N) -> Column:
    """``max(min_eval, int(n * ratio))``."""
    return F.greatest(F.lit(int(min_eval)).cast("long"), F.floor(F.col(n) * F.lit(float(ratio))).cast("long"))


def split_eval(df: DataFrame, group_cols, id_col: str, ratio: float = 0.05, min_eval: int = 1, seed=42,
               digits: int | None = None, out: str = "split", bucket_rows: int | None = None) -> DataFrame:
    """Per group, the first ``max(min_eval, int(n*ratio))`` shuffled rows are 'eval', the rest 'train'.

    The full rows are computed once and never shuffled. Side passes read the group and id columns (and what
    ``df`` needs to compute or filter them): one counts the groups, one finds each group's cut point, the ``(hash, id)`` of its last
    eval row (``cut_points``). The cut points, a row per group, are written, counted and broadcast if they are few; the main pass compares
    each row with that of its group. ``digits`` as in ``hash_rank``.
    """
    keys = _keys(group_cols)
    sizes, most = group_sizes(df, keys, bucket_rows=bucket_rows)
    if digits is not None:
        sizes, most = sizes.withColumn(_D, F.lit(int(digits))), int(digits)
    cuts = _checked(cut_points(df, keys, id_col, seed, sizes, most, eval_size(ratio, min_eval)), "cut-points")
    rows = _hashed(df, id_col, seed)
    j = _with_group(rows, cuts, keys)
    return j.withColumn(out, F.when(_upto(id_col), F.lit("eval")).otherwise(F.lit("train"))).drop(_H, "_mp_th", "_mp_tid")


def split_by_key(df: DataFrame, group_cols, key_col: str, ratio: float = 0.05, min_eval: int = 1, seed=42, out: str = "split",
                 bucket_rows: int | None = None) -> DataFrame:
    """R3 for rows that belong together: all rows of a group that share ``key_col`` are on one side.

    Per group, keys are taken in the order of ``md5(seed:key)`` while fewer than ``n_eval = max(min_eval, int(n*ratio))`` rows are before them. Keys
    of more than ``n_eval`` rows, and of more than the group's smallest key, are not eval keys: one of them would be most of the split.
    So the eval rows are ``n_eval`` and less than one key's more, if the other keys have that many.
    Null keys are one key.

    Rows per key are counted with map-side aggregation, so a key with a third of all rows is no large task. The
    label follows from the key's hash, its group's cut point and the list of keys too large for eval (at most ``1 / ratio`` a group, and one more
    for each that holds more rows than the smallest): full rows are never shuffled where those lists are small, which is checked.
    """
    from mixprep.session import stage
    keys = _keys(group_cols)
    name = F.coalesce(F.concat(F.lit("="), F.col(key_col).cast("string")), F.lit("")).alias("_mp_key")
    counts = stage(df.select(*keys, name).groupBy(*keys, "_mp_key").agg(F.count(F.lit(1)).alias("_mp_rows")), "keys")
    groups = counts.groupBy(*keys).agg(F.sum("_mp_rows").alias(_N), F.min("_mp_rows").alias("_mp_least"))
    groups = groups.filter(F.col(_N) > 0).select(*keys, eval_size(ratio, min_eval).alias("_mp_budget"), "_mp_least")
    groups = _checked(groups, "key-groups")
    counts = _with_group(counts, groups, keys)
    fits = F.col("_mp_rows") <= F.greatest("_mp_budget", "_mp_least")
    large = _checked(counts.filter(~fits).select(*keys, "_mp_key", F.lit(True).alias("_mp_large")), "large-keys")
    small = counts.filter(fits).select(*keys, "_mp_key", "_mp_rows")
    sizes, most = group_sizes(small, keys, weight="_mp_rows", bucket_rows=bucket_rows)
    sizes = _with_group(sizes, groups.drop("_mp_least"), keys)
    cuts = _checked(cut_points(small, keys, "_mp_key", seed, sizes, most, F.col("_mp_budget"), weight="_mp_rows"), "cut-points")
    rows = _hashed(df.withColumn("_mp_key", name), "_mp_key", seed)
    j = _with_group(rows, cuts, keys)
    j = _join_on(j, large, [*keys, "_mp_key"], "left")
    chosen = _upto("_mp_key") & F.col("_mp_large").isNull()
    return j.withColumn(out, F.when(chosen, F.lit("eval")).otherwise(F.lit("train"))).drop(_H, "_mp_th", "_mp_tid", "_mp_key", "_mp_large")


def _join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join on ``keys`` keeping the left key columns."""
    ren = {k: f"_mp_r{i}" for i, k in enumerate(keys)}
    r = right.select(*[F.col(c).alias(ren.get(c, c)) for c in right.columns])
    cond = [left[k].eqNullSafe(r[v]) for k, v in ren.items()]
    return left.join(r, cond, how).drop(*ren.values())


def _with_group(df: DataFrame, table: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Rows with the columns of their group's row in ``table``. Without keys the table has one row at most, whose values become literals."""
    if keys:
        return _join_on(df, table, keys, how)
    row = table.first()
    if row is None and how == "inner":
        df = df.filter(F.lit(False))
    return df.withColumns({f.name: F.lit(row[f.name] if row else None).cast(f.dataType) for f in table.schema})


def shuffle_order(df: DataFrame, id_col: str, seed=42) -> DataFrame:
    """The rows in seeded-shuffle order (range-partitioned sort, no single task)."""
    return df.withColumn("_mp_h", hash_hex(id_col, seed)).orderBy("_mp_h", id_col).drop("_mp_h")


def top_k_per_group(df: DataFrame, group_cols, order_cols: Sequence[Column], k: int, out: str = "rank") -> DataFrame:
    """First ``k`` rows per group (planned as WindowGroupLimit: partial top-k before the shuffle)."""
    w = Window.partitionBy(*_keys(group_cols)).orderBy(*order_cols)
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= F.lit(int(k)))


def class_weights(weights: Mapping[str, float] | Sequence[tuple[str, float]], class_col: str,
                  default: float = 1.0) -> Column:
    """Weight of a row from its category column (mode ``by_column``)."""
    items = list(weights.items()) if isinstance(weights, Mapping) else list(weights)
    c = F.col(class_col)
    expr = None
    for name, w in items:
        expr = F.when(c == F.lit(name), F.lit(float(w))) if expr is None else expr.when(c == F.lit(name), F.lit(float(w)))
    return F.lit(float(default)) if expr is None else expr.otherwise(F.lit(float(default)))


def resample_weighted(df: DataFrame, weight_col: str, id_col: str, seed=42, draw_col: str = "draw_id",
                      digits: int | None = None, max_classes: int = 64) -> DataFrame:
    """As many draws with replacement as rows, P(row) proportional to its weight.

    Rows of equal weight form a class (weights come from a short list, so there
    are few classes; more than ``max_classes`` fails the job). Draw ``i`` (one per
    input row, keyed by the row's id) picks a class with probability
    ``w_c*n_c/W`` from one uniform, then a row of that class uniformly from a
    second uniform, and fetches it with an equi-join on (class, rank), which
    spreads even a class holding most rows over all partitions. The class table
    is fetched to the driver (at most ``max_classes`` rows, checked) and becomes literals.
    """
    pairs = weighted_draws(df, weight_col, id_col, seed, draw_col, digits, max_classes)
    return pairs.join(df, pairs["_mp_pick_id"] == df[id_col], "inner").drop("_mp_pick_id")


def weighted_draws(df: DataFrame, weight_col: str, id_col: str, seed=42, draw_col: str = "draw_id", digits: int | None = None,
                   max_classes: int = 64) -> DataFrame:
    """The draws of R4 alone: (draw id, ``_mp_pick_id``: the id of the row drawn), from ids and weights."""
    w = F.col(weight_col).cast("double")
    base = df.withColumn("_mp_w", w)
    # Ranks are computed on (id, weight) only; full rows are fetched once at the end.
    slim = base.select(id_col, "_mp_w")
    ranked = hash_rank(slim, ["_mp_w"], id_col, seed=f"{seed}:row", digits=digits, out="_mp_rn")

    # The class table has one row per distinct weight: a bounded result (at most
    # max_classes rows are ever fetched, the limit is checked) that becomes literals.
    classes = (base.groupBy("_mp_w").agg(F.count(F.lit(1)).alias("_mp_nc"))
               .orderBy("_mp_w").limit(int(max_classes) + 1).collect())
    if len(classes) > max_classes:
        raise ValueError(f"resample_weighted: more than {max_classes} weight classes")
    bounds, hi = [], 0.0
    for r in classes:
        hi += float(r["_mp_w"]) * int(r["_mp_nc"])   # same left-to-right sum as the SQL window
        bounds.append((hi, float(r["_mp_w"]), int(r["_mp_nc"])))
    if not bounds:
        return df.select(F.col(id_col).alias(draw_col), F.col(id_col).alias("_mp_pick_id")).filter(F.lit(False))
    x = uniform01(draw_col, f"{seed}:class") * F.lit(bounds[-1][0])
    w_pick = n_pick = None
    for b_hi, b_w, b_n in bounds[:-1]:
        cond = x < F.lit(b_hi)
        w_pick = F.when(cond, F.lit(b_w)) if w_pick is None else w_pick.when(cond, F.lit(b_w))
        n_pick = F.when(cond, F.lit(b_n)) if n_pick is None else n_pick.when(cond, F.lit(b_n))
    last_w, last_n = F.lit(bounds[-1][1]), F.lit(bounds[-1][2]).cast("long")
    w_pick = last_w if w_pick is None else w_pick.otherwise(last_w)
    n_pick = last_n if n_pick is None else n_pick.otherwise(last_n).cast("long")
    draws = (df.select(F.col(id_col).alias(draw_col))
             .select(draw_col, w_pick.alias("_mp_dw"), n_pick.alias("_mp_n"))
             .select(draw_col, "_mp_dw",
                     F.least(F.floor(uniform01(draw_col, f"{seed}:index") * F.col("_mp_n")).cast("long") + 1,
                             F.col("_mp_n")).alias("_mp_idx")))
    return (draws.join(ranked, (draws["_mp_dw"] == ranked["_mp_w"]) & (draws["_mp_idx"] == ranked["_mp_rn"]), "inner")
            .select(draw_col, F.col(id_col).alias("_mp_pick_id")))


#: Weights become whole numbers of this fraction of one.
WEIGHT_UNITS = 1_000_000


def weight_units(weight: Column, units: int = WEIGHT_UNITS) -> Column:
    """A weight in whole units, ``floor(weight * units + 1/2)``; null is 0, a negative, infinite or undefined weight fails the job."""
    w = F.coalesce(weight.cast("double"), F.lit(0.0))
    bad = (w < 0) | F.isnan(w) | (w * float(units) >= 2.0 ** 62)
    return F.when(bad, F.raise_error(F.lit("a weight is negative, undefined or too large")).cast("bigint")).otherwise(F.floor(w * float(units) + 0.5).cast("bigint"))


def weighted_draws_by_row(df: DataFrame, weight_col: str, id_col: str, seed=42, draw_col: str = "draw_id", units: int = WEIGHT_UNITS,
                          bucket_rows: int | None = None) -> DataFrame:
    """R4 for any weights: (draw id, ``_mp_pick_id``), a draw per row with P(row) proportional to its own weight, as whole units.

    Inverse-CDF sampling in exact integers: the rows, in the order of ``md5(seed:row:id)`` and id, are laid end to end, each as long as its weight;
    draw i falls on ``x = u W div 2^52`` with u the first 52 bits of ``md5(seed:draw:id)`` and W the sum of all weights, and takes the row at x. No table of classes is
    made, and nothing of the rows reaches the driver but their number and W (which must stay below 2^63 units).

    1. Rows are cut into ranges of the hash (``group_sizes``); sums per range, in two levels, give every range its stretch, and a window within a range every row.
    2. Draws find their range: stretches and draws are dealt into equal cells of the line, a stretch into all it touches, and merged in order.
    3. They find their row the same way, in cells of a range: as many as its share of the draws asks for. So a single row with a third of
       all weight is many cells, and a range of a million weightless rows is a range like any other.

    No window holds more than about the rows of a range and the draws of a cell. Ids must be unique. Without any weight above 0 there are no draws.
    """
    from mixprep.session import stage
    rows = bucket_rows or BUCKET_ROWS
    sizes, most = group_sizes(df.select(id_col), [], bucket_rows=rows)
    thin = _hashed(df.select(F.col(id_col).alias("i"), weight_units(F.col(weight_col), units).alias("w")), "i", f"{seed}:row")
    thin = stage(_ranged(thin, sizes, [], most), "weights")
    sums = thin.groupBy(_B).agg(F.sum("w").alias("len")).filter("len > 0")
    sums = stage(sums.withColumn(_P, F.expr(f"substring({_B}, 1, greatest(0, length({_B}) - {LEVEL}))")), "weight-ranges")
    upper = sums.groupBy(_P).agg(F.sum("len").alias("_mp_pc"))
    upper = upper.select(_P, F.coalesce(F.sum("_mp_pc").over(Window.orderBy(_P).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_mp_po"))   # 4096 rows
    inside = F.sum("len").over(Window.partitionBy(_P).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1))
    n, total = (sizes.first() or {_N: 0})[_N], sums.agg(F.sum("len").alias("w")).first()["w"] or 0
    if not total:
        return df.select(F.col(id_col).alias(draw_col), F.col(id_col).alias("_mp_pick_id")).filter(F.lit(False))
    # Cells of a range: its expected draws over the rows of a window.
    cells = F.greatest(F.lit(1), F.ceil(F.col("len") / (float(total) * rows / n))).cast("bigint")
    ranges = sums.join(F.broadcast(upper), _P).select(_B, (F.coalesce(inside, F.lit(0)) + F.col("_mp_po")).alias("lo"), "len")
    ranges = ranges.select(_B, "lo", "len", F.ceil(F.col("len") / cells).cast("bigint").alias("cell"))
    ranges = stage(ranges, "stretches")

    u = F.conv(F.substring(hash_hex(draw_col, f"{seed}:draw"), 1, 13), 16, 10).cast("decimal(16,0)")
    draws = df.select(F.col(id_col).alias(draw_col)).withColumn("u", u).select(draw_col, F.expr(f"u * cast({total} as decimal(19,0)) div 4503599627370496").alias("x"))
    if most:
        width = -(-int(total) // max(1, -(-n // rows)))
        spread = ranges.select(F.explode(F.sequence(F.expr(f"lo div {width}"), F.expr(f"(lo + len - 1) div {width}"))).alias("at"), _B, "lo", "cell")
        draws = _merged(spread.select("at", F.greatest("lo", F.expr(f"at * {width}")).alias("pos"), F.struct(_B, "lo", "cell").alias("hit")),
                        draws.select(F.expr(f"x div {width}").alias("at"), F.col("x").alias("pos"), F.struct(draw_col, "x").alias("draw")), ["at"])
        draws = draws.select("draw.*", "hit.*")
    else:
        draws = _with_group(draws, ranges.select(_B, "lo", "cell"), [])
    draws = draws.select(draw_col, _B, (F.col("x") - F.col("lo")).alias("x"), "cell")

    own = F.coalesce(F.sum("w").over(Window.partitionBy(_B).orderBy(_H, "i").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = thin.withColumn("own", own).filter("w > 0")
    placed = _with_group(placed, ranges.select(_B, "cell"), [_B]) if most else _with_group(placed, ranges.select("cell"), [])
    placed = placed.select(_B, F.explode(F.sequence(F.expr("own div cell"), F.expr("(own + w - 1) div cell"))).alias("at"), "own", "cell", "i")
    found = _merged(placed.select(_B, "at", F.greatest("own", F.col("at") * F.col("cell")).alias("pos"), F.struct("i").alias("hit")),
                    draws.select(_B, F.expr("x div cell").alias("at"), F.col("x").alias("pos"), F.struct(draw_col).alias("draw")), [_B, "at"])
    return found.select(f"draw.{draw_col}", F.col("hit.i").alias("_mp_pick_id"))


def _merged(stretches: DataFrame, draws: DataFrame, cell: list[str]) -> DataFrame:
    """(draw, hit): each draw of a cell with the last stretch that begins at or before it (``pos``): one ordered pass over both, no pairs."""
    both = stretches.select(*cell, "pos", F.lit(0).alias("kind"), "hit").unionByName(draws.select(*cell, "pos", F.lit(1).alias("kind"), "draw"), allowMissingColumns=True)
    w = Window.partitionBy(*cell).orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn("hit", F.last("hit", ignorenulls=True).over(w)).filter("kind = 1").select("draw", "hit")


def resample_by_row(df: DataFrame, weight_col: str, id_col: str, seed=42, draw_col: str = "draw_id", units: int = WEIGHT_UNITS) -> DataFrame:
    """R4 with a weight per row: as many draws with replacement as rows, with the drawn rows' columns (``weighted_draws_by_row``)."""
    pairs = weighted_draws_by_row(df, weight_col, id_col, seed, draw_col, units)
    return pairs.join(df, pairs["_mp_pick_id"] == df[id_col], "inner").drop("_mp_pick_id")
