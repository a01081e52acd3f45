"""Item look-ups (J1-J4) and the profile long form.

The reference keeps the whole item->sid table in a Python dict. Here every look-up
is one equi-join on ``(pid, domain)``; the strategy (broadcast, shuffled hash,
sort-merge with skew splitting) is left to AQE, which sees the real sizes.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from mixprep.functions.text import sid_token

KEYS = ["pid", "domain"]


def join_items(captions: DataFrame, sids: DataFrame, keys=KEYS) -> DataFrame:
    """Captions that have a semantic ID, with ``token`` rendered."""
    s = sids.select(*keys, "sid_three")
    j = captions.join(s, list(keys), "inner")
    return j.withColumn("token", sid_token(F.col("domain"), F.col("sid_three"))).filter(F.col("token").isNotNull())


def semi_items(captions: DataFrame, sids: DataFrame, keys=KEYS) -> DataFrame:
    """Membership only (``k in pid2sid``)."""
    return captions.join(sids.select(*keys), list(keys), "left_semi")


def profile_to_long(profile: DataFrame, lists: Mapping[str, str], times: Mapping[str, str] | None = None,
                    user_col: str = "user_id", cap: int | None = None) -> DataFrame:
    """S9 + S10 + J4: wide list columns -> ``(user, domain, pos, pid, ts)`` in one pass.

    Only the named list columns are read (column pruning reaches the scan). A NULL
    or empty list yields no rows. Each list is cut to ``cap`` *before* anything
    else (NULL entries count, as in the reference's ``pids[:20]``), a time list
    is zipped with its item list so each time stays with its item through the
    look-up, and all domains are concatenated into one array that is exploded
    once: one scan, one generator, no union of re-computed branches.
    """
    time_of = {dom: col for col, dom in (times or {}).items()}
    parts = []
    for col, dom in lists.items():
        pids = F.coalesce(F.col(col), F.array().cast("array<bigint>"))
        if dom in time_of:
            ts = F.coalesce(F.col(time_of[dom]), F.array().cast("array<bigint>"))
            z = F.arrays_zip(pids.cast("array<bigint>").alias("pid"), ts.cast("array<bigint>").alias("ts"))
        else:
            z = F.transform(pids, lambda p: F.struct(p.cast("bigint").alias("pid"),
                                                     F.lit(None).cast("bigint").alias("ts")))
        if cap is not None:
            z = F.slice(z, 1, int(cap))
        parts.append(F.transform(z, _tag(dom)))
    every = F.filter(F.concat(*parts), lambda e: e["pid"].isNotNull())
    e = profile.select(F.col(user_col), F.explode(every).alias("e"))
    return e.select(user_col, F.col("e.domain").alias("domain"), F.col("e.pos").alias("pos"),
                    F.col("e.pid").alias("pid"), F.col("e.ts").alias("ts"))


def _tag(dom: str):
    def make(e, i):
        return F.struct(F.lit(dom).alias("domain"), i.cast("int").alias("pos"), e["pid"].alias("pid"),
                        e["ts"].alias("ts"))
    return make


def sequence_lookup(long_df: DataFrame, sids: DataFrame, user_col: str = "user_id", cap: int = 20) -> DataFrame:
    """Per (user, domain), the first ``cap`` items looked up in order, misses dropped.

    One equi-join for all domains; the regroup collects at most ``cap`` structs per
    (user, domain), sorted by position (``collect_list`` order is undefined).
    Output: ``user, domain, seq: array<struct<pos, token, ts>>``.
    """
    l = long_df.filter(F.col("pos") < F.lit(int(cap))).withColumn("pid", F.col("pid").cast("bigint"))
    s = sids.select(F.col("pid").cast("bigint").alias("pid"), "domain", "sid_three")
    j = l.join(s, KEYS, "inner").withColumn("token", sid_token(F.col("domain"), F.col("sid_three")))
    j = j.filter(F.col("token").isNotNull())
    return (j.groupBy(user_col, "domain")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "token", "ts"))).alias("seq")))


def _is_domain(dom: str):
    def pred(x):
        return x["domain"] == F.lit(dom)
    return pred


def user_token_lists(seq: DataFrame, domains: Mapping[str, str], user_col: str = "user_id") -> DataFrame:
    """Pivot J3's output to one row per user with one token array (and struct array) per domain.

    ``domains`` maps output name -> domain. A user has at most one row per domain,
    so the collected list holds at most ``len(domains)`` entries; ``collect_list``
    runs as a hash-based object aggregation with partial aggregation (no sort).
    """
    u = seq.groupBy(user_col).agg(F.collect_list(F.struct("domain", "seq")).alias("_mp_d"))
    cols = [F.col(user_col)]
    for name, dom in domains.items():
        got = F.get(F.filter("_mp_d", _is_domain(dom)), 0)["seq"]
        sq = F.coalesce(got, F.array().cast("array<struct<pos:int,token:string,ts:bigint>>"))
        cols += [sq.alias(f"{name}_seq"), F.transform(sq, lambda e: e["token"]).alias(f"{name}_tokens")]
    return u.select(*cols)
