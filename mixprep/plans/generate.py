"""Generate item and user samples from the item maps and the user profile.

Plan: item captions JOIN item sids (one equi-join) -> G1, G2; profile long form
(lists cut to 20 before exploding) JOIN item sids (one equi-join for all four
domains) -> regroup per (user, domain) -> pivot per user -> G3, G4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mixprep.operators import generate as G
from mixprep.operators.lookup import join_items, sequence_lookup, user_token_lists

SAMPLE_COLS = ["task", "key", "system", "prompt", "response"]


def item_samples(captions: DataFrame, sids: DataFrame, max_per_task: int | None = None, seed=42) -> DataFrame:
    items = G.cap_items(join_items(captions, sids), max_per_task, seed=seed)
    key = F.concat(F.col("domain"), F.lit(":"), F.col("pid").cast("string")).alias("key")
    return G.item_tasks(items, G.desc_to_token(), G.token_to_desc()).select("task", key, "system", "prompt", "response")


def user_table(long_df: DataFrame, sids: DataFrame, cap: int = 20, user_col: str = "user_id") -> DataFrame:
    seq = sequence_lookup(long_df, sids, user_col=user_col, cap=cap)
    return user_token_lists(seq, G.USER_DOMAINS, user_col=user_col)


def user_samples(long_df: DataFrame, sids: DataFrame, min_tokens: int = 3, max_users: int | None = None,
                 cap: int = 20, user_col: str = "user_id", seed=42, stage_users: bool = True,
                 order: str = "by_domain") -> tuple[DataFrame, DataFrame]:
    """G3 + G4 from one per-user token table; ``order`` is that of the events of G3.

    With ``stage_users`` the table (one row per eligible user, at most 80 tokens)
    is written once to the shared checkpoint folder, so the profile explode, the
    look-up join and the regroup run once for both generators.
    """
    users = G.eligible_users(user_table(long_df, sids, cap, user_col), min_tokens, max_users, user_col, seed)
    if stage_users:
        from mixprep.session import stage
        users = stage(users, "users")
    key = F.col(user_col).cast("string").alias("key")
    nxt = G.next_item(users, user_col, order=order, seed=seed).select("task", key, "system", "prompt", "response")
    rec = G.interest(users, user_col).select("task", key, "system", "prompt", "response")
    return nxt, rec


def generate_all(captions: DataFrame, sids: DataFrame, long_df: DataFrame, max_per_task: int | None = None,
                 max_users: int | None = None, min_tokens: int = 3, seed=42, order: str = "by_domain") -> DataFrame:
    nxt, rec = user_samples(long_df, sids, min_tokens=min_tokens, max_users=max_users, seed=seed, order=order)
    return item_samples(captions, sids, max_per_task, seed).unionByName(nxt).unionByName(rec)


def write_generated(spark, captions: DataFrame, sids: DataFrame, long_df: DataFrame, root: str,
                    max_per_task: int | None = None, max_users: int | None = None, seed=42) -> dict[str, str]:
    """W3 sinks (K2): ``item_ext``, ``user_ext`` and ``rec_ext`` JSONL folders of one-element
    arrays under ``root`` (a shared folder). Returns name -> folder. Writing the
    generated sets cuts the lineage between generation and mixing."""
    from mixprep.sinks.jsonl import write_jsonl
    nxt, rec = user_samples(long_df, sids, max_users=max_users, seed=seed)
    out = {"item_ext": item_samples(captions, sids, max_per_task, seed), "user_ext": nxt, "rec_ext": rec}
    paths = {}
    for name, df in out.items():
        paths[name] = f"{root.rstrip('/')}/{name}"
        write_jsonl(df, paths[name], array_per_line=True, cols=SAMPLE_COLS)
    return paths


def generate_short(captions: DataFrame, sids: DataFrame, long_df: DataFrame, max_candidates: int | None = None,
                   max_users: int | None = None, user_col: str = "user_id", seed=42) -> DataFrame:
    """W3 with the short template (the older generator).

    Items: ``max_candidates`` captions are sampled *before* the membership test (so
    fewer samples than candidates come out), both directions. Users: three
    domains, first 10 items each; next-item samples need 2 tokens, interest
    samples 1; ``max_users`` caps users (hash sample, before rendering).
    """
    from mixprep.operators.sampling import sample_n
    cands = captions
    if max_candidates is not None:
        # The cap ranks keys alone; captions join the few that remain.
        keyed = captions.select("pid", "domain", F.concat(F.col("domain"), F.lit(":"), F.col("pid").cast("string")).alias("_k"))
        cands = captions.join(sample_n(keyed, max_candidates, "_k", seed=seed).drop("_k"), ["pid", "domain"], "left_semi")
    items = join_items(cands, sids)
    key = F.concat(F.col("domain"), F.lit(":"), F.col("pid").cast("string")).alias("key")
    out = G.item_tasks(items, G.short_desc_to_token(), G.short_token_to_desc()).select("task", key, "system", "prompt", "response")
    seq = sequence_lookup(long_df, sids, user_col=user_col, cap=G.SHORT_ITEMS_PER_DOMAIN)
    from mixprep.session import stage
    users = stage(user_token_lists(seq, G.SHORT_USER_DOMAINS, user_col=user_col), "short-users")   # both generators read it
    if max_users is not None:
        users = sample_n(users.filter(F.size(G.short_all_tokens()) >= 1), max_users, user_col, seed=seed)
    ukey = F.col(user_col).cast("string").alias("key")
    return (out.unionByName(G.short_next_item(users, user_col).select("task", ukey, "system", "prompt", "response"))
            .unionByName(G.short_interest(users, user_col).select("task", ukey, "system", "prompt", "response")))
