"""Named queries: one per operator/pipeline of SURVEY §2, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables in full (through the fixture views) or
data Spark derives from them. Array outputs are rendered as comma-joined text so
that an independent engine can be compared value by value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from mixprep.functions import text as T
from mixprep.functions.subword import Subword, encode_texts, token_counts
from mixprep.operators import encode as E
from mixprep.operators import filters, generate as G, lookup, sampling, stats
from mixprep.operators.normalize import alpaca_to_sft, chat_pairs as chat_pairs_of
from mixprep.plans import fixtures as fx
from mixprep.plans import generate as W3
from mixprep.plans import mix as W12
from mixprep.plans import prepare as W4
from mixprep.plans import report as W5
from mixprep.session import scratch_path, stage
from mixprep.sinks import jsonl as sinks
from mixprep.sinks.published import publish_jsonl
from mixprep.sources import jsonl as src
from mixprep.sources import item_maps, keyed
from mixprep.sources.keyed import read_keyed_last

QUERIES = {}

CATEGORIES = ("rec", "item", "user", "world")
WEIGHTS_BY_COLUMN = (("rec", 1.0), ("item", 2.0), ("user", 5.0), ("world", 0.5))
WEIGHTS_BY_CONTENT = (("que", 2.0), ("der", 5.0), ("the", 1.5))
V2_MAX_CHAR, V3_MAX_CHAR, WORLD_MIN_CHAR, WORLD_SAMPLE = 12288, 36000, 50, 60


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _ints(c) -> Column:
    return F.array_join((F.col(c) if isinstance(c, str) else c).cast("array<string>"), ",")


def _sft(spark, d) -> DataFrame:
    return fx.samples(spark, d)


def _users(spark, d) -> DataFrame:
    long_df = lookup.profile_to_long(fx.profile(spark, d), fx.PROFILE_LISTS, fx.PROFILE_TIMES, cap=20)
    return W3.user_table(long_df, fx.item_sid(spark, d), cap=20)


def _items(spark, d) -> DataFrame:
    return lookup.join_items(fx.item_caption(spark, d), fx.item_sid(spark, d))


# ---------------------------------------------------------------------------
# Sources and sinks
# ---------------------------------------------------------------------------

@query
def src_jsonl_scan(spark: SparkSession, d: str) -> DataFrame:
    """The same samples landed once as object lines (K1) and once as one-element
    arrays (K2), read back in one scan: arrays flatten, objects pass."""
    root = scratch_path(spark, "jsonl-scan")
    s = _sft(spark, d)
    cols = ("sample_id", "category", "system", "prompt", "response")
    sinks.write_jsonl(s, f"{root}/objects", array_per_line=False, cols=cols)
    sinks.write_jsonl(s, f"{root}/arrays", array_per_line=True, cols=cols)
    schema = "sample_id BIGINT, category STRING, system STRING, prompt STRING, response STRING"
    df = src.read_jsonl(spark, [f"{root}/objects", f"{root}/arrays"], src.as_schema(schema))
    fmt = F.when(F.col("file_name").endswith(".json"), F.lit("object")).otherwise(F.lit("array"))
    return df.select(fmt.alias("fmt"), *cols)


@query
def src_jsonl_mixed(spark: SparkSession, d: str) -> DataFrame:
    """Lines that hold an array of an object, a number and a string; objects stay, scalars go."""
    root = scratch_path(spark, "jsonl-mixed")
    s = _sft(spark, d)
    one = F.to_json(F.struct("sample_id", "system", "prompt", "response"))
    s.select(F.concat(F.lit("["), one, F.lit(', 3, "x", null, '), one, F.lit("]")).alias("value")).write.text(root)
    return src.read_jsonl(spark, root, src.as_schema(_SFT_ID), lineage=False)


def _landed_dir(spark, d) -> str:
    root = scratch_path(spark, "jsonl-dir")
    sinks.write_jsonl_named(spark, _sft(spark, d), root, "category",
                            cols=("sample_id", "system", "prompt", "response"))
    return root


_SFT_ID = "sample_id BIGINT, system STRING, prompt STRING, response STRING"


@query
def src_dir_scan(spark: SparkSession, d: str) -> DataFrame:
    """S2 + S6: every *.jsonl of a directory; category from the file-name prefix."""
    df = src.read_dir(spark, _landed_dir(spark, d), schema=src.as_schema(_SFT_ID), with_category=CATEGORIES)
    return df.select("category", "sample_id", "system", "prompt", "response")


@query
def src_category_prune(spark: SparkSession, d: str) -> DataFrame:
    """S3: only files whose name starts with a listed category are opened."""
    df = src.read_dir(spark, _landed_dir(spark, d), categories=["rec", "user"],
                      schema=src.as_schema(_SFT_ID), with_category=CATEGORIES)
    return df.select("category", "sample_id", "system", "prompt", "response")


@query
def src_file_limit(spark: SparkSession, d: str) -> DataFrame:
    """S7 + S8: a keyed map table laid out as files named in domain order; only the files
    of the first two domains (in name order) are read, last wins within them."""
    from mixprep.sources import files
    root = scratch_path(spark, "sid-files")
    staging = f"{root}/_staging"
    (fx.item_sid(spark, d).withColumn("_part", F.col("domain"))
     .write.mode("overwrite").partitionBy("_part").parquet(staging))
    table, per_dir = f"{root}/table", []
    for k, sub in enumerate(files.list_dirs(spark, staging)):
        parts = files.list_files(spark, sub, "part-*.parquet")
        for i, f in enumerate(parts):
            files.rename(spark, f, f"{table}/{k:02d}-{i:05d}.parquet")
        per_dir.append(len(parts))
    df = read_keyed_last(spark, table, ["pid", "domain"], ["sid_three"], max_files=sum(per_dir[:2]),
                         key_casts={"pid": "bigint"})
    return df.select("pid", "domain", _ints("sid_three").alias("sid"))


@query
def cap_per_group(spark: SparkSession, d: str) -> DataFrame:
    """At most 5 documents per source, the same ones under any partitioning."""
    docs = fx.table(spark, d, "documents").select("doc_id", "source")
    return sampling.cap_per_group(docs, 5, ["source"], "doc_id", seed=42)


@query
def src_first_samples(spark: SparkSession, d: str) -> DataFrame:
    """The first 20 samples of each file, in file order; no more of a file is read than they take.

    Files are plain, one a category, written in the order of the sample id."""
    root = scratch_path(spark, "jsonl-heads")
    publish_jsonl(spark, _sft(spark, d), root, "category", ("sample_id", "system", "prompt", "response"), layout="plain", order=("sample_id",))
    df = src.read_dir(spark, root, schema=src.as_schema(_SFT_ID), with_category=CATEGORIES, first=20)
    return df.select("category", "sample_no", "sample_id", "system", "prompt", "response")


@query
def sink_published(spark: SparkSession, d: str) -> DataFrame:
    """K1 + K4: train.jsonl and eval.jsonl published by a commit protocol and read back by name."""
    root = scratch_path(spark, "published")
    s = sampling.split_eval(_sft(spark, d), ["category"], "sample_id", ratio=0.05, seed=42)
    paths = publish_jsonl(spark, s, root, "split", ("sample_id", "system", "prompt", "response"))
    back = None
    for p in paths:
        df = src.read_jsonl(spark, p, src.as_schema(_SFT_ID), lineage=False).withColumn("name", F.lit(p.rstrip("/").rsplit("/", 1)[-1]))
        back = df if back is None else back.unionByName(df)
    return back.select("name", "sample_id", "system", "prompt", "response")


@query
def category_from_name(spark: SparkSession, d: str) -> DataFrame:
    """First listed prefix of the name wins (src1 before src)."""
    docs = fx.table(spark, d, "documents")
    cat = T.category_from_name(F.col("source"), ["src1", "src2", "src"])
    return docs.select("doc_id", "source", cat.alias("category"))


@query
def dedupe_last_wins(spark: SparkSession, d: str) -> DataFrame:
    """Duplicate keys (a shifted copy of some items) resolved by the later row."""
    base = fx.item_sid(spark, d).withColumn("ord", F.lit(0))
    dup = (fx.item_sid(spark, d).filter(F.col("pid") % 7 == 0)
           .withColumn("sid_three", F.array(F.get("sid_three", 0) + 1, F.get("sid_three", 1), F.get("sid_three", 2)))
           .withColumn("ord", F.lit(1)))
    df = keyed.dedupe_last_wins(base.unionByName(dup), ["pid", "domain"], ["sid_three"], ["ord"])
    return df.select("pid", "domain", _ints("sid_three").alias("sid"))


@query
def dedupe_growing(spark: SparkSession, d: str) -> DataFrame:
    """S7 on a map that grows: a shifted copy of some items arrives first, under later names, then the items; state keeps the last row of each key."""
    from mixprep.sources import files
    from mixprep.streaming.keyed_map import GrowingMap
    root = scratch_path(spark, "growing")
    items = fx.item_sid(spark, d).select("pid", "domain", F.col("sid_three"))
    later = items.filter(F.col("pid") % 7 == 0).withColumn("sid_three", F.array(F.get("sid_three", 0) + 1, F.get("sid_three", 1), F.get("sid_three", 2)))
    grown = GrowingMap(spark, f"{root}/map", f"{root}/state", ["pid", "domain"], ["sid_three"], "pid bigint, domain string, sid_three array<int>")
    for letter, rows in (("b", later), ("a", items)):
        rows.write.parquet(f"{root}/arriving-{letter}")
        for i, f in enumerate(files.list_files(spark, f"{root}/arriving-{letter}", "part-*.parquet")):
            files.rename(spark, f, f"{root}/map/{letter}-{i:05d}.parquet")
        grown.refresh()
    return grown.table().select("pid", "domain", _ints("sid_three").alias("sid"))


@query
def profile_scan(spark: SparkSession, d: str) -> DataFrame:
    """The wide profile's list columns (projection reaches the scan)."""
    p = fx.profile(spark, d)
    return p.select("user_id", *[_ints(c).alias(c) for c in list(fx.PROFILE_LISTS) + list(fx.PROFILE_TIMES)])


@query
def profile_long(spark: SparkSession, d: str) -> DataFrame:
    """S10 + J4: NULL-safe lists exploded to (user, domain, pos, pid, ts), times zipped first."""
    return lookup.profile_to_long(fx.profile(spark, d), fx.PROFILE_LISTS, fx.PROFILE_TIMES)


@query
def sink_jsonl_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """K1 + K4: the v2 mixture written as JSONL partitioned by split and read back."""
    root = scratch_path(spark, "mix-v2")
    mixed = mix_v2(spark, d)
    sinks.write_jsonl(mixed, root, partition_by="split", cols=("sample_key", "system", "prompt", "response"))
    back = spark.read.schema("sample_key STRING, system STRING, prompt STRING, response STRING, split STRING").json(root)
    return back.select("split", "sample_key", "system", "prompt", "response")


@query
def sink_jsonl_array(spark: SparkSession, d: str) -> DataFrame:
    """K2: item samples written one-element-array per line, parsed back."""
    root = scratch_path(spark, "items-array")
    items = W3.item_samples(fx.item_caption(spark, d), fx.item_sid(spark, d))
    cols = ("task", "key", "system", "prompt", "response")
    sinks.write_jsonl(items, root, array_per_line=True, cols=cols)
    back = src.read_jsonl(spark, root, src.as_schema(
        "task STRING, key STRING, system STRING, prompt STRING, response STRING"), lineage=False)
    return back.select(*cols)


@query
def mix_stats(spark: SparkSession, d: str) -> DataFrame:
    """K3: one statistics row of the v2 mixture."""
    return sinks.stats_row(mix_v2(spark, d), V2_MAX_CHAR, WORLD_SAMPLE, 0.05)


# ---------------------------------------------------------------------------
# Row-wise projections
# ---------------------------------------------------------------------------

@query
def norm_alpaca(spark: SparkSession, d: str) -> DataFrame:
    """N1 + N2 + N4: Alpaca -> SFT with Python-equal strip and history prefix."""
    return alpaca_to_sft(fx.alpaca(spark, d), keep=["conv_id"])


@query
def norm_history_nulls(spark: SparkSession, d: str) -> DataFrame:
    """N2 with NULL parts: every third conversation loses a question or an answer of its history."""
    def cut(p):
        return F.array(F.when(F.col("conv_id") % 3 != 1, p[0]), F.when(F.col("conv_id") % 3 != 2, p[1]))
    a = fx.alpaca(spark, d).withColumn("history", F.transform("history", cut))
    return a.select("conv_id", T.history_prefix("history").alias("history_text"))


@query
def norm_schema_aware(spark: SparkSession, d: str) -> DataFrame:
    """SFT rows and Alpaca rows in one input; SFT fields pass, Alpaca rows are converted."""
    from mixprep.operators.normalize import to_sft
    sft = _sft(spark, d).select(F.concat(F.lit("s:"), F.col("sample_id").cast("string")).alias("key"),
                                "system", "prompt", "response")
    alp = fx.alpaca(spark, d).select(F.concat(F.lit("a:"), F.col("conv_id").cast("string")).alias("key"),
                                     "instruction", "input", "output", "history")
    both = sft.unionByName(alp, allowMissingColumns=True)
    return to_sft(both, keep=["key"])


@query
def norm_history(spark: SparkSession, d: str) -> DataFrame:
    """The flattened history text alone."""
    return fx.alpaca(spark, d).select("conv_id", T.history_prefix("history").alias("history_text"))


def _pairs_text(c) -> Column:
    return F.array_join(F.transform(F.col(c), lambda h: F.array_join(h, " || ")), " ## ")


@query
def chat_to_alpaca(spark: SparkSession, d: str) -> DataFrame:
    """Conversations -> Alpaca rows (history rendered as text)."""
    a = fx.alpaca(spark, d)
    return a.select("conv_id", "instruction", "input", "output", _pairs_text("history").alias("history"))


@query
def chat_pairs(spark: SparkSession, d: str) -> DataFrame:
    """N3 as rows: every user turn that the next turn answers, the last pair marked; conversations cut into stretches."""
    return chat_pairs_of(fx.table(spark, d, "conversations"))


@query
def char_len(spark: SparkSession, d: str) -> DataFrame:
    """Code-point length of system + prompt + response."""
    return _sft(spark, d).select("sample_id", T.char_len("system", "prompt", "response").alias("char_len"))


@query
def token_estimate(spark: SparkSession, d: str) -> DataFrame:
    """ceil(chars / 3)."""
    n = T.char_len("system", "prompt", "response")
    return _sft(spark, d).select("sample_id", T.token_estimate(n).alias("est_tokens"))


@query
def sid_token(spark: SparkSession, d: str) -> DataFrame:
    """prefix(domain) + <s_a_i><s_b_j><s_c_k>."""
    return fx.item_sid(spark, d).select("pid", "domain", T.sid_token(F.col("domain"), F.col("sid_three")).alias("token"))


@query
def domain_labels(spark: SparkSession, d: str) -> DataFrame:
    """Domain -> prefix token and display label, per caption row."""
    c = fx.item_caption(spark, d)
    return c.select("pid", "domain", T.domain_prefix(F.col("domain")).alias("prefix"),
                    T.domain_label(F.col("domain")).alias("label"))


@query
def caption_summary(spark: SparkSession, d: str) -> DataFrame:
    """First 3 parts at the first present separator, cut to 50."""
    c = fx.item_caption(spark, d)
    return c.select("pid", "domain", T.caption_summary(F.col("caption")).alias("summary"))


@query
def chat_render(spark: SparkSession, d: str) -> DataFrame:
    """Full and prefix chat texts."""
    s = _sft(spark, d)
    return s.select("sample_id", T.chat_full_text("system", "prompt", "response").alias("full_text"),
                    T.chat_prefix_text("system", "prompt").alias("prefix_text"))


@query
def weight_by_content(spark: SparkSession, d: str) -> DataFrame:
    """First-match weight by content, both scopes."""
    s = _sft(spark, d)
    return s.select("sample_id", T.weight_by_content(WEIGHTS_BY_CONTENT, scope="joined").alias("w_joined"),
                    T.weight_by_content(WEIGHTS_BY_CONTENT, scope="separate").alias("w_separate"))


@query
def rec_prompt(spark: SparkSession, d: str) -> DataFrame:
    """Behaviour lines per user."""
    u = _users(spark, d)
    return u.select("user_id", G.rec_lines(u).alias("lines"))


@query
def user_prompt(spark: SparkSession, d: str) -> DataFrame:
    """Event lines per user (all events, first 20 lines)."""
    u = _users(spark, d)
    return u.select("user_id", G.render_events(G.event_lines(u)).alias("lines"))


# ---------------------------------------------------------------------------
# Filters
# ---------------------------------------------------------------------------

@query
def filter_len(spark: SparkSession, d: str) -> DataFrame:
    """char_len <= 12288."""
    return filters.filter_max_len(_sft(spark, d), V2_MAX_CHAR).select("sample_id", "category")


@query
def filter_band(spark: SparkSession, d: str) -> DataFrame:
    """50 < len(prompt + response) <= 12288."""
    s = _sft(spark, d)
    return filters.filter_band(s, WORLD_MIN_CHAR, V2_MAX_CHAR, T.char_len("prompt", "response")).select("sample_id")


@query
def long_policy(spark: SparkSession, d: str) -> DataFrame:
    """drop rows whose untruncated token count exceeds 1024."""
    enc = E.encode(_sft(spark, d), max_len=1024, keep=["sample_id"])
    return filters.long_policy(enc, 1024, "drop").select("sample_id", "n_tokens_full")


@query
def encode_filter(spark: SparkSession, d: str) -> DataFrame:
    """keep encoded rows with more than 10 tokens."""
    enc = E.encode(_sft(spark, d), max_len=2048, keep=["sample_id"])
    return filters.filter_min_tokens(enc).select("sample_id", F.size("input_ids").alias("n_tokens"))


@query
def user_min_history(spark: SparkSession, d: str) -> DataFrame:
    """users with at least 40 resolved items."""
    u = G.eligible_users(_users(spark, d), min_tokens=40)
    return u.select("user_id", "n_tokens")


# ---------------------------------------------------------------------------
# Joins
# ---------------------------------------------------------------------------

@query
def join_item(spark: SparkSession, d: str) -> DataFrame:
    """Caption JOIN sid on (pid, domain)."""
    return _items(spark, d).select("pid", "domain", "caption", "token")


@query
def semi_item(spark: SparkSession, d: str) -> DataFrame:
    """Captions whose key is in the sid table."""
    return lookup.semi_items(fx.item_caption(spark, d), fx.item_sid(spark, d)).select("pid", "domain")


@query
def seq_lookup(spark: SparkSession, d: str) -> DataFrame:
    """First 20 items per (user, domain) looked up, misses dropped, order kept."""
    long_df = lookup.profile_to_long(fx.profile(spark, d), fx.PROFILE_LISTS, fx.PROFILE_TIMES, cap=20)
    seq = lookup.sequence_lookup(long_df, fx.item_sid(spark, d), cap=20)
    toks = F.transform("seq", lambda e: e["token"])
    return seq.select("user_id", "domain", F.size("seq").alias("n_tokens"), F.array_join(toks, ",").alias("tokens"))


def _landed_maps(spark, d) -> tuple[DataFrame, DataFrame]:
    root = scratch_path(spark, "maps")
    sids = item_maps.land_bucketed(fx.item_sid(spark, d), f"{root}/sid", buckets=8)
    return item_maps.land_bucketed(fx.item_caption(spark, d), f"{root}/caption", like=f"{root}/sid"), sids


@query
def join_item_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """J1 on maps dealt by key once: neither side is shuffled."""
    return lookup.join_items(*_landed_maps(spark, d)).select("pid", "domain", "caption", "token")


@query
def semi_item_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """J2 on maps dealt by key once."""
    return lookup.semi_items(*_landed_maps(spark, d)).select("pid", "domain")


@query
def seq_lookup_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """J3 on a map dealt by key once: only the asking side is shuffled; items asked for over 50 times are answered by a table of their own."""
    long_df = lookup.profile_to_long(fx.profile(spark, d), fx.PROFILE_LISTS, fx.PROFILE_TIMES, cap=20)
    seq = item_maps.sequence_lookup_bucketed(long_df, _landed_maps(spark, d)[1], cap=20, hot_rows=50)
    toks = F.transform("seq", lambda e: e["token"])
    return seq.select("user_id", "domain", F.size("seq").alias("n_tokens"), F.array_join(toks, ",").alias("tokens"))


@query
def seq_lookup_ts(spark: SparkSession, d: str) -> DataFrame:
    """Live items keep their own time through the look-up."""
    long_df = lookup.profile_to_long(fx.profile(spark, d), fx.PROFILE_LISTS, fx.PROFILE_TIMES, cap=20)
    seq = lookup.sequence_lookup(long_df, fx.item_sid(spark, d), cap=20).filter(F.col("domain") == "live")
    e = seq.select("user_id", F.explode("seq").alias("e"))
    return e.select("user_id", F.col("e.pos").alias("pos"), F.col("e.ts").alias("ts"), F.col("e.token").alias("token"))


# ---------------------------------------------------------------------------
# Generators
# ---------------------------------------------------------------------------

_GEN = ("task", "key", "system", "prompt", "response")


@query
def gen_desc2tok(spark: SparkSession, d: str) -> DataFrame:
    """G1: description -> token samples."""
    return W3.item_samples(fx.item_caption(spark, d), fx.item_sid(spark, d)).filter(F.col("task") == "desc2tok")


@query
def gen_tok2desc(spark: SparkSession, d: str) -> DataFrame:
    """Token -> description samples."""
    return W3.item_samples(fx.item_caption(spark, d), fx.item_sid(spark, d)).filter(F.col("task") == "tok2desc")


def _user_long(spark, d):
    return lookup.profile_to_long(fx.profile(spark, d), fx.PROFILE_LISTS, fx.PROFILE_TIMES, cap=20)


@query
def gen_next_item(spark: SparkSession, d: str) -> DataFrame:
    """Next-item samples (users with >= 3 resolved items)."""
    nxt, _ = W3.user_samples(_user_long(spark, d), fx.item_sid(spark, d))
    return nxt


@query
def gen_next_item_shuffled(spark: SparkSession, d: str) -> DataFrame:
    """G3 with the seeded per-user event shuffle (D4 option)."""
    users = G.eligible_users(W3.user_table(_user_long(spark, d), fx.item_sid(spark, d)), 3)
    return G.next_item(users, order="shuffled", seed=42).select(
        "task", F.col("user_id").cast("string").alias("key"), "system", "prompt", "response")


@query
def gen_interest(spark: SparkSession, d: str) -> DataFrame:
    """Multi-domain interest samples."""
    _, rec = W3.user_samples(_user_long(spark, d), fx.item_sid(spark, d))
    return rec


@query
def gen_capped(spark: SparkSession, d: str) -> DataFrame:
    """At most 500 items per task, sampled on the keys before rendering."""
    return W3.item_samples(fx.item_caption(spark, d), fx.item_sid(spark, d), max_per_task=500)


# ---------------------------------------------------------------------------
# Sampling, ordering, splitting, weighting
# ---------------------------------------------------------------------------

@query
def hash_rank(spark: SparkSession, d: str) -> DataFrame:
    """Position of each sample inside its category under md5(seed:id)."""
    s = _sft(spark, d).select("sample_id", "category")
    return sampling.hash_rank(s, ["category"], "sample_id", seed=42, out="rn")


@query
def shuffle_order(spark: SparkSession, d: str) -> DataFrame:
    """Global seeded shuffle, emitted as each row's position."""
    s = _sft(spark, d).select("sample_id")
    return sampling.hash_rank(s, [], "sample_id", seed="42:order", out="pos")


@query
def sample_n(spark: SparkSession, d: str) -> DataFrame:
    """R2: 60 samples per category without replacement."""
    s = _sft(spark, d).select("sample_id", "category")
    return sampling.sample_n(s, WORLD_SAMPLE, "sample_id", group_cols=["category"], seed="42:sample")


@query
def split_eval(spark: SparkSession, d: str) -> DataFrame:
    """Per category, max(1, int(n*0.05)) eval rows, the rest train."""
    s = _sft(spark, d).select("sample_id", "category")
    return sampling.split_eval(s, ["category"], "sample_id", ratio=0.05, seed=42)


@query
def resample_weighted(spark: SparkSession, d: str) -> DataFrame:
    """N draws with replacement, P(row) ~ weight of its category."""
    s = _sft(spark, d).select("sample_id", "category")
    s = s.withColumn("w", sampling.class_weights(WEIGHTS_BY_COLUMN, "category"))
    return sampling.resample_weighted(s, "w", "sample_id", seed=42, max_classes=len(WEIGHTS_BY_COLUMN) + 1).select("draw_id", "sample_id", "category")


@query
def resample_by_row(spark: SparkSession, d: str) -> DataFrame:
    """R4 with a weight of its own for every row: a tenth and a thousandth of its length."""
    docs = fx.table(spark, d, "documents").select("doc_id", (F.lit(0.1) + F.coalesce(F.col("n_chars"), F.lit(0)) / F.lit(1000.0)).alias("w"))
    return sampling.resample_by_row(docs, "w", "doc_id", seed=42).select("draw_id", "doc_id", "w")


@query
def split_by_item(spark: SparkSession, d: str) -> DataFrame:
    """Both directions of an item's samples on one side of the split, per domain."""
    rows = _items(spark, d).select("domain", "pid", F.explode(F.array(F.lit("desc2tok"), F.lit("tok2desc"))).alias("task"))
    return sampling.split_by_key(rows, ["domain"], "pid", ratio=0.05, seed=42)


@query
def split_by_order(spark: SparkSession, d: str) -> DataFrame:
    """D12 where keys have many sizes: the lines of an order on one side, per return flag."""
    lines = fx.table(spark, d, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber")
    return sampling.split_by_key(lines, ["l_returnflag"], "l_orderkey", ratio=0.05, seed=42)


@query
def resample_by_content(spark: SparkSession, d: str) -> DataFrame:
    """R4 with weights found by content (N12, first match, joined scope), as the reference's trainer does."""
    s = _sft(spark, d).withColumn("w", T.weight_by_content(WEIGHTS_BY_CONTENT, scope="joined"))
    return sampling.resample_weighted(s.select("sample_id", "category", "w"), "w", "sample_id", seed=42,
                                      max_classes=len(WEIGHTS_BY_CONTENT) + 1).select("draw_id", "sample_id", "category")


def _keyed_by_text(spark, d) -> DataFrame:
    """Documents whose only key is their text: copies share it, and are numbered."""
    docs = fx.table(spark, d, "documents")
    cat = fx._case(F.col("lang"), fx.CATEGORY_BY_LANG, "world").alias("category")
    return sampling.number_copies(docs.select(F.md5(F.coalesce("text", F.lit(""))).alias("text_key"), "doc_id", cat), "text_key", "doc_id", "uid")


@query
def number_copies(spark: SparkSession, d: str) -> DataFrame:
    """X1 with repeated keys: every row of a repeated text has an id of its own."""
    return _keyed_by_text(spark, d).select("doc_id", "category", "uid")


@query
def split_eval_dups(spark: SparkSession, d: str) -> DataFrame:
    """R3 over rows that share keys: still exactly max(1, int(n*0.05)) eval rows per category."""
    return sampling.split_eval(_keyed_by_text(spark, d).select("doc_id", "uid", "category"), ["category"], "uid", seed=42)


@query
def resample_dups(spark: SparkSession, d: str) -> DataFrame:
    """R4 over rows that share keys: every copy draws by itself, as many draws as rows."""
    s = _keyed_by_text(spark, d).select("uid", "category").withColumn("w", sampling.class_weights(WEIGHTS_BY_COLUMN, "category"))
    return sampling.resample_weighted(s, "w", "uid", seed=42, max_classes=len(WEIGHTS_BY_COLUMN) + 1).select("draw_id", "uid", "category")


@query
def weights_default(spark: SparkSession, d: str) -> DataFrame:
    """R4's weights where no entry names a category: such rows are kept at 1.0."""
    s = _sft(spark, d).select("sample_id", "category")
    return s.withColumn("w", sampling.class_weights((("rec", 3.0),), "category"))


@query
def shuffle_written(spark: SparkSession, d: str) -> DataFrame:
    """R1 as written: the shuffled rows through the writer, read back, numbered by file and row."""
    out = scratch_path(spark, "shuffled")
    sampling.shuffle_order(_sft(spark, d).select("sample_id", "category"), "sample_id", seed="42:order").write.parquet(out)
    back = spark.read.parquet(out).select("sample_id", "category", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    before = back.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(F.lit(0)).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)   # a row per file
    before = before.select("file", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    return back.join(before, "file").select("sample_id", "category", (F.col("before") + F.col("row") + 1).alias("pos"))


@query
def subtype_top5(spark: SparkSession, d: str) -> DataFrame:
    """A5 + R5: 5 most frequent system prefixes (30 chars) per category."""
    return stats.top_subtypes(_sft(spark, d), ["category"], "system", k=5)


# ---------------------------------------------------------------------------
# Aggregations
# ---------------------------------------------------------------------------

@query
def mix_counts(spark: SparkSession, d: str) -> DataFrame:
    """A1: samples -> F1(12288) -> R3 per category -> train/eval counts with total row."""
    s = filters.filter_max_len(_sft(spark, d), V2_MAX_CHAR)
    s = stage(s.select("sample_id", "category"), "counted")      # the texts are read once, for the filter
    s = sampling.split_eval(s, ["category"], "sample_id", ratio=0.05, seed=42)
    return stats.split_counts(s, "category")


def _tok_len(spark, d) -> DataFrame:
    return W5.with_token_len(_sft(spark, d))


@query
def len_summary(spark: SparkSession, d: str) -> DataFrame:
    """A2: count, min, max, sum // n of token lengths per category."""
    return stats.length_summary(_tok_len(spark, d), ["category"], "n_tokens")


@query
def len_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """A3: sorted[int(n*p)] for p = 0.5, 0.9, 0.99 per category, from the histogram."""
    return stats.rank_percentiles(_tok_len(spark, d), ["category"], "n_tokens")


@query
def len_over(spark: SparkSession, d: str) -> DataFrame:
    """A4: rows over 1024/2048/4096/8192 tokens and integer percent."""
    return stats.exceedance(_tok_len(spark, d), ["category"], "n_tokens")


@query
def category_share(spark: SparkSession, d: str) -> DataFrame:
    """Rows per category and n*100 // total."""
    return stats.category_share(_sft(spark, d), "category")


@query
def mix_funnel(spark: SparkSession, d: str) -> DataFrame:
    """Rows before and after each filter step, one pass."""
    s = _sft(spark, d)
    n = T.char_len("system", "prompt", "response")
    pr = T.char_len("prompt", "response")
    s = s.withColumn("len_ok", n <= F.lit(V2_MAX_CHAR)).withColumn(
        "band_ok", (pr > F.lit(WORLD_MIN_CHAR)) & (pr <= F.lit(V2_MAX_CHAR))).withColumn(
        "v3_ok", n <= F.lit(V3_MAX_CHAR))
    return stats.funnel(s, "category", ["len_ok", "band_ok", "v3_ok"])


# ---------------------------------------------------------------------------
# Encoding and batches
# ---------------------------------------------------------------------------

@query
def token_count(spark: SparkSession, d: str) -> DataFrame:
    """Native token count of system + prompt + response."""
    return _tok_len(spark, d).select("sample_id", "n_tokens")


@query
def encode(spark: SparkSession, d: str) -> DataFrame:
    """Chat-rendered ids, right-truncated to 2048."""
    enc = E.encode(_sft(spark, d), max_len=2048, keep=["sample_id"])
    return enc.select("sample_id", _ints("input_ids").alias("input_ids"), "n_tokens_full", "n_prefix", "n_supervised")


@query
def label_mask(spark: SparkSession, d: str) -> DataFrame:
    """Labels -100 over the prompt part, attention all ones."""
    enc = E.encode(_sft(spark, d), max_len=2048, keep=["sample_id"])
    return enc.select("sample_id", _ints("labels").alias("labels"), F.size("attention_mask").alias("n_attention"),
                      F.array_max("attention_mask").alias("mask_max"))


@query
def pad_batches(spark: SparkSession, d: str) -> DataFrame:
    """Seeded batches of 8, right-padded to the batch maximum (cap 512)."""
    enc = E.encode(_sft(spark, d), max_len=512, keep=["sample_id"])
    p = E.pad_batches(enc.select("sample_id", "input_ids", "attention_mask", "labels"), 8, "sample_id",
                      max_len=512, seed=42)
    return p.select("sample_id", "batch_id", "row_in_batch", "width", _ints("input_ids").alias("input_ids"),
                    _ints("attention_mask").alias("attention_mask"), _ints("labels").alias("labels"))


def _subword() -> Subword:
    import public_tokenizers
    return Subword(public_tokenizers.path("byte_bpe_50k.json"))


@query
def token_count_subword(spark: SparkSession, d: str) -> DataFrame:
    """E1(b): tokens of system + prompt + response by a byte-level BPE tokenizer."""
    return token_counts(_sft(spark, d), _subword(), keep=["sample_id"])


@query
def encode_subword(spark: SparkSession, d: str) -> DataFrame:
    """E2 + E3 with a byte-level BPE tokenizer: chat markers are single tokens, the mask goes by character offsets."""
    enc = E.encode(_sft(spark, d), max_len=2048, keep=["sample_id"], tokenizer=_subword())
    return enc.select("sample_id", _ints("input_ids").alias("input_ids"), _ints("labels").alias("labels"), "n_tokens_full", "n_prefix", "n_supervised", "n_border")


@query
def encode_completion(spark: SparkSession, d: str) -> DataFrame:
    """Prompt and response as one text without a template, cut inside words, so merges cross the border."""
    enc = encode_texts(_sft(spark, d), _subword(), T.default_empty("prompt"), T.default_empty("response"), 2048, ["sample_id"], border="learn")
    return enc.select("sample_id", _ints("input_ids").alias("input_ids"), "n_tokens_full", "n_prefix", "n_border")


# ---------------------------------------------------------------------------
# Pipelines
# ---------------------------------------------------------------------------

def _base_sources(spark, d, max_char):
    names = ("rec", "item", "user")   # one scan for the three
    s = _sft(spark, d).filter(F.col("category").isin(*names))
    return [W12.Source("base", s, "sample_id", fmt="sft", max_char=max_char, name_col="category", names=names)]


def _recipe_v2(spark, d):
    world = W12.Source("world", fx.alpaca(spark, d), "conv_id", fmt="alpaca", min_char=WORLD_MIN_CHAR,
                       max_char=V2_MAX_CHAR, sample=WORLD_SAMPLE)
    return W12.Recipe(_base_sources(spark, d, V2_MAX_CHAR) + [world], split_by="category")


@query
def mix_v2(spark: SparkSession, d: str) -> DataFrame:
    """rec/item/user F1(12288) + world (Alpaca, 50 < len <= 12288, sample 60); split per category."""
    return W12.run_recipe(_recipe_v2(spark, d))


@query
def mix_v3(spark: SparkSession, d: str) -> DataFrame:
    """Base + generated ext sources + world ext; F1(36000); split per source; x_ext -> x."""
    sids, caps = fx.item_sid(spark, d), fx.item_caption(spark, d)
    items = W3.item_samples(caps, sids)
    nxt, rec = W3.user_samples(_user_long(spark, d), sids)
    key = F.concat_ws(":", "task", "key").alias("gen_key")

    def ext(name, df):
        return W12.Source(name, df.select(key, "system", "prompt", "response"), "gen_key", fmt="auto",
                          max_char=V3_MAX_CHAR)
    world = W12.Source("world_ext", fx.alpaca(spark, d), "conv_id", fmt="auto", category="world",
                       min_char=WORLD_MIN_CHAR, max_char=V3_MAX_CHAR, sample=WORLD_SAMPLE)
    srcs = _base_sources(spark, d, V3_MAX_CHAR) + [ext("rec_ext", rec), ext("item_ext", items),
                                                     ext("user_ext", nxt), world]
    return W12.run_recipe(W12.Recipe(srcs, split_by="source"))


@query
def mix_funnel_recipe(spark: SparkSession, d: str) -> DataFrame:
    """A7 of the v2 mixture: raw, kept, train and eval rows per source."""
    recipe = _recipe_v2(spark, d)
    return W12.funnel(recipe, W12.run_recipe(recipe))


@query
def mix_v3_alpaca_files(spark: SparkSession, d: str) -> DataFrame:
    """W2's Alpaca-form files, which have no ids: two files of one source with the same lines, read back, keyed by
    content, copies numbered, split per source."""
    root = scratch_path(spark, "alpaca-files")
    a = fx.alpaca(spark, d).select("instruction", "input", "output")
    for name in ("one", "two"):
        sinks.write_jsonl(a, f"{root}/{name}", cols=("instruction", "input", "output"))
    schema = src.as_schema("system STRING, prompt STRING, response STRING, instruction STRING, input STRING, output STRING")
    rows = src.read_sources(spark, {"item_ext": [f"{root}/one", f"{root}/two"]}, schema).drop("file_name", "category")
    rows = src.staged_with_ids(rows, "alpaca-rows")
    source = W12.Source("item_ext", rows, "sample_key", fmt="auto", max_char=V3_MAX_CHAR)
    return W12.run_recipe(W12.Recipe([source], split_by="source"))


def _short_long(spark, d):
    return lookup.profile_to_long(fx.profile(spark, d), fx.PROFILE_LISTS, fx.PROFILE_TIMES, cap=G.SHORT_ITEMS_PER_DOMAIN)


@query
def generate_short(spark: SparkSession, d: str) -> DataFrame:
    """W3, short template: all items both directions; users over 3 domains x 10 items."""
    return W3.generate_short(fx.item_caption(spark, d), fx.item_sid(spark, d), _short_long(spark, d))


@query
def gen_short_capped(spark: SparkSession, d: str) -> DataFrame:
    """G5, short template: 500 caption candidates before the membership test, 20 users."""
    return W3.generate_short(fx.item_caption(spark, d), fx.item_sid(spark, d), _short_long(spark, d),
                             max_candidates=500, max_users=20)


@query
def mix_v3_files(spark: SparkSession, d: str) -> DataFrame:
    """W2 as files: W3 writes ext JSONL (K2), base and world samples land as named JSONL
    files; v3 reads them through the multi-file source (S5, a missing file is skipped)."""
    root = scratch_path(spark, "mix-v3-files")
    ext = W3.write_generated(spark, fx.item_caption(spark, d), fx.item_sid(spark, d), _user_long(spark, d),
                             f"{root}/ext")
    base_dir = f"{root}/base"
    landed = sinks.write_jsonl_named(spark, _sft(spark, d), base_dir, "category",
                                     cols=("sample_id", "system", "prompt", "response"))
    sinks.write_jsonl(fx.alpaca(spark, d), f"{root}/world", cols=("conv_id", "instruction", "input", "output", "history"))
    gen_schema = src.as_schema("task STRING, key STRING, system STRING, prompt STRING, response STRING")
    base_schema = src.as_schema(_SFT_ID)
    world_schema = src.as_schema(
        "conv_id BIGINT, instruction STRING, input STRING, output STRING, history ARRAY<ARRAY<STRING>>")
    key = F.concat_ws(":", "task", "key").alias("gen_key")
    srcs = []
    for c in ("rec", "item", "user"):
        paths = [p for p in landed if p.rsplit("/", 1)[-1].startswith(c + "_")] + [f"{base_dir}/{c}_missing.jsonl"]
        df = src.read_sources(spark, {c: paths}, base_schema)
        srcs.append(W12.Source(c, df, "sample_id", fmt="sft", max_char=V3_MAX_CHAR))
    for name in ("rec_ext", "item_ext", "user_ext"):
        df = src.read_sources(spark, {name: [ext[name]]}, gen_schema).select(key, "system", "prompt", "response")
        srcs.append(W12.Source(name, df, "gen_key", fmt="auto", max_char=V3_MAX_CHAR))
    world = src.read_sources(spark, {"world_ext": [f"{root}/world"]}, world_schema)
    srcs.append(W12.Source("world_ext", world.drop("file_name", "category"), "conv_id", fmt="auto", category="world",
                           min_char=WORLD_MIN_CHAR, max_char=V3_MAX_CHAR, sample=WORLD_SAMPLE))
    return W12.run_recipe(W12.Recipe(srcs, split_by="source"))


@query
def generate_all(spark: SparkSession, d: str) -> DataFrame:
    """All item and user samples."""
    return W3.generate_all(fx.item_caption(spark, d), fx.item_sid(spark, d), _user_long(spark, d))


@query
def generate_all_shuffled(spark: SparkSession, d: str) -> DataFrame:
    """W3 with the seeded shuffle of each user's events."""
    return W3.generate_all(fx.item_caption(spark, d), fx.item_sid(spark, d), _user_long(spark, d), order="shuffled")


@query
def encode_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """Split; train resampled by category weight; both encoded (2048), F3 truncate, F4."""
    s = sampling.split_eval(_sft(spark, d), ["category"], "sample_id", seed=42)
    s = stage(s, "encode-split")   # both branches and the resampler's passes read it
    train = W4.prepare_train(s.filter(F.col("split") == "train"), "sample_id", WEIGHTS_BY_COLUMN,
                             max_len=2048, keep=["category"])
    ev = W4.prepare_eval(s.filter(F.col("split") == "eval"), "sample_id", max_len=2048, keep=["category"])
    cols = lambda df, sp: df.select(F.lit(sp).alias("split"), "draw_id", "sample_id", "category",
                                    F.size("input_ids").alias("n_ids"), "n_tokens_full", "n_supervised",
                                    F.md5(_ints("input_ids")).alias("ids_md5"),
                                    F.md5(_ints("labels")).alias("labels_md5"))
    return cols(train, "train").unionByName(cols(ev, "eval"))


@query
def encode_pipeline_subword(spark: SparkSession, d: str) -> DataFrame:
    """W4 with a byte-level BPE tokenizer: train resampled by category weight and eval, encoded (1024), longer samples dropped by their own tokens."""
    s = sampling.split_eval(_sft(spark, d), ["category"], "sample_id", seed=42)
    s = stage(s, "encode-split")
    t = _subword()
    train = W4.prepare_train(s.filter(F.col("split") == "train"), "sample_id", WEIGHTS_BY_COLUMN, max_len=1024, policy="drop", keep=["category"], tokenizer=t)
    ev = W4.prepare_eval(s.filter(F.col("split") == "eval"), "sample_id", max_len=1024, policy="drop", keep=["category"], tokenizer=t)
    cols = lambda df, sp: df.select(F.lit(sp).alias("split"), "draw_id", "sample_id", "category", F.size("input_ids").alias("n_ids"),
                                    "n_supervised", "n_border", F.md5(_ints("input_ids")).alias("ids_md5"), F.md5(_ints("labels")).alias("labels_md5"))
    return cols(train, "train").unionByName(cols(ev, "eval"))


@query
def length_report_subword(spark: SparkSession, d: str) -> DataFrame:
    """W5 in tokens of a byte-level BPE tokenizer."""
    return W5.length_report(_sft(spark, d), tokenizer=_subword())


@query
def length_report(spark: SparkSession, d: str) -> DataFrame:
    """JSONL directory -> category from file name -> token lengths -> report."""
    df = src.read_dir(spark, _landed_dir(spark, d), schema=src.as_schema(_SFT_ID), with_category=CATEGORIES)
    return W5.length_report(df)



@query
def length_report_subtypes(spark: SparkSession, d: str) -> DataFrame:
    """W5's sub-types: the five most frequent beginnings of the system text per category, with their share."""
    return W5.subtypes(_sft(spark, d))
