"""Reference-shaped inputs derived from the driver's tables (see FIXTURES.md).

The reference reads an item->sid table, an item->caption table, a wide user
profile, SFT samples and Alpaca samples. None ships with it, so each is a view
over the driver's tables here; the DuckDB twin of every view lives in
``oracle_queries.py``. All views are lazy DataFrames; nothing is collected.
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession, functions as F

from mixprep.operators.normalize import chat_to_alpaca

# Fixed fixture parameters (FIXTURES.md).
DOMAIN_BY_MOD4 = ("goods", "live", "video/video", "video/ad")          # p_partkey % 4
DOMAIN_BY_EVENT = {"purchase": "goods", "view": "live", "click": "video/video", "signup": "video/ad", "error": "goods"}
EVENT_CODE = {"purchase": 0, "view": 1, "click": 2, "signup": 3, "error": 0}
CATEGORY_BY_LANG = {"en": "rec", "fr": "item", "de": "user"}          # everything else: world
# A profile row holds a user's events of one block of this many event ids, so its lists are bounded and whole.
PROFILE_BLOCK, USER_STEP = 100_000, 1_000_000_000

# Wide profile columns of the reference, and the domain each list belongs to.
PROFILE_LISTS = {
    "live_hist_author_id_list": "live",
    "video_sampled_pid_list": "video/video",
    "ec_good_click_item_id_list_extend": "goods",
    "outer_loop_history_action_pid_list_click": "video/ad",
}
PROFILE_TIMES = {"live_hist_timestamp_list": "live", "video_ts_list": "video/video"}


_TABLES: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; the (lazy) DataFrame is reused per session, so its files are
    listed and its footers read once, and repeated uses have identical plans."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    per = _TABLES.setdefault(spark, {})
    if path not in per:
        per[path] = spark.read.parquet(path)
    return per[path]


def _per_session(fn):
    """Reuse a fixture view per (session, arguments): views are lazy plans, so reuse is
    safe; it saves rebuilding expressions and gives identical (reusable) subplans."""
    cache: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()

    def wrapper(spark: SparkSession, sf_dir: str, *args):
        per = cache.setdefault(spark, {})
        key = (sf_dir.rstrip("/"),) + args
        if key not in per:
            per[key] = fn(spark, sf_dir, *args)
        return per[key]
    wrapper.__name__, wrapper.__doc__ = fn.__name__, fn.__doc__
    return wrapper


def _case(col, mapping: dict, default=None):
    expr = None
    for k, v in mapping.items():
        cond = col == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def epoch_micros(ts):
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ, from its calendar fields only,
    so the session time zone (and its daylight-saving jumps) never enters."""
    return (F.unix_date(ts.cast("date")).cast("long") * 86_400_000_000
            + F.hour(ts).cast("long") * 3_600_000_000 + F.minute(ts).cast("long") * 60_000_000
            + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long"))


def _domain_of_key(key):
    return _case(key % 4, dict(enumerate(DOMAIN_BY_MOD4)))


@_per_session
def item_sid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pid, domain, sid_three of every part."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("pid"),
        _domain_of_key(F.col("p_partkey")).alias("domain"),
        F.array(F.expr("cast(substring(p_brand, 7) as int)"), F.col("p_size").cast("int"),
                (F.col("p_partkey") % 8192).cast("int")).alias("sid_three"))


@_per_session
def max_part(spark: SparkSession, sf_dir: str) -> int:
    """The largest part key: ids above it do not exist, so look-ups of them miss."""
    return int(table(spark, sf_dir, "part").agg(F.max("p_partkey")).first()[0])


@_per_session
def item_caption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pid, domain, caption; every fifth caption is a whole document text, every tenth belongs to an id that does not exist."""
    p = table(spark, sf_dir, "part")
    d = table(spark, sf_dir, "documents").select(F.col("doc_id"), F.col("text"))
    j = p.join(d, p["p_partkey"] == d["doc_id"], "left")
    k = F.col("p_partkey")
    size = F.col("p_size").cast("string")

    def joined(sep):
        return F.concat(F.col("p_name"), F.lit(sep), F.col("p_type"), F.lit(sep), F.col("p_brand"),
                        F.lit(sep + "size "), size)
    short = F.when(k % 3 == 0, joined("。")).when(k % 3 == 1, joined("，")).otherwise(joined(" "))
    long_ = F.when(k % 5 == 0, F.col("text"))
    pid = F.when(k % 10 == 3, k + F.lit(max_part(spark, sf_dir))).otherwise(k)
    return j.select(pid.alias("pid"), _domain_of_key(k).alias("domain"), F.coalesce(long_, short).alias("caption"))


@_per_session
def behaviour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form of the user profile: user_id, event_id, ts, ts_us, domain, pid, one row per event.

    About a tenth of the item ids lie above the largest part key and miss. ``user_id`` tells the blocks of
    ``PROFILE_BLOCK`` event ids of one user apart.
    """
    e = table(spark, sf_dir, "events")
    code = _case(F.col("event_type"), EVENT_CODE, 3)
    fold = 4 * -(-max_part(spark, sf_dir) * 11 // 40)
    pid = (F.round(F.col("value") * 100).cast("long") * 4 + code) % fold
    ts_us = epoch_micros(F.col("ts"))
    user = F.col("user_id") + F.floor(F.col("event_id") / PROFILE_BLOCK) * USER_STEP
    return e.select(user.cast("long").alias("user_id"), "event_id", "ts", ts_us.alias("ts_us"),
                    _case(F.col("event_type"), DOMAIN_BY_EVENT).alias("domain"), pid.alias("pid"))


@_per_session
def behaviour_head(spark: SparkSession, sf_dir: str, k: int | None = None) -> DataFrame:
    """Events per (user, domain) in time order, with 0-based ``pos``; the first ``k`` alone where given.

    ``row_number() <= k`` is planned as WindowGroupLimit: each map task keeps at
    most ``k`` rows per key before the shuffle, so a hot user cannot pile up.
    """
    from pyspark.sql import Window
    w = Window.partitionBy("user_id", "domain").orderBy("ts_us", "event_id")
    b = behaviour(spark, sf_dir).withColumn("_rn", F.row_number().over(w))
    if k is not None:
        b = b.filter(F.col("_rn") <= k)
    return b.withColumn("pos", (F.col("_rn") - 1).cast("int")).drop("_rn")


@_per_session
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide user profile with the reference's list columns; a list holds all events of its block."""
    h = behaviour_head(spark, sf_dir)
    aggs = []
    for col, dom in PROFILE_LISTS.items():
        aggs.append(F.sort_array(F.collect_list(F.when(F.col("domain") == dom, F.struct("pos", "pid")))).alias(col))
    for col, dom in PROFILE_TIMES.items():
        aggs.append(F.sort_array(F.collect_list(F.when(F.col("domain") == dom, F.struct("pos", "ts_us")))).alias(col))
    wide = h.groupBy("user_id").agg(*aggs)
    out = [F.col("user_id")]
    out += [F.transform(F.col(c), lambda s: s["pid"]).alias(c) for c in PROFILE_LISTS]
    out += [F.transform(F.col(c), lambda s: s["ts_us"]).alias(c) for c in PROFILE_TIMES]
    return wide.select(*out)


@_per_session
def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SFT samples with a category: the first half of a document is the prompt."""
    d = table(spark, sf_dir, "documents")
    half = F.floor(F.col("n_chars") / F.lit(2.0)).cast("int")
    d = d.withColumn("_half", half)
    return d.select(
        F.col("doc_id").alias("sample_id"),
        _case(F.col("lang"), CATEGORY_BY_LANG, "world").alias("category"),
        F.concat(F.lit("lang="), F.col("lang"), F.lit(" source="), F.col("source")).alias("system"),
        F.expr("substring(text, 1, _half)").alias("prompt"),
        F.expr("substring(text, _half + 1)").alias("response"),
    )


@_per_session
def alpaca(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alpaca samples (N3) from the conversations table."""
    return chat_to_alpaca(table(spark, sf_dir, "conversations"))
