"""Instruction-sample generators (G1-G5) over look-up results.

Each generator is a projection of an equi-join result; caps (G5) are hash
samples taken on the keys *before* rendering.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from mixprep.functions.text import DOMAIN_LABEL, caption_summary, domain_label
from mixprep.operators.sampling import sample_n

# ---------------------------------------------------------------------------
# Task texts that must equal the reference's.
# ---------------------------------------------------------------------------

# Description -> token: system text per domain.
DESC2TOK_SYSTEM = {
    "goods": "作为商品标识生成助手，你需要根据给定的商品描述输出匹配的商品token。",
    "live": "作为主播标识生成助手，你需要根据给定的主播描述输出匹配的主播token。",
    "video/ad": "你擅长根据广告内容、风格和主题描述，输出对应的广告token。",
    "video/video": "作为短视频标识生成助手，你需要根据给定的短视频描述输出匹配的短视频token。",
}
# Description -> token: prompt lead per domain (the caption follows, then "/think").
DESC2TOK_PROMPT = {
    "goods": "下面是一段商品描述，请返回匹配的商品token：",
    "live": "请从以下主播描述中推断并生成对应的主播token：",
    "video/ad": "请根据这段广告dense caption生成匹配的广告token：",
    "video/video": "基于这段短视频描述，生成最匹配的短视频token：",
}
# Token -> description: system text per domain.
TOK2DESC_SYSTEM = {
    "goods": "你是一个智能商品解说助手，可以根据输入的商品token创建生动、准确的商品描述。",
    "live": "你是一名主播内容理解助手，请根据给定的主播token生成准确、自然的主播内容描述。",
    "video/ad": "你是一名广告内容理解助手，请根据给定的广告token生成准确、自然的广告内容描述。",
    "video/video": "作为视频内容解析助手，你需要根据提供的短视频标识给出精准的视频内容描述。",
}
# Token -> description prompt, in both templates.
TOK2DESC_PROMPT = "给定{label}token{token}这件{label}有什么特点？/think"
THINK_SUFFIX = "/think"
THINK_OPEN, THINK_CLOSE = "<think>", "</think>\n"

# Next-item (user) samples.
USER_PROMPT_HEAD = "【用户交互历史】：\n"
USER_EVENT_ACTION = {"live": "直播-关注", "video": "视频-观看", "goods": "商品-购买", "ad": "广告-点击"}
USER_EVENT_TIME_PREFIX = {"video": "video_", "goods": "ec_", "ad": "ad_"}
USER_HISTORY_LINES = 20

# Multi-domain interest (rec) samples.
REC_SYSTEM = "你负责根据用户多域行为理解用户兴趣偏好，并输出该用户在各场景中的目标内容。"
REC_PROMPT_HEAD = "以下是一个用户的多域历史行为信息：\n"
REC_LINES = (  # (domain, line lead, cap)
    ("live", "用户在直播域: 关注了主播 ", 8),
    ("video", "用户视频行为: 深度观看了 ", 8),
    ("goods", "用户购物行为: 浏览了商品 ", 8),
    ("ad", "用户广告行为: 点击了 ", 5),
)
REC_THINK = "根据用户多域行为分析，推荐相关内容。"
REC_TARGET_DOMAINS = ("live", "video", "goods")

# Order of the per-user domain arrays (name -> domain value).
USER_DOMAINS = {"live": "live", "video": "video/video", "goods": "goods", "ad": "video/ad"}


def _lookup(col: Column, table: dict) -> Column:
    expr = None
    for k, v in table.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr


def _think(summary: Column, answer: Column) -> Column:
    return F.concat(F.lit(THINK_OPEN), summary, F.lit(THINK_CLOSE), answer)


def cap_items(items: DataFrame, max_per_task: int | None, seed=42) -> DataFrame:
    """``max_per_task`` items (hash sample on the item key), before rendering."""
    if max_per_task is None:
        return items
    from mixprep.session import stage
    keyed = stage(items.select("pid", "domain", F.concat(F.col("domain"), F.lit(":"), F.col("pid").cast("string")).alias("_item_key")), "item-keys")
    return items.join(sample_n(keyed, max_per_task, "_item_key", seed=seed).drop("_item_key"), ["pid", "domain"], "left_semi")


def fill(template: str, **columns: Column) -> Column:
    """``template`` with ``{name}`` replaced by the column of that name."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[columns[p] if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def _sample(task: str, system: Column, prompt: Column, response: Column) -> Column:
    return F.struct(F.lit(task).alias("task"), system.alias("system"), prompt.alias("prompt"), response.alias("response"))


def desc_to_token() -> Column:
    """G1: caption -> token, as a sample struct over J1's columns. NULL texts where the domain is unknown."""
    d, caption = F.col("domain"), F.col("caption")
    return _sample("desc2tok", _lookup(d, DESC2TOK_SYSTEM), F.concat(_lookup(d, DESC2TOK_PROMPT), caption, F.lit(THINK_SUFFIX)),
                   _think(caption_summary(caption), F.col("token")))


def token_to_desc() -> Column:
    """Token -> caption."""
    d, caption = F.col("domain"), F.col("caption")
    return _sample("tok2desc", _lookup(d, TOK2DESC_SYSTEM), fill(TOK2DESC_PROMPT, label=domain_label(d, DOMAIN_LABEL), token=F.col("token")),
                   _think(caption_summary(caption), caption))


def item_tasks(items: DataFrame, *samples: Column) -> DataFrame:
    """(pid, domain, task, system, prompt, response): every sample struct of every item of J1's output, from one pass
    over the join. Rows of an unknown domain get NULL texts and are left out (see ``unknown_domain_rows``)."""
    out = items.select("pid", "domain", F.explode(F.array(*samples)).alias("s")).select("pid", "domain", "s.*")
    return out.filter(F.col("system").isNotNull() & F.col("prompt").isNotNull())


def all_tokens(users: DataFrame) -> Column:
    """Resolved tokens in domain order live, video, goods, ad."""
    return F.concat(*[F.col(f"{n}_tokens") for n in USER_DOMAINS])


def _indexed_event(prefix: str, action: str):
    def make(t, i):
        return F.struct(F.concat(F.lit(prefix), i.cast("string")).alias("t"), F.lit(action).alias("a"), t.alias("tok"))
    return make


def event_lines(users: DataFrame) -> Column:
    """One struct (time label, action, token) per event, domain order.

    Live events carry their real time (zipped before the look-up); the others get
    ``video_i`` / ``ec_i`` / ``ad_i`` with ``i`` the 0-based index among resolved tokens.
    """
    parts = []
    live = F.filter(F.col("live_seq"), lambda e: e["ts"].isNotNull())
    parts.append(F.transform(live, lambda e: F.struct(e["ts"].cast("string").alias("t"),
                                                      F.lit(USER_EVENT_ACTION["live"]).alias("a"),
                                                      e["token"].alias("tok"))))
    for name in ("video", "goods", "ad"):
        parts.append(F.transform(F.col(f"{name}_tokens"),
                                 _indexed_event(USER_EVENT_TIME_PREFIX[name], USER_EVENT_ACTION[name])))
    return F.concat(*parts)


def render_events(events: Column, max_lines: int = USER_HISTORY_LINES) -> Column:
    """``【{t}】\\n  --:-- [{a}] {tok}`` per event, first ``max_lines``, newline-joined."""
    lines = F.transform(F.slice(events, 1, max_lines),
                        lambda e: F.concat(F.lit("【"), e["t"], F.lit("】\n  --:-- ["), e["a"], F.lit("] "), e["tok"]))
    return F.array_join(lines, "\n")


def shuffled_events(events: Column, user_col: str, seed=42) -> Column:
    """D4 option: the reference shuffles a user's events; here the order is that of
    ``md5(seed:user:index)``, the same under any partitioning."""
    keyed = F.transform(events, lambda e, i: F.struct(
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(user_col).cast("string"), i.cast("string"))).alias("h"),
        e.alias("e")))
    return F.transform(F.array_sort(keyed), lambda x: x["e"])


def next_item(users: DataFrame, user_col: str = "user_id", order: str = "by_domain", seed=42) -> DataFrame:
    """History of all events but the last (first 20 lines) -> the last event's token.

    ``order='by_domain'`` keeps domain order (live, video, goods, ad, as the older
    script); ``'shuffled'`` applies a seeded per-user shuffle (as the newer one).
    The response names the target as a one-element JSON array after an empty
    thinking block.
    """
    ev = event_lines(users)
    if order == "shuffled":
        ev = shuffled_events(ev, user_col, seed)
    elif order != "by_domain":
        raise ValueError(f"unknown order {order!r}")
    u = users.withColumn("_ev", ev).filter(F.size("_ev") > 0)
    hist = F.slice(F.col("_ev"), 1, F.size("_ev") - 1)
    target = F.element_at(F.col("_ev"), -1)["tok"]
    return u.select(
        user_col, F.lit("next_item").alias("task"),
        F.lit("").alias("system"),
        F.concat(F.lit(USER_PROMPT_HEAD), render_events(hist)).alias("prompt"),
        F.concat(F.lit("<think>\n</think>\n[\""), target, F.lit("\"]")).alias("response"))


def rec_lines(users: DataFrame) -> Column:
    """One line per domain with tokens, ``lead + ', '.join(tokens[:cap])``, newline-joined."""
    lines = []
    for name, lead, cap in REC_LINES:
        toks = F.col(f"{name}_tokens")
        lines.append(F.when(F.size(toks) > 0, F.concat(F.lit(lead), F.array_join(F.slice(toks, 1, cap), ", "))))
    return F.array_join(F.array(*lines), "\n")


def interest(users: DataFrame, user_col: str = "user_id") -> DataFrame:
    """Multi-domain behaviour lines -> one target per domain (first token of live, video, goods)."""
    targets = F.array_join(F.array(*[F.get(F.col(f"{n}_tokens"), 0) for n in REC_TARGET_DOMAINS]), ", ")
    return users.select(
        user_col, F.lit("interest").alias("task"),
        F.lit(REC_SYSTEM).alias("system"),
        F.concat(F.lit(REC_PROMPT_HEAD), rec_lines(users)).alias("prompt"),
        _think(F.lit(REC_THINK), targets).alias("response"))


def eligible_users(users: DataFrame, min_tokens: int = 3, max_users: int | None = None,
                   user_col: str = "user_id", seed=42) -> DataFrame:
    """F5 + G5: users with at least ``min_tokens`` resolved tokens; optional hash-sampled cap."""
    from mixprep.operators.filters import filter_min_count
    u = filter_min_count(users.withColumn("n_tokens", F.size(all_tokens(users))), "n_tokens", min_tokens)
    if max_users is not None:
        u = sample_n(u, max_users, user_col, seed=seed)
    return u


# ---------------------------------------------------------------------------
# Short template (the older generator): fixed values that must equal the reference's.
# "{label}" marks where the domain label goes.
# ---------------------------------------------------------------------------
SHORT_DESC2TOK_SYSTEM = "作为{label}标识生成助手，你需要根据给定的{label}描述输出匹配的{label}token。"
SHORT_DESC2TOK_PROMPT = "下面是一段{label}描述，请返回匹配的{label}token："
SHORT_TOK2DESC_LABEL = {"goods": "商品", "live": "直播", "video/ad": "广告", "video/video": "短视频"}
SHORT_TOK2DESC_SYSTEM = {
    "goods": "你是一个智能商品解说助手，可以根据输入的商品token创建生动、准确的商品描述。",
    "video/ad": "你是一名广告内容理解助手，请根据给定的广告token生成准确、自然的广告内容描述。",
    "live": "你是一名直播内容理解助手，请根据给定的直播token生成准确、自然的直播内容描述。",
    "video/video": "作为视频内容解析助手，你需要根据提供的短视频标识给出精准的视频内容描述。",
}
SHORT_CAPTION_HEAD = 50
SHORT_ITEMS_PER_DOMAIN = 10
SHORT_USER_DOMAINS = {"live": "live", "video": "video/video", "goods": "goods"}
SHORT_USER_LINE = "  --:-- [行为] "
SHORT_USER_TAIL = "\n请预测该用户下一个可能交互的内容。"
SHORT_REC_LINES = (
    ("live", "用户直播行为: 观看了 ", 5),
    ("video", "用户视频行为: 深度观看了 ", 5),
    ("goods", "用户购物行为: 浏览了商品 ", 5),
)
SHORT_REC_RESPONSE = "<think>根据用户多域行为，偏好相关直播/视频/商品内容。</think>\n该用户最近喜欢的内容有: "


def short_desc_to_token() -> Column:
    """G1, short template: label-filled texts, the caption's first 50 characters as the thought."""
    lab = domain_label(F.col("domain"), DOMAIN_LABEL)
    return _sample("desc2tok", fill(SHORT_DESC2TOK_SYSTEM, label=lab), F.concat(fill(SHORT_DESC2TOK_PROMPT, label=lab), F.col("caption")),
                   _think(F.substring("caption", 1, SHORT_CAPTION_HEAD), F.col("token")))


def short_token_to_desc() -> Column:
    """G2, short template (the live label reads differently in this direction)."""
    lab = _lookup(F.col("domain"), SHORT_TOK2DESC_LABEL)
    return _sample("tok2desc", _lookup(F.col("domain"), SHORT_TOK2DESC_SYSTEM), fill(TOK2DESC_PROMPT, label=lab, token=F.col("token")),
                   _think(F.substring("caption", 1, SHORT_CAPTION_HEAD), F.col("caption")))


def short_all_tokens() -> Column:
    return F.concat(*[F.col(f"{n}_tokens") for n in SHORT_USER_DOMAINS])


def short_next_item(users: DataFrame, user_col: str = "user_id") -> DataFrame:
    """G3, short template: every token but the last as a history line -> the last (users with >= 2)."""
    allt = short_all_tokens()
    u = users.withColumn("_all", allt).filter(F.size("_all") >= 2)
    hist = F.slice(F.col("_all"), 1, F.size("_all") - 1)
    lines = F.array_join(F.transform(hist, lambda t: F.concat(F.lit(SHORT_USER_LINE), t)), "\n")
    return u.select(
        user_col, F.lit("next_item").alias("task"), F.lit("").alias("system"),
        F.concat(F.lit(USER_PROMPT_HEAD), lines, F.lit(SHORT_USER_TAIL)).alias("prompt"),
        F.concat(F.lit("<think>\n</think>\n[\""), F.element_at(F.col("_all"), -1), F.lit("\"]")).alias("response"))


def short_interest(users: DataFrame, user_col: str = "user_id") -> DataFrame:
    """G4, short template: up to 5 tokens per domain line -> the user's last token (users with >= 1)."""
    allt = short_all_tokens()
    u = users.withColumn("_all", allt).filter(F.size("_all") >= 1)
    lines = []
    for name, lead, cap in SHORT_REC_LINES:
        toks = F.col(f"{name}_tokens")
        lines.append(F.when(F.size(toks) > 0, F.concat(F.lit(lead), F.array_join(F.slice(toks, 1, cap), ", "))))
    return u.select(
        user_col, F.lit("interest").alias("task"), F.lit(REC_SYSTEM).alias("system"),
        F.concat(F.lit(REC_PROMPT_HEAD), F.array_join(F.array(*lines), "\n")).alias("prompt"),
        F.concat(F.lit(SHORT_REC_RESPONSE), F.element_at(F.col("_all"), -1)).alias("response"))


def unknown_domain_rows(df: DataFrame, domain_col: str = "domain") -> DataFrame:
    """N8 quarantine: rows whose domain has no prefix, label or template (the reference would
    raise on them; the generators leave them out, and this returns them for inspection)."""
    known = list(DESC2TOK_SYSTEM)
    return df.filter(F.col(domain_col).isNull() | ~F.col(domain_col).isin(known))
