"""Look-ups and generators on hand-made profiles (misses, empty lists, time alignment)."""

from mixprep.operators import generate as G, lookup
from mixprep.plans import generate as W3

LISTS = {"live_list": "live", "video_list": "video/video", "goods_list": "goods", "ad_list": "video/ad"}
TIMES = {"live_ts": "live"}


def _sids(spark):
    rows = [(p, d, [p, p + 1, p + 2]) for d in ("live", "video/video", "goods", "video/ad") for p in range(1, 40)
            if p % 5 != 0]
    return spark.createDataFrame(rows, "pid long, domain string, sid_three array<int>")


def _profile(spark):
    return spark.createDataFrame([
        (1, [1, 5, 2, None, 3], [100, 101, 102, 103, 104], [7, 8], None, []),   # 5 and None miss mid-sequence
        (2, None, None, [], None, [10]),                                            # only one ad token
        (3, list(range(1, 31)), list(range(1000, 1030)), list(range(1, 11)), [2], [3]),  # more than 20 items
    ], "user_id long, live_list array<bigint>, live_ts array<bigint>, video_list array<bigint>, "
       "goods_list array<bigint>, ad_list array<bigint>")


def test_profile_long_caps_before_dropping_and_keeps_time(spark):
    long_df = lookup.profile_to_long(_profile(spark), LISTS, TIMES, cap=20)
    rows = {(r.user_id, r.domain, r.pos): (r.pid, r.ts) for r in long_df.collect()}
    assert rows[(1, "live", 2)] == (2, 102)       # position kept, time stays with its item
    assert (1, "live", 3) not in rows             # NULL pid dropped
    assert max(p for (u, d, p) in rows if u == 3 and d == "live") == 19
    assert (2, "video/ad", 0) in rows and not any(u == 2 and d == "live" for (u, d, _) in rows)


def test_sequence_lookup_drops_misses_in_order(spark):
    long_df = lookup.profile_to_long(_profile(spark), LISTS, TIMES, cap=20)
    seq = {(r.user_id, r.domain): r.seq for r in lookup.sequence_lookup(long_df, _sids(spark)).collect()}
    live1 = seq[(1, "live")]
    assert [e.pos for e in live1] == [0, 2, 4] and [e.ts for e in live1] == [100, 102, 104]
    assert live1[0].token == "<|living_begin|><s_a_1><s_b_2><s_c_3>"
    assert len(seq[(3, "live")]) == 16            # first 20 positions, 4 misses (5, 10, 15, 20)


def test_user_samples_filter_and_render(spark):
    long_df = lookup.profile_to_long(_profile(spark), LISTS, TIMES, cap=20)
    nxt, rec = W3.user_samples(long_df, _sids(spark), min_tokens=3)
    n = {int(r.key): r for r in nxt.collect()}
    assert set(n) == {1, 3}                       # user 2 has a single token
    p1 = n[1].prompt
    assert p1.startswith(G.USER_PROMPT_HEAD) and "【100】\n  --:-- [直播-关注]" in p1 and "video_0" in p1
    assert n[1].response == '<think>\n</think>\n["<|video_begin|><s_a_8><s_b_9><s_c_10>"]'
    assert p1.count("\n  --:-- [") == 4           # 5 events, last one is the target
    assert n[3].prompt.count("\n  --:-- [") == 20  # 26 events: history cut to 20 lines
    r3 = [r for r in rec.collect() if r.key == "3"][0]
    assert r3.prompt.count("\n") == 4 and r3.response.endswith(", ".join([
        "<|living_begin|><s_a_1><s_b_2><s_c_3>", "<|video_begin|><s_a_1><s_b_2><s_c_3>",
        "<|prod_begin|><s_a_2><s_b_3><s_c_4>"]))


def test_item_samples_unknown_domain_dropped(spark):
    caps = spark.createDataFrame([(1, "goods", "红色杯子。容量大。耐热。好用"), (2, "mars", "x"), (5, "goods", "miss")],
                                 "pid long, domain string, caption string")
    sids = spark.createDataFrame([(1, "goods", [1, 2, 3]), (2, "mars", [4, 5, 6])], "pid long, domain string, sid_three array<int>")
    out = {(r.task, r.key): r for r in W3.item_samples(caps, sids).collect()}
    assert set(out) == {("desc2tok", "goods:1"), ("tok2desc", "goods:1")}
    assert [r.pid for r in G.unknown_domain_rows(caps).collect()] == [2]
    assert out[("desc2tok", "goods:1")].response == "<think>红色杯子。容量大。耐热</think>\n<|prod_begin|><s_a_1><s_b_2><s_c_3>"
    assert out[("tok2desc", "goods:1")].prompt == "给定商品token<|prod_begin|><s_a_1><s_b_2><s_c_3>这件商品有什么特点？/think"


def test_next_item_shuffled_order_is_deterministic_permutation(spark):
    long_df = lookup.profile_to_long(_profile(spark), LISTS, TIMES, cap=20)
    users = W3.user_table(long_df, _sids(spark))
    a = {r.user_id: r.prompt for r in G.next_item(users, order="shuffled").collect()}
    b = {r.user_id: r.prompt for r in G.next_item(users.repartition(3), order="shuffled").collect()}
    d = {r.user_id: r.prompt for r in G.next_item(users).collect()}
    assert a == b and a[3] != d[3]
    assert sorted(a[1].split("\n")) != [] and len(a[1].split("\n")) == len(d[1].split("\n"))


def test_short_template_texts(spark):
    caps = spark.createDataFrame([(1, "live", "主播很有趣，" + "长" * 60)], "pid long, domain string, caption string")
    sids = spark.createDataFrame([(1, "live", [1, 2, 3]), (1, "video/video", [4, 5, 6]), (2, "video/video", [7, 8, 9])],
                                 "pid long, domain string, sid_three array<int>")
    prof = spark.createDataFrame([(9, [1], [5], [1, 2], None, None), (8, None, None, [2], None, None)],
                                 "user_id long, live_list array<bigint>, live_ts array<bigint>, "
                                 "video_list array<bigint>, goods_list array<bigint>, ad_list array<bigint>")
    long_df = lookup.profile_to_long(prof, LISTS, TIMES, cap=10)
    out = {(r.task, r.key): r for r in W3.generate_short(caps, sids, long_df).collect()}
    tok = "<|living_begin|><s_a_1><s_b_2><s_c_3>"
    head = ("主播很有趣，" + "长" * 60)[:50]
    d = out[("desc2tok", "live:1")]
    assert d.system == "作为主播标识生成助手，你需要根据给定的主播描述输出匹配的主播token。"
    assert d.response == f"<think>{head}</think>\n{tok}"
    t = out[("tok2desc", "live:1")]
    assert t.prompt == f"给定直播token{tok}这件直播有什么特点？/think"
    n = out[("next_item", "9")]
    assert n.prompt == ("【用户交互历史】：\n  --:-- [行为] " + tok + "\n  --:-- [行为] <|video_begin|><s_a_4><s_b_5><s_c_6>"
                        "\n请预测该用户下一个可能交互的内容。")
    assert n.response == '<think>\n</think>\n["<|video_begin|><s_a_7><s_b_8><s_c_9>"]'
    assert ("next_item", "8") not in out and ("interest", "8") in out
    assert out[("interest", "9")].response.endswith("该用户最近喜欢的内容有: <|video_begin|><s_a_7><s_b_8><s_c_9>")
