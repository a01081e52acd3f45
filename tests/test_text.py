"""Row-wise text operators against plain-Python versions of the reference's semantics."""


from mixprep.functions import text as T

PY_SPACES = [c for c in map(chr, range(0x110000)) if c.isspace()]


def _one(spark, rows, expr, schema="s string"):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_py_strip_matches_python_for_every_whitespace(spark):
    assert len(PY_SPACES) == 29
    rows = [(f"{c}x y{c}{c}",) for c in PY_SPACES] + [("",), ("   ",), ("　a\nb ",), ("\u001cz\u001f",)]
    got = _one(spark, rows, T.py_strip("s"))
    assert got == [r[0].strip() for r in rows]


def py_summary(c, n=50):
    for sep in ["。", "；", "，", " "]:
        if sep in c:
            return sep.join(c.split(sep)[:3])[:n]
    return c[:n]


def test_caption_summary(spark):
    caps = ["a。b。c。d", "x；y", "p，q，r，s，t", "one two three four", "nosep" * 20, "。", "a b", "长" * 80,
            "a，b c。d", "😀😀，😀"]
    got = _one(spark, [(c,) for c in caps], T.caption_summary("s"))
    assert got == [py_summary(c) for c in caps]


def test_sid_token_and_unknown_domain(spark):
    df = spark.createDataFrame([("goods", [1, 2, 3]), ("live", [4, 5, 6]), ("mars", [7, 8, 9]), ("goods", [1, 2])],
                               "d string, sid array<int>")
    got = [r[0] for r in df.select(T.sid_token("d", "sid")).collect()]
    assert got == ["<|prod_begin|><s_a_1><s_b_2><s_c_3>", "<|living_begin|><s_a_4><s_b_5><s_c_6>",
                   "<s_a_7><s_b_8><s_c_9>", None]


def test_history_prefix(spark):
    rows = [([["u1", "a1"], ["u2", "a2"]],), ([],), (None,)]
    got = _one(spark, rows, T.history_prefix("h"), "h array<array<string>>")
    assert got[0] == "Previous User: u1\nPrevious Assistant: a1\n\nPrevious User: u2\nPrevious Assistant: a2\n\n"
    assert got[1] == "" and got[2] == ""


def test_char_len_counts_code_points_and_nulls(spark):
    df = spark.createDataFrame([("你好，🤦", None, "ab")], "a string, b string, c string")
    assert df.select(T.char_len("a", "b", "c")).first()[0] == 6


def test_weight_by_content_first_match_and_scopes(spark):
    w = [("que", 2.0), ("der", 5.0), ("the", 1.5)]
    df = spark.createDataFrame([("", "the der", ""), ("xx", "none", ""), ("qu", "e then", ""), ("que", "", "")],
                               "system string, prompt string, response string")
    j = [r[0] for r in df.select(T.weight_by_content(w, scope="joined")).collect()]
    s = [r[0] for r in df.select(T.weight_by_content(w, scope="separate")).collect()]
    assert j == [5.0, 1.0, 2.0, 2.0]
    assert s == [5.0, 1.0, 1.5, 2.0]


def test_chat_render(spark):
    df = spark.createDataFrame([(None, "p", "r")], "system string, prompt string, response string")
    full, pre = df.select(T.chat_full_text("system", "prompt", "response"), T.chat_prefix_text("system", "prompt")).first()
    assert pre == "<|im_start|>system\n<|im_end|>\n<|im_start|>user\np<|im_end|>\n<|im_start|>assistant\n"
    assert full == pre + "r<|im_end|>\n"


def test_category_from_name_and_alias(spark):
    df = spark.createDataFrame([("懂推荐1.jsonl",), ("懂物料part2.jsonl",), ("other.jsonl",)], "n string")
    got = [r[0] for r in df.select(T.category_from_name("n", ["懂推荐", "懂物料"])).collect()]
    assert got == ["懂推荐", "懂物料", None]
    assert _one(spark, [("懂世界_ext",)], T.alias_merge("s")) == ["懂世界"]


def test_history_with_missing_parts_and_misfits(spark):
    import pytest
    from pyspark.sql import functions as F
    from mixprep.functions.text import history_prefix
    from mixprep.operators.normalize import orphan_turns, chat_to_alpaca, split_misfits
    df = spark.createDataFrame([(1, [["u1", None], ["u2", "a2"]]), (2, [["u3"]]), (3, None), (4, [None])], "id long, history array<array<string>>")
    good, bad = split_misfits(df)
    assert sorted(r.id for r in bad.collect()) == [2, 4]
    text = {r.id: r.t for r in good.select("id", history_prefix("history").alias("t")).collect()}
    assert text == {1: "Previous User: u1\nPrevious Assistant: None\n\nPrevious User: u2\nPrevious Assistant: a2\n\n", 3: ""}
    with pytest.raises(Exception):
        df.select(history_prefix("history")).collect()
    conv = spark.createDataFrame([(1, 0, "system", "z first"), (1, 1, "system", "a second"), (1, 2, "user", "q"), (1, 3, "assistant", "r"),
                                  (None, 0, "user", "x"), (None, 1, "assistant", "y")], "conv_id long, turn int, role string, text string")
    assert [(r.conv_id, r.instruction) for r in chat_to_alpaca(conv).collect()] == [(1, "z first")]
    assert orphan_turns(conv).count() == 2


def test_fixed_texts_letter_by_letter():
    """The texts that must equal the reference's, written out again."""
    from mixprep.operators import generate as G
    assert G.DESC2TOK_SYSTEM["goods"] == "作为商品标识生成助手，你需要根据给定的商品描述输出匹配的商品token。"
    assert G.DESC2TOK_SYSTEM["video/ad"] == "你擅长根据广告内容、风格和主题描述，输出对应的广告token。"
    assert G.DESC2TOK_PROMPT["video/video"] == "基于这段短视频描述，生成最匹配的短视频token："
    assert G.TOK2DESC_SYSTEM["live"] == "你是一名主播内容理解助手，请根据给定的主播token生成准确、自然的主播内容描述。"
    assert G.TOK2DESC_PROMPT == "给定{label}token{token}这件{label}有什么特点？/think"
    assert G.REC_SYSTEM == "你负责根据用户多域行为理解用户兴趣偏好，并输出该用户在各场景中的目标内容。"
    assert [x[1] for x in G.REC_LINES] == ["用户在直播域: 关注了主播 ", "用户视频行为: 深度观看了 ", "用户购物行为: 浏览了商品 ", "用户广告行为: 点击了 "]
    assert G.USER_EVENT_ACTION == {"live": "直播-关注", "video": "视频-观看", "goods": "商品-购买", "ad": "广告-点击"}
    assert G.SHORT_USER_TAIL == "\n请预测该用户下一个可能交互的内容。"
    assert G.SHORT_REC_RESPONSE == "<think>根据用户多域行为，偏好相关直播/视频/商品内容。</think>\n该用户最近喜欢的内容有: "
