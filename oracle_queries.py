"""Independent DuckDB SQL for every registered query (the correctness oracle).

Each query is plain SQL over the driver's pre-registered views. The fixture views
of ``mixprep.plans.fixtures`` are re-stated here as CTEs, so the oracle never
touches Spark code. ``sql(name)`` returns the full statement.
"""

from __future__ import annotations

# Python's str.isspace() set, as one RE2 class (same code points as the Spark side).
WS = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

# Native tokenizer pattern (same as mixprep.functions.tokenize.TOKEN_PATTERN).
TOK = (r"<\|[a-z_]+\|>|<s_[abc]_[0-9]+>|</?think>|[\x{4e00}-\x{9fff}]|[\p{L}\p{N}_]+|[^\x{09}-\x{0d}\x{1c}-\x{20}"
       r"\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\p{L}\p{N}_]")

FIX: dict[str, str] = {}

FIX["item_sid"] = """
item_sid AS (
  SELECT p_partkey AS pid,
         CASE p_partkey % 4 WHEN 0 THEN 'goods' WHEN 1 THEN 'live' WHEN 2 THEN 'video/video' ELSE 'video/ad' END AS domain,
         [CAST(substr(p_brand, 7) AS INT), p_size, CAST(p_partkey % 8192 AS INT)] AS sid_three
  FROM part)"""

FIX["item_caption"] = """
item_caption AS (
  SELECT CASE WHEN p_partkey % 10 = 3 THEN p_partkey + (SELECT max(p_partkey) FROM part) ELSE p_partkey END AS pid,
         CASE p_partkey % 4 WHEN 0 THEN 'goods' WHEN 1 THEN 'live' WHEN 2 THEN 'video/video' ELSE 'video/ad' END AS domain,
         coalesce(CASE WHEN p_partkey % 5 = 0 THEN d.text END,
           CASE p_partkey % 3
             WHEN 0 THEN p_name || '。' || p_type || '。' || p_brand || '。size ' || CAST(p_size AS VARCHAR)
             WHEN 1 THEN p_name || '，' || p_type || '，' || p_brand || '，size ' || CAST(p_size AS VARCHAR)
             ELSE p_name || ' ' || p_type || ' ' || p_brand || ' size ' || CAST(p_size AS VARCHAR) END) AS caption
  FROM part LEFT JOIN documents d ON d.doc_id = p_partkey)"""

FIX["behaviour"] = """
behaviour AS (
  SELECT CAST(user_id + event_id // 100000 * 1000000000 AS BIGINT) AS user_id, event_id, ts, epoch_us(ts) AS ts_us,
         CASE event_type WHEN 'purchase' THEN 'goods' WHEN 'view' THEN 'live' WHEN 'error' THEN 'goods'
                         WHEN 'click' THEN 'video/video' WHEN 'signup' THEN 'video/ad' END AS domain,
         (CAST(round(value * 100) AS BIGINT) * 4
          + CASE event_type WHEN 'purchase' THEN 0 WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'error' THEN 0 ELSE 3 END)
         % (SELECT 4 * CAST(ceil(max(p_partkey) * 11 / 40.0) AS BIGINT) FROM part) AS pid
  FROM events)"""

FIX["behaviour_head"] = """
behaviour_head AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id, domain ORDER BY ts_us, event_id) - 1 AS INT) AS pos
  FROM behaviour)"""

FIX["profile"] = """
profile AS (
  SELECT user_id,
    coalesce(list(pid ORDER BY pos) FILTER (WHERE domain = 'live'), []::BIGINT[]) AS live_hist_author_id_list,
    coalesce(list(pid ORDER BY pos) FILTER (WHERE domain = 'video/video'), []::BIGINT[]) AS video_sampled_pid_list,
    coalesce(list(pid ORDER BY pos) FILTER (WHERE domain = 'goods'), []::BIGINT[]) AS ec_good_click_item_id_list_extend,
    coalesce(list(pid ORDER BY pos) FILTER (WHERE domain = 'video/ad'), []::BIGINT[]) AS outer_loop_history_action_pid_list_click,
    coalesce(list(ts_us ORDER BY pos) FILTER (WHERE domain = 'live'), []::BIGINT[]) AS live_hist_timestamp_list,
    coalesce(list(ts_us ORDER BY pos) FILTER (WHERE domain = 'video/video'), []::BIGINT[]) AS video_ts_list
  FROM behaviour_head GROUP BY user_id)"""

FIX["samples"] = """
samples AS (
  SELECT doc_id AS sample_id,
         CASE lang WHEN 'en' THEN 'rec' WHEN 'fr' THEN 'item' WHEN 'de' THEN 'user' ELSE 'world' END AS category,
         'lang=' || lang || ' source=' || source AS system,
         substr(text, 1, CAST(floor(n_chars / 2.0) AS BIGINT)) AS prompt,
         substr(text, CAST(floor(n_chars / 2.0) AS BIGINT) + 1) AS response
  FROM documents)"""

FIX["alpaca"] = """
alpaca AS (
  WITH t AS (SELECT conv_id, turn, role, text,
                    lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS nrole,
                    lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS ntext FROM conversations WHERE conv_id IS NOT NULL),
       p AS (SELECT conv_id, turn, text AS u, ntext AS a,
                    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back
             FROM t WHERE role = 'user' AND nrole = 'assistant'),
       s AS (SELECT conv_id, arg_min(text, turn) AS instruction FROM conversations WHERE role = 'system' GROUP BY conv_id)
  SELECT p.conv_id, coalesce(min(s.instruction), '') AS instruction,
         min(CASE WHEN back = 1 THEN u END) AS input, min(CASE WHEN back = 1 THEN a END) AS output,
         list([u, a] ORDER BY turn) FILTER (WHERE back > 1) AS history
  FROM p LEFT JOIN s USING (conv_id) GROUP BY p.conv_id)"""


def with_(names, body: str) -> str:
    return "WITH " + ",".join(FIX[n] for n in names) + "\n" + body


def char_len(*cols) -> str:
    return " + ".join(f"length(coalesce({c}, ''))" for c in cols)


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{WS}+|{WS}+$', '', 'g')"


def hrank(group: str, id_expr: str, seed: str) -> str:
    part = f"PARTITION BY {group} " if group else ""
    return f"row_number() OVER ({part}ORDER BY md5('{seed}:' || CAST({id_expr} AS VARCHAR)), {id_expr})"


def uniform(id_expr: str, seed: str) -> str:
    return f"(CAST(('0x' || substr(md5('{seed}:' || CAST({id_expr} AS VARCHAR)), 1, 13)) AS BIGINT) / CAST(4503599627370496 AS DOUBLE))"


def split_case(rn: str, n: str, ratio: float = 0.05, min_eval: int = 1) -> str:
    return f"CASE WHEN {rn} <= greatest({min_eval}, floor({n} * CAST({ratio} AS DOUBLE))) THEN 'eval' ELSE 'train' END"


Q: dict[str, str] = {}


def sql(name: str) -> str:
    return Q[name]


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


# Fixed texts are shared with the library (they are data, not logic).
from mixprep.operators import generate as _G  # noqa: E402
from mixprep.functions import text as _T  # noqa: E402


def case_map(expr: str, table: dict, default: str | None = None) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in table.items())
    tail = f" ELSE {q(default)}" if default is not None else ""
    return f"CASE {expr} {whens}{tail} END"


def sid_token(dom: str, sid: str) -> str:
    return (f"{case_map(dom, _T.DOMAIN_PREFIX, '')} || '<s_a_' || CAST({sid}[1] AS VARCHAR) || '><s_b_' || "
            f"CAST({sid}[2] AS VARCHAR) || '><s_c_' || CAST({sid}[3] AS VARCHAR) || '>'")


def summary(c: str, n: int = 50) -> str:
    parts = " ".join(
        f"WHEN instr({c}, {q(sep)}) > 0 THEN substr(array_to_string(string_split({c}, {q(sep)})[1:3], {q(sep)}), 1, {n})"
        for sep in _T.SUMMARY_SEPARATORS)
    return f"CASE {parts} ELSE substr({c}, 1, {n}) END"


def history(h: str) -> str:
    return (f"coalesce(array_to_string(list_transform({h}, lambda p: 'Previous User: ' || coalesce(p[1], 'None') || "
            f"{q(chr(10) + 'Previous Assistant: ')} || coalesce(p[2], 'None') || {q(chr(10) * 2)}), ''), '')")


def prefix_text(s: str, p: str) -> str:
    nl = chr(10)
    return (f"{q('<|im_start|>system' + nl)} || coalesce({s}, '') || {q('<|im_end|>' + nl + '<|im_start|>user' + nl)} || "
            f"coalesce({p}, '') || {q('<|im_end|>' + nl + '<|im_start|>assistant' + nl)}")


def full_text(s: str, p: str, r: str) -> str:
    return f"{prefix_text(s, p)} || coalesce({r}, '') || {q('<|im_end|>' + chr(10))}"


def toks(x: str) -> str:
    return f"regexp_extract_all({x}, {q(TOK)})"


def ids(tl: str) -> str:
    return ("list_transform(" + tl + ", lambda t: CASE t WHEN '<|endoftext|>' THEN 0 WHEN '<|im_start|>' THEN 1 "
            "WHEN '<|im_end|>' THEN 2 ELSE CAST(3 + (CAST(('0x' || substr(md5(t), 1, 8)) AS BIGINT) % 151640) AS INT) END)")


def encoded(src: str, max_len: int, id_cols: str = "sample_id") -> str:
    """Rows of ``src`` with ids, labels, n_tokens_full, n_prefix (capped), n_supervised."""
    return f"""(SELECT {id_cols}, ids, n_tokens_full, least(np, len(ids)) AS n_prefix,
        greatest(len(ids) - np, 0) AS n_supervised,
        list_transform(ids, lambda x, i: CASE WHEN i - 1 < np THEN -100 ELSE x END) AS labels
      FROM (SELECT {id_cols}, {ids(f'ft[1:{max_len}]')} AS ids, len(ft) AS n_tokens_full, len(pt) AS np
            FROM (SELECT {id_cols}, {toks(full_text('system', 'prompt', 'response'))} AS ft,
                         {toks(prefix_text('system', 'prompt'))} AS pt FROM {src})))"""


WEIGHTS_SQL = "CAST(CASE category WHEN 'rec' THEN 1.0 WHEN 'item' THEN 2.0 WHEN 'user' THEN 5.0 WHEN 'world' THEN 0.5 ELSE 1.0 END AS DOUBLE)"

# ----- derived views shared by several oracle queries -----
FIX["items_j"] = f"""
items_j AS (
  SELECT c.pid, c.domain, c.caption, {sid_token('c.domain', 's.sid_three')} AS token
  FROM item_caption c JOIN item_sid s ON s.pid = c.pid AND s.domain = c.domain)"""


def item_samples_sql(src: str = "items_j") -> str:
    label = case_map("domain", _T.DOMAIN_LABEL)
    a, b, c, e = "给定", "token", "这件", "有什么特点？/think"
    doms = ", ".join(q(d) for d in _G.DESC2TOK_SYSTEM)
    nl = chr(10)
    return f"""
  SELECT 'desc2tok' AS task, domain || ':' || CAST(pid AS VARCHAR) AS key,
         {case_map('domain', _G.DESC2TOK_SYSTEM)} AS system,
         {case_map('domain', _G.DESC2TOK_PROMPT)} || caption || '/think' AS prompt,
         '<think>' || {summary('caption')} || {q('</think>' + nl)} || token AS response
  FROM {src} WHERE domain IN ({doms})
  UNION ALL
  SELECT 'tok2desc' AS task, domain || ':' || CAST(pid AS VARCHAR) AS key,
         {case_map('domain', _G.TOK2DESC_SYSTEM)} AS system,
         {q(a)} || {label} || {q(b)} || token || {q(c)} || {label} || {q(e)} AS prompt,
         '<think>' || {summary('caption')} || {q('</think>' + nl)} || caption AS response
  FROM {src} WHERE domain IN ({doms})"""


FIX["item_samples"] = f"\nitem_samples AS ({item_samples_sql()})"

FIX["seq"] = f"""
seq AS (
  SELECT h.user_id, h.domain, h.pos,
         CASE WHEN h.domain IN ('live', 'video/video') THEN h.ts_us END AS ts,
         {sid_token('h.domain', 's.sid_three')} AS token
  FROM behaviour_head h JOIN item_sid s ON s.pid = h.pid AND s.domain = h.domain
  WHERE h.pos < 20)"""

FIX["users"] = """
users AS (
  SELECT user_id,
    coalesce(list(token ORDER BY pos) FILTER (WHERE domain = 'live'), []::VARCHAR[]) AS live_tokens,
    coalesce(list(token ORDER BY pos) FILTER (WHERE domain = 'video/video'), []::VARCHAR[]) AS video_tokens,
    coalesce(list(token ORDER BY pos) FILTER (WHERE domain = 'goods'), []::VARCHAR[]) AS goods_tokens,
    coalesce(list(token ORDER BY pos) FILTER (WHERE domain = 'video/ad'), []::VARCHAR[]) AS ad_tokens
  FROM seq GROUP BY user_id)"""

FIX["elig"] = """
elig AS (
  SELECT * FROM (SELECT *, len(live_tokens) + len(video_tokens) + len(goods_tokens) + len(ad_tokens) AS n_tokens
                 FROM users) WHERE n_tokens >= 3)"""

FIX["ev"] = f"""
ev AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY dord, pos) AS e,
         count(*) OVER (PARTITION BY user_id) AS n_ev
  FROM (SELECT user_id, pos,
          CASE domain WHEN 'live' THEN 0 WHEN 'video/video' THEN 1 WHEN 'goods' THEN 2 ELSE 3 END AS dord,
          CASE domain WHEN 'live' THEN CAST(ts AS VARCHAR)
                      WHEN 'video/video' THEN 'video_' || CAST(ix AS VARCHAR)
                      WHEN 'goods' THEN 'ec_' || CAST(ix AS VARCHAR)
                      ELSE 'ad_' || CAST(ix AS VARCHAR) END AS t,
          {case_map('domain', {'live': _G.USER_EVENT_ACTION['live'], 'video/video': _G.USER_EVENT_ACTION['video'],
                               'goods': _G.USER_EVENT_ACTION['goods'], 'video/ad': _G.USER_EVENT_ACTION['ad']})} AS a,
          token AS tok, domain, ts
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id, domain ORDER BY pos) - 1 AS ix FROM seq))
  WHERE NOT (domain = 'live' AND ts IS NULL))"""


def event_line() -> str:
    return f"'【' || t || {q('】' + chr(10) + '  --:-- [')} || a || '] ' || tok"


FIX["next_item"] = f"""
next_item AS (
  SELECT 'next_item' AS task, CAST(user_id AS VARCHAR) AS key, '' AS system,
         {q(_G.USER_PROMPT_HEAD)} || coalesce(string_agg({event_line()}, {q(chr(10))} ORDER BY e)
             FILTER (WHERE e < n_ev AND e <= 20), '') AS prompt,
         {q('<think>' + chr(10) + '</think>' + chr(10) + '["')} || max(tok) FILTER (WHERE e = n_ev) || '"]' AS response
  FROM ev WHERE user_id IN (SELECT user_id FROM elig) GROUP BY user_id)"""


def rec_lines_sql() -> str:
    cols = {"live": "live_tokens", "video": "video_tokens", "goods": "goods_tokens", "ad": "ad_tokens"}
    parts = [f"CASE WHEN len({cols[n]}) > 0 THEN {q(lead)} || array_to_string({cols[n]}[1:{cap}], ', ') END"
             for n, lead, cap in _G.REC_LINES]
    return f"concat_ws({q(chr(10))}, {', '.join(parts)})"


FIX["interest"] = f"""
interest AS (
  SELECT 'interest' AS task, CAST(user_id AS VARCHAR) AS key, {q(_G.REC_SYSTEM)} AS system,
         {q(_G.REC_PROMPT_HEAD)} || {rec_lines_sql()} AS prompt,
         {q('<think>' + _G.REC_THINK + '</think>' + chr(10))} ||
           concat_ws(', ', live_tokens[1], video_tokens[1], goods_tokens[1]) AS response
  FROM elig)"""

USER_CTES = ["behaviour", "behaviour_head", "item_sid", "seq", "users", "elig", "ev"]


def mix_sql(version: int) -> list[str]:
    """CTE names + body for the v2 / v3 mixtures (ends with a CTE ``mix``)."""
    max_char = 12288 if version == 2 else 36000
    sft_len = char_len("system", "prompt", "response")
    base = f"""
, base AS (
  SELECT category AS source, category, category || ':' || CAST(sample_id AS VARCHAR) AS sample_key,
         coalesce(system, '') AS system, coalesce(prompt, '') AS prompt, coalesce(response, '') AS response
  FROM samples WHERE category IN ('rec', 'item', 'user'))
, base_f AS (SELECT * FROM base WHERE {sft_len} <= {max_char})"""
    wname = "world" if version == 2 else "world_ext"
    world = f"""
, world0 AS (
  SELECT '{wname}' AS source, 'world' AS category, '{wname}:' || CAST(conv_id AS VARCHAR) AS sample_key,
         {strip("coalesce(instruction, '')")} AS system,
         {history('history')} || {strip("coalesce(input, '')")} AS prompt,
         {strip("coalesce(output, '')")} AS response
  FROM alpaca)
, world1 AS (SELECT * FROM world0 WHERE {sft_len} > 50 AND {sft_len} <= {max_char}
             {"AND NOT (prompt = '' AND response = '')" if version == 3 else ""})
, world AS (SELECT source, category, sample_key, system, prompt, response FROM (
    SELECT *, row_number() OVER (ORDER BY md5('42:sample:' || sample_key), sample_key) AS rk FROM world1)
  WHERE rk <= 60)"""
    if version == 2:
        union = "SELECT * FROM base_f UNION ALL SELECT * FROM world"
        group = "category"
        names = ["samples", "alpaca"]
    else:
        ext = f"""
, gen AS (SELECT * FROM item_samples UNION ALL SELECT * FROM next_item UNION ALL SELECT * FROM interest)
, ext AS (
  SELECT CASE task WHEN 'interest' THEN 'rec_ext' WHEN 'next_item' THEN 'user_ext' ELSE 'item_ext' END AS source,
         CASE task WHEN 'interest' THEN 'rec' WHEN 'next_item' THEN 'user' ELSE 'item' END AS category,
         CASE task WHEN 'interest' THEN 'rec_ext' WHEN 'next_item' THEN 'user_ext' ELSE 'item_ext' END
           || ':' || task || ':' || key AS sample_key,
         coalesce(system, '') AS system, coalesce(prompt, '') AS prompt, coalesce(response, '') AS response
  FROM gen)
, ext_f AS (SELECT * FROM ext WHERE {sft_len} <= {max_char} AND NOT (prompt = '' AND response = ''))"""
        world += ext
        union = "SELECT * FROM base_f UNION ALL SELECT * FROM ext_f UNION ALL SELECT * FROM world"
        group = "source"
        names = ["samples", "alpaca", "item_caption"] + USER_CTES + ["items_j", "item_samples", "next_item", "interest"]
    body = base + world + f"""
, u AS ({union})
, mix AS (
  SELECT source, category, sample_key, system, prompt, response,
         {split_case('rn', 'n')} AS split
  FROM (SELECT *, {hrank(group, 'sample_key', '42')} AS rn, count(*) OVER (PARTITION BY {group}) AS n FROM u))"""
    return names, body


def with_mix(version: int, tail: str) -> str:
    names, body = mix_sql(version)
    return with_(names, body + "\n" + tail)


def ints(x: str) -> str:
    return f"array_to_string({x}, ',')"


def tok_len_sql() -> str:
    return f"len({toks(chr(39) * 0 + 'coalesce(system, ' + q('') + ') || coalesce(prompt, ' + q('') + ') || coalesce(response, ' + q('') + ')')})"


# ---------------------------------------------------------------------------
# Sources and sinks
# ---------------------------------------------------------------------------
_S5 = "sample_id, category, system, prompt, response"
Q["src_jsonl_scan"] = with_(["samples"], f"""
SELECT 'object' AS fmt, {_S5} FROM samples UNION ALL SELECT 'array' AS fmt, {_S5} FROM samples""")
Q["src_dir_scan"] = with_(["samples"], "\nSELECT category, sample_id, system, prompt, response FROM samples")
Q["src_category_prune"] = with_(["samples"], """
SELECT category, sample_id, system, prompt, response FROM samples WHERE category IN ('rec', 'user')""")
Q["cap_per_group"] = f"""
SELECT doc_id, source FROM (SELECT doc_id, source, {hrank('source', 'doc_id', '42')} AS rn FROM documents) WHERE rn <= 5"""
Q["category_from_name"] = """
SELECT doc_id, source, CASE WHEN starts_with(source, 'src1') THEN 'src1' WHEN starts_with(source, 'src2') THEN 'src2'
                            WHEN starts_with(source, 'src') THEN 'src' END AS category FROM documents"""
Q["dedupe_last_wins"] = with_(["item_sid"], """
, u AS (SELECT pid, domain, sid_three, 0 AS ord FROM item_sid
        UNION ALL SELECT pid, domain, [sid_three[1] + 1, sid_three[2], sid_three[3]], 1 FROM item_sid WHERE pid % 7 = 0)
SELECT pid, domain, array_to_string(arg_max(sid_three, ord), ',') AS sid FROM u GROUP BY pid, domain""")
_PROFILE_COLS = ["live_hist_author_id_list", "video_sampled_pid_list", "ec_good_click_item_id_list_extend",
                 "outer_loop_history_action_pid_list_click", "live_hist_timestamp_list", "video_ts_list"]
Q["profile_scan"] = with_(["behaviour", "behaviour_head", "profile"],
                          "\nSELECT user_id, " + ", ".join(f"{ints(c)} AS {c}" for c in _PROFILE_COLS) + " FROM profile")
Q["profile_long"] = with_(["behaviour", "behaviour_head"], """
SELECT user_id, domain, pos, pid, CASE WHEN domain IN ('live', 'video/video') THEN ts_us END AS ts FROM behaviour_head""")
Q["sink_jsonl_roundtrip"] = with_mix(2, "SELECT split, sample_key, system, prompt, response FROM mix")
Q["sink_jsonl_array"] = with_(["item_sid", "item_caption", "items_j", "item_samples"],
                              "\nSELECT task, key, system, prompt, response FROM item_samples")
Q["mix_stats"] = with_mix(2, """
, per AS (SELECT category, count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'eval') AS eval
          FROM mix GROUP BY category)
SELECT CAST(sum(train) AS BIGINT) AS total_train, CAST(sum(eval) AS BIGINT) AS total_eval,
       '{' || string_agg('"' || category || '":{"train":' || CAST(train AS VARCHAR) || ',"eval":' || CAST(eval AS VARCHAR) || '}',
                         ',' ORDER BY category) || '}' AS categories,
       CAST(12288 AS BIGINT) AS max_char, CAST(60 AS BIGINT) AS world_sample_size, CAST(0.05 AS DOUBLE) AS eval_ratio
FROM per""")

# ---------------------------------------------------------------------------
# Row-wise projections
# ---------------------------------------------------------------------------
Q["norm_alpaca"] = with_(["alpaca"], f"""
SELECT conv_id, {strip("coalesce(instruction, '')")} AS system,
       {history('history')} || {strip("coalesce(input, '')")} AS prompt, {strip("coalesce(output, '')")} AS response
FROM alpaca""")
Q["norm_history"] = with_(["alpaca"], f"\nSELECT conv_id, {history('history')} AS history_text FROM alpaca")
Q["chat_to_alpaca"] = with_(["alpaca"], """
SELECT conv_id, instruction, input, output,
       array_to_string(list_transform(history, lambda h: array_to_string(h, ' || ')), ' ## ') AS history FROM alpaca""")
Q["char_len"] = with_(["samples"], f"\nSELECT sample_id, {char_len('system', 'prompt', 'response')} AS char_len FROM samples")
Q["token_estimate"] = with_(["samples"], f"""
SELECT sample_id, CAST(ceil(({char_len('system', 'prompt', 'response')}) / 3.0) AS BIGINT) AS est_tokens FROM samples""")
Q["sid_token"] = with_(["item_sid"], f"\nSELECT pid, domain, {sid_token('domain', 'sid_three')} AS token FROM item_sid")
Q["domain_labels"] = with_(["item_caption"], f"""
SELECT pid, domain, {case_map('domain', _T.DOMAIN_PREFIX, '')} AS prefix, {case_map('domain', _T.DOMAIN_LABEL)} AS label
FROM item_caption""")
Q["caption_summary"] = with_(["item_caption"], f"\nSELECT pid, domain, {summary('caption')} AS summary FROM item_caption")
Q["chat_render"] = with_(["samples"], f"""
SELECT sample_id, {full_text('system', 'prompt', 'response')} AS full_text, {prefix_text('system', 'prompt')} AS prefix_text
FROM samples""")


def _wbc(scope: str) -> str:
    s, p, r = "coalesce(system, '')", "coalesce(prompt, '')", "coalesce(response, '')"
    out = []
    for name, w in (("que", 2.0), ("der", 5.0), ("the", 1.5)):
        if scope == "joined":
            cond = f"instr({s} || {p} || {r}, {q(name)}) > 0"
        else:
            cond = f"(instr({p} || {r}, {q(name)}) > 0 OR instr({s}, {q(name)}) > 0)"
        out.append(f"WHEN {cond} THEN {w}")
    return f"CAST(CASE {' '.join(out)} ELSE 1.0 END AS DOUBLE)"


Q["weight_by_content"] = with_(["samples"], f"""
SELECT sample_id, {_wbc('joined')} AS w_joined, {_wbc('separate')} AS w_separate FROM samples""")
Q["rec_prompt"] = with_(USER_CTES[:5], f"\nSELECT user_id, {rec_lines_sql()} AS lines FROM users")
Q["user_prompt"] = with_(USER_CTES, f"""
SELECT u.user_id, coalesce(string_agg({event_line()}, {q(chr(10))} ORDER BY e) FILTER (WHERE e <= 20), '') AS lines
FROM users u LEFT JOIN ev USING (user_id) GROUP BY u.user_id""")

# ---------------------------------------------------------------------------
# Filters
# ---------------------------------------------------------------------------
Q["filter_len"] = with_(["samples"], f"""
SELECT sample_id, category FROM samples WHERE {char_len('system', 'prompt', 'response')} <= 12288""")
Q["filter_band"] = with_(["samples"], f"""
SELECT sample_id FROM samples WHERE {char_len('prompt', 'response')} > 50 AND {char_len('prompt', 'response')} <= 12288""")
Q["long_policy"] = with_(["samples"], f"""
SELECT sample_id, n_tokens_full FROM {encoded('samples', 1024)} WHERE n_tokens_full <= 1024""")
Q["encode_filter"] = with_(["samples"], f"""
SELECT sample_id, len(ids) AS n_tokens FROM {encoded('samples', 2048)} WHERE len(ids) > 10""")
Q["user_min_history"] = with_(USER_CTES[:5], """
SELECT user_id, n_tokens FROM (SELECT user_id, len(live_tokens) + len(video_tokens) + len(goods_tokens) + len(ad_tokens)
  AS n_tokens FROM users) WHERE n_tokens >= 40""")

# ---------------------------------------------------------------------------
# Joins
# ---------------------------------------------------------------------------
Q["join_item"] = with_(["item_sid", "item_caption", "items_j"], "\nSELECT pid, domain, caption, token FROM items_j")
Q["semi_item"] = with_(["item_sid", "item_caption"], """
SELECT pid, domain FROM item_caption c WHERE EXISTS (SELECT 1 FROM item_sid s WHERE s.pid = c.pid AND s.domain = c.domain)""")
Q["seq_lookup"] = with_(USER_CTES[:4], """
SELECT user_id, domain, count(*) AS n_tokens, string_agg(token, ',' ORDER BY pos) AS tokens FROM seq GROUP BY user_id, domain""")
Q["seq_lookup_ts"] = with_(USER_CTES[:4], "\nSELECT user_id, pos, ts, token FROM seq WHERE domain = 'live'")

# ---------------------------------------------------------------------------
# Generators
# ---------------------------------------------------------------------------
_ITEMS = ["item_sid", "item_caption", "items_j", "item_samples"]
Q["gen_desc2tok"] = with_(_ITEMS, "\nSELECT task, key, system, prompt, response FROM item_samples WHERE task = 'desc2tok'")
Q["gen_tok2desc"] = with_(_ITEMS, "\nSELECT task, key, system, prompt, response FROM item_samples WHERE task = 'tok2desc'")
Q["gen_next_item"] = with_(USER_CTES + ["next_item"], "\nSELECT task, key, system, prompt, response FROM next_item")
Q["gen_interest"] = with_(USER_CTES + ["interest"], "\nSELECT task, key, system, prompt, response FROM interest")
Q["gen_capped"] = with_(["item_sid", "item_caption", "items_j"], f"""
, capped AS (SELECT * FROM (SELECT *, {hrank('', "domain || ':' || CAST(pid AS VARCHAR)", '42')} AS rk FROM items_j)
             WHERE rk <= 500)
, item_samples AS ({item_samples_sql('capped')})
SELECT task, key, system, prompt, response FROM item_samples""")
Q["generate_all"] = with_(USER_CTES + ["item_caption", "items_j", "item_samples", "next_item", "interest"], """
SELECT task, key, system, prompt, response FROM item_samples
UNION ALL SELECT task, key, system, prompt, response FROM next_item
UNION ALL SELECT task, key, system, prompt, response FROM interest""")

# ---------------------------------------------------------------------------
# Sampling, ordering, splitting, weighting
# ---------------------------------------------------------------------------
Q["hash_rank"] = with_(["samples"], f"\nSELECT sample_id, category, {hrank('category', 'sample_id', '42')} AS rn FROM samples")
Q["shuffle_order"] = with_(["samples"], f"\nSELECT sample_id, {hrank('', 'sample_id', '42:order')} AS pos FROM samples")
Q["sample_n"] = with_(["samples"], f"""
SELECT sample_id, category FROM (SELECT sample_id, category, {hrank('category', 'sample_id', '42:sample')} AS rn FROM samples)
WHERE rn <= 60""")
Q["split_eval"] = with_(["samples"], f"""
SELECT sample_id, category, {split_case('rn', 'n')} AS split
FROM (SELECT sample_id, category, {hrank('category', 'sample_id', '42')} AS rn,
             count(*) OVER (PARTITION BY category) AS n FROM samples)""")


def resample_sql(src: str, seed: str = "42") -> str:
    """CTE text: draws over ``src`` (columns sample_id, category, w) -> ``drawn(draw_id, sample_id, ...)``."""
    return f"""
, ranked AS (SELECT *, {hrank('w', 'sample_id', seed + ':row')} AS rn FROM {src})
, ct AS (SELECT w, count(*) AS nc FROM {src} GROUP BY w)
, ct2 AS (SELECT w, nc, sum(w * nc) OVER (ORDER BY w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi FROM ct)
, tot AS (SELECT max(hi) AS total FROM ct2)
, draws AS (SELECT sample_id AS draw_id, {uniform('sample_id', seed + ':class')} * total AS x,
                   {uniform('sample_id', seed + ':index')} AS u2 FROM {src}, tot)
, cand AS (SELECT d.draw_id, d.u2, c.w, c.nc, row_number() OVER (PARTITION BY d.draw_id ORDER BY c.hi, c.w) AS k
           FROM draws d JOIN ct2 c ON d.x < c.hi)
, pick AS (SELECT draw_id, w, least(CAST(floor(u2 * nc) AS BIGINT) + 1, nc) AS idx FROM cand WHERE k = 1)
, drawn AS (SELECT p.draw_id, r.* EXCLUDE (rn, w) FROM pick p JOIN ranked r ON r.w = p.w AND r.rn = p.idx)"""


Q["resample_weighted"] = with_(["samples"], f"""
, sw AS (SELECT sample_id, category, {WEIGHTS_SQL} AS w FROM samples)
{resample_sql('sw')}
SELECT draw_id, sample_id, category FROM drawn""")
Q["dedupe_growing"] = with_(["item_sid"], """
SELECT pid, domain, array_to_string([sid_three[1] + CASE WHEN pid % 7 = 0 THEN 1 ELSE 0 END, sid_three[2], sid_three[3]], ',') AS sid FROM item_sid""")
Q["chat_pairs"] = """
WITH t AS (SELECT conv_id, turn, role, text, lead(role) OVER w AS nrole, lead(text) OVER w AS a FROM conversations WHERE conv_id IS NOT NULL
           WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, text AS u, a, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1 AS is_last FROM t WHERE role = 'user' AND nrole = 'assistant'"""
for _plain in ("join_item", "semi_item", "seq_lookup"):
    Q[f"{_plain}_bucketed"] = Q[_plain]
Q["src_first_samples"] = with_(["samples"], """
, r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY sample_id) - 1 AS sample_no FROM samples)
SELECT category, sample_no, sample_id, system, prompt, response FROM r WHERE sample_no < 20""")
Q["sink_published"] = with_(["samples"], f"""
SELECT {split_case('rn', 'n')} || '.jsonl' AS name, sample_id, system, prompt, response
FROM (SELECT *, {hrank('category', 'sample_id', '42')} AS rn, count(*) OVER (PARTITION BY category) AS n FROM samples)""")
Q["resample_by_row"] = """
WITH d AS (SELECT doc_id, CAST(0.1 AS DOUBLE) + coalesce(n_chars, 0) / CAST(1000.0 AS DOUBLE) AS w FROM documents)
, r AS (SELECT *, CAST(floor(w * 1000000 + 0.5) AS HUGEINT) AS units FROM d)
, line AS (SELECT *, sum(units) OVER (ORDER BY md5('42:row:' || doc_id), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - units AS lo FROM r WHERE units > 0)
, draws AS (SELECT doc_id AS draw_id, CAST(('0x' || substr(md5('42:draw:' || doc_id), 1, 13)) AS BIGINT)::HUGEINT * (SELECT sum(units) FROM r) // 4503599627370496 AS x FROM d)
SELECT draw_id, line.doc_id, line.w FROM draws ASOF JOIN line ON draws.x >= line.lo"""


def split_by_key_sql(src: str, group: str, key: str) -> str:
    """The rule of D12 over ``src``, by key counts and a running sum over eligible keys."""
    return f"""
, k AS (SELECT {group}, {key}, count(*) AS n FROM {src} GROUP BY ALL)
, g AS (SELECT {group}, greatest(1, floor(sum(n) * CAST(0.05 AS DOUBLE))) AS budget, min(n) AS least FROM k GROUP BY {group})
, o AS (SELECT k.*, budget, coalesce(sum(n) OVER (PARTITION BY k.{group} ORDER BY md5('42:=' || k.{key}), '=' || k.{key}
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM k JOIN g ON k.{group} = g.{group} WHERE n <= greatest(budget, least))
SELECT {src}.*, CASE WHEN o.before < o.budget THEN 'eval' ELSE 'train' END AS split
FROM {src} LEFT JOIN o ON {src}.{group} = o.{group} AND {src}.{key} = o.{key}"""


Q["split_by_item"] = with_(["item_sid", "item_caption"], """
, r AS (SELECT c.domain, c.pid, t.task FROM item_caption c JOIN item_sid s ON c.pid = s.pid AND c.domain = s.domain, (VALUES ('desc2tok'), ('tok2desc')) t(task))
""" + split_by_key_sql("r", "domain", "pid"))
Q["split_by_order"] = "WITH r AS (SELECT l_returnflag, l_orderkey, l_linenumber FROM lineitem)" + split_by_key_sql("r", "l_returnflag", "l_orderkey")
Q["subtype_top5"] = with_(["samples"], """
SELECT * FROM (
  SELECT category, subtype, n, row_number() OVER (PARTITION BY category ORDER BY n DESC, subtype) AS rank
  FROM (SELECT category, substr(coalesce(system, ''), 1, 30) AS subtype, count(*) AS n FROM samples GROUP BY ALL))
WHERE rank <= 5""")

# ---------------------------------------------------------------------------
# Aggregations
# ---------------------------------------------------------------------------
_TL = f"(SELECT sample_id, category, system, {tok_len_sql()} AS n_tokens FROM samples)"
Q["len_summary"] = with_(["samples"], f"""
SELECT category, count(*) AS n, min(n_tokens) AS min_len, max(n_tokens) AS max_len,
       CAST(floor(sum(n_tokens) / count(*)) AS BIGINT) AS avg_len FROM {_TL} GROUP BY category""")


def pct_sql(src: str) -> str:
    return f"""(SELECT category,
    min(n_tokens) FILTER (WHERE cum > floor(n * CAST(0.5 AS DOUBLE))) AS p50,
    min(n_tokens) FILTER (WHERE cum > floor(n * CAST(0.9 AS DOUBLE))) AS p90,
    min(n_tokens) FILTER (WHERE cum > floor(n * CAST(0.99 AS DOUBLE))) AS p99
  FROM (SELECT category, n_tokens,
               sum(cnt) OVER (PARTITION BY category ORDER BY n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
               sum(cnt) OVER (PARTITION BY category) AS n
        FROM (SELECT category, n_tokens, count(*) AS cnt FROM {src} GROUP BY ALL))
  GROUP BY category)"""


Q["len_percentiles"] = with_(["samples"], f"\nSELECT * FROM {pct_sql(_TL)}")
Q["len_over"] = with_(["samples"], f"""
SELECT category, threshold, n_over, CAST(floor(n_over * 100 / n) AS BIGINT) AS pct_over FROM (
  SELECT category, t.threshold, count(*) FILTER (WHERE n_tokens > t.threshold) AS n_over, count(*) AS n
  FROM {_TL} CROSS JOIN (SELECT unnest([1024, 2048, 4096, 8192]) AS threshold) t GROUP BY category, t.threshold)""")
Q["category_share"] = with_(["samples"], """
SELECT category, n, CAST(floor(n * 100 / sum(n) OVER ()) AS BIGINT) AS share_pct
FROM (SELECT category, count(*) AS n FROM samples GROUP BY category)""")
Q["mix_funnel"] = with_(["samples"], f"""
SELECT category, count(*) AS n_in,
       count(*) FILTER (WHERE {char_len('system', 'prompt', 'response')} <= 12288) AS n_len_ok,
       count(*) FILTER (WHERE {char_len('prompt', 'response')} > 50 AND {char_len('prompt', 'response')} <= 12288) AS n_band_ok,
       count(*) FILTER (WHERE {char_len('system', 'prompt', 'response')} <= 36000) AS n_v3_ok
FROM samples GROUP BY category""")

# ---------------------------------------------------------------------------
# Encoding and batches
# ---------------------------------------------------------------------------
Q["token_count"] = with_(["samples"], f"\nSELECT sample_id, n_tokens FROM {_TL}")
Q["encode"] = with_(["samples"], f"""
SELECT sample_id, {ints('ids')} AS input_ids, n_tokens_full, n_prefix, n_supervised FROM {encoded('samples', 2048)}""")
Q["label_mask"] = with_(["samples"], f"""
SELECT sample_id, {ints('labels')} AS labels, len(ids) AS n_attention, CASE WHEN len(ids) > 0 THEN 1 END AS mask_max
FROM {encoded('samples', 2048)}""")
Q["pad_batches"] = with_(["samples"], f"""
, enc AS {encoded('samples', 512)}
, r AS (SELECT *, {hrank('', 'sample_id', '42')} AS rk FROM enc)
, b AS (SELECT *, (rk - 1) // 8 AS batch_id FROM r)
, w AS (SELECT *, CAST(least(max(len(ids)) OVER (PARTITION BY batch_id), 512) AS INT) AS width FROM b)
SELECT sample_id, batch_id, CAST(rk - 1 - batch_id * 8 AS INT) AS row_in_batch, width,
       {ints("list_concat(ids[1:width], list_transform(range(width - len(ids[1:width])), lambda x: 0))")} AS input_ids,
       {ints("list_concat(list_transform(range(len(ids[1:width])), lambda x: 1), list_transform(range(width - len(ids[1:width])), lambda x: 0))")} AS attention_mask,
       {ints("list_concat(labels[1:width], list_transform(range(width - len(labels[1:width])), lambda x: -100))")} AS labels
FROM w""")

# ---------------------------------------------------------------------------
# Pipelines
# ---------------------------------------------------------------------------
Q["mix_v2"] = with_mix(2, "SELECT * FROM mix")
Q["mix_v3"] = with_mix(3, "SELECT * FROM mix")
Q["mix_v3_files"] = Q["mix_v3"]
Q["encode_pipeline"] = with_(["samples"], f"""
, sp AS (SELECT *, {split_case('rn', 'n')} AS split FROM (
    SELECT *, {hrank('category', 'sample_id', '42')} AS rn, count(*) OVER (PARTITION BY category) AS n FROM samples))
, sw AS (SELECT sample_id, category, system, prompt, response, {WEIGHTS_SQL} AS w FROM sp WHERE split = 'train')
{resample_sql('sw')}
, tr AS (SELECT e.*, d.category, 'train' AS split FROM {encoded('drawn', 2048, 'draw_id, sample_id')} e
         JOIN (SELECT DISTINCT sample_id, category FROM samples) d USING (sample_id))
, ev_ AS (SELECT e.*, s.category, 'eval' AS split FROM {encoded("(SELECT sample_id AS draw_id, * FROM sp WHERE split = 'eval')", 2048, 'draw_id, sample_id')} e
          JOIN samples s USING (sample_id))
, allr AS (SELECT * FROM tr UNION ALL SELECT * FROM ev_)
SELECT split, draw_id, sample_id, category, len(ids) AS n_ids, n_tokens_full, n_supervised,
       md5({ints('ids')}) AS ids_md5, md5({ints('labels')}) AS labels_md5
FROM allr WHERE len(ids) > 10""")
_TL_REPORT = f"(SELECT category, {tok_len_sql()} AS n_tokens FROM samples)"
Q["length_report"] = with_(["samples"], f"""
, summ AS (SELECT category, count(*) AS n, min(n_tokens) AS min_len, max(n_tokens) AS max_len,
                  CAST(floor(sum(n_tokens) / count(*)) AS BIGINT) AS avg_len,
                  count(*) FILTER (WHERE n_tokens > 1024) AS over_1024, count(*) FILTER (WHERE n_tokens > 2048) AS over_2048,
                  count(*) FILTER (WHERE n_tokens > 4096) AS over_4096, count(*) FILTER (WHERE n_tokens > 8192) AS over_8192
           FROM {_TL_REPORT} GROUP BY category)
SELECT s.*, p.p50, p.p90, p.p99, CAST(floor(s.n * 100 / sum(s.n) OVER ()) AS BIGINT) AS share_pct,
       CAST(floor(over_1024 * 100 / n) AS BIGINT) AS over_1024_pct, CAST(floor(over_2048 * 100 / n) AS BIGINT) AS over_2048_pct,
       CAST(floor(over_4096 * 100 / n) AS BIGINT) AS over_4096_pct, CAST(floor(over_8192 * 100 / n) AS BIGINT) AS over_8192_pct
FROM summ s JOIN {pct_sql(_TL_REPORT)} p USING (category)""")

# A1 mix_counts: samples -> F1(12288) -> R3 per category -> rollup counts
Q["mix_counts"] = with_(["samples"], f"""
, f AS (SELECT * FROM samples WHERE {char_len('system', 'prompt', 'response')} <= 12288)
, r AS (SELECT category, {hrank('category', 'sample_id', '42')} AS rn, count(*) OVER (PARTITION BY category) AS n FROM f)
, s AS (SELECT category, {split_case('rn', 'n')} AS split FROM r)
SELECT CASE WHEN grouping(category) = 1 THEN 'TOTAL' ELSE category END AS category,
       count(*) FILTER (WHERE split = 'train') AS n_train,
       count(*) FILTER (WHERE split = 'eval') AS n_eval
FROM s GROUP BY ROLLUP (category)""")

# ---------------------------------------------------------------------------
# W3 short template (the older generator)
# ---------------------------------------------------------------------------


def _fill_sql(template: str, label: str) -> str:
    parts = template.split("{label}")
    out = [q(parts[0])]
    for p in parts[1:]:
        out += [label, q(p)]
    return " || ".join(out)


def short_items_sql(src: str) -> str:
    lab = case_map("domain", _T.DOMAIN_LABEL)
    lab2 = case_map("domain", _G.SHORT_TOK2DESC_LABEL)
    a, b, c, e = "给定", "token", "这件", "有什么特点？/think"
    doms = ", ".join(q(d) for d in _G.DESC2TOK_SYSTEM)
    nl = chr(10)
    return f"""
  SELECT 'desc2tok' AS task, domain || ':' || CAST(pid AS VARCHAR) AS key,
         {_fill_sql(_G.SHORT_DESC2TOK_SYSTEM, lab)} AS system,
         {_fill_sql(_G.SHORT_DESC2TOK_PROMPT, lab)} || caption AS prompt,
         '<think>' || substr(caption, 1, 50) || {q('</think>' + nl)} || token AS response
  FROM {src} WHERE domain IN ({doms})
  UNION ALL
  SELECT 'tok2desc' AS task, domain || ':' || CAST(pid AS VARCHAR) AS key,
         {case_map('domain', _G.SHORT_TOK2DESC_SYSTEM)} AS system,
         {q(a)} || {lab2} || {q(b)} || token || {q(c)} || {lab2} || {q(e)} AS prompt,
         '<think>' || substr(caption, 1, 50) || {q('</think>' + nl)} || caption AS response
  FROM {src} WHERE domain IN ({doms})"""


FIX["all_s"] = """
all_s AS (
  SELECT *, list_concat(list_concat(live_tokens, video_tokens), goods_tokens) AS all_tokens FROM (
    SELECT user_id,
      coalesce(list(token ORDER BY pos) FILTER (WHERE domain = 'live'), []::VARCHAR[]) AS live_tokens,
      coalesce(list(token ORDER BY pos) FILTER (WHERE domain = 'video/video'), []::VARCHAR[]) AS video_tokens,
      coalesce(list(token ORDER BY pos) FILTER (WHERE domain = 'goods'), []::VARCHAR[]) AS goods_tokens
    FROM seq WHERE pos < 10 AND domain IN ('live', 'video/video', 'goods') GROUP BY user_id))"""


def short_users_sql(src: str) -> str:
    nl = chr(10)
    lines = ", ".join(
        f"CASE WHEN len({n}_tokens) > 0 THEN {q(lead)} || array_to_string({n}_tokens[1:{cap}], ', ') END"
        for n, lead, cap in _G.SHORT_REC_LINES)
    return f"""
  SELECT 'next_item' AS task, CAST(user_id AS VARCHAR) AS key, '' AS system,
         {q(_G.USER_PROMPT_HEAD)} || array_to_string(list_transform(all_tokens[1:len(all_tokens) - 1],
             lambda t: {q(_G.SHORT_USER_LINE)} || t), {q(nl)}) || {q(_G.SHORT_USER_TAIL)} AS prompt,
         {q('<think>' + nl + '</think>' + nl + '["')} || all_tokens[len(all_tokens)] || '"]' AS response
  FROM {src} WHERE len(all_tokens) >= 2
  UNION ALL
  SELECT 'interest' AS task, CAST(user_id AS VARCHAR) AS key, {q(_G.REC_SYSTEM)} AS system,
         {q(_G.REC_PROMPT_HEAD)} || concat_ws({q(nl)}, {lines}) AS prompt,
         {q(_G.SHORT_REC_RESPONSE)} || all_tokens[len(all_tokens)] AS response
  FROM {src} WHERE len(all_tokens) >= 1"""


_SHORT = ["behaviour", "behaviour_head", "item_sid", "seq", "all_s", "item_caption", "items_j"]
Q["generate_short"] = with_(_SHORT, f"\n{short_items_sql('items_j')}\nUNION ALL{short_users_sql('all_s')}")
Q["gen_short_capped"] = with_(_SHORT, f"""
, cap_c AS (SELECT * FROM (SELECT *, {hrank('', "domain || ':' || CAST(pid AS VARCHAR)", '42')} AS rk FROM item_caption)
            WHERE rk <= 500)
, items_c AS (SELECT c.pid, c.domain, c.caption, {sid_token('c.domain', 's.sid_three')} AS token
              FROM cap_c c JOIN item_sid s ON s.pid = c.pid AND s.domain = c.domain)
, users_c AS (SELECT * FROM (SELECT *, {hrank('', 'user_id', '42')} AS rk FROM all_s WHERE len(all_tokens) >= 1)
              WHERE rk <= 20)
{short_items_sql('items_c')}
UNION ALL{short_users_sql('users_c')}""")

# D4 option: events in md5(seed:user:index) order, index = 0-based position in domain order.
Q["gen_next_item_shuffled"] = with_(USER_CTES, f"""
, evs AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY md5('42:' || CAST(user_id AS VARCHAR) || ':' ||
                                                                      CAST(e - 1 AS VARCHAR))) AS e2
          FROM ev WHERE user_id IN (SELECT user_id FROM elig))
SELECT 'next_item' AS task, CAST(user_id AS VARCHAR) AS key, '' AS system,
       {q(_G.USER_PROMPT_HEAD)} || coalesce(string_agg({event_line()}, {q(chr(10))} ORDER BY e2)
           FILTER (WHERE e2 < n_ev AND e2 <= 20), '') AS prompt,
       {q('<think>' + chr(10) + '</think>' + chr(10) + '["')} || max(tok) FILTER (WHERE e2 = n_ev) || '"]' AS response
FROM evs GROUP BY user_id""")

# R4 with first-match content weights (joined scope).
Q["resample_by_content"] = with_(["samples"], f"""
, sw AS (SELECT sample_id, category, {_wbc('joined')} AS w FROM samples)
{resample_sql('sw')}
SELECT draw_id, sample_id, category FROM drawn""")

# One input holding SFT rows and Alpaca rows.
Q["norm_schema_aware"] = with_(["samples", "alpaca"], f"""
SELECT 's:' || CAST(sample_id AS VARCHAR) AS key, coalesce(system, '') AS system, coalesce(prompt, '') AS prompt,
       coalesce(response, '') AS response,
       coalesce(prompt, '') = '' AND coalesce(response, '') = '' AS is_empty
FROM samples
UNION ALL
SELECT 'a:' || CAST(conv_id AS VARCHAR) AS key, {strip("coalesce(instruction, '')")} AS system,
       {history('history')} || {strip("coalesce(input, '')")} AS prompt, {strip("coalesce(output, '')")} AS response,
       ({history('history')} || {strip("coalesce(input, '')")}) = '' AND {strip("coalesce(output, '')")} = '' AS is_empty
FROM alpaca""")

# The files of the first two domains in name order (goods, live).
Q["src_file_limit"] = with_(["item_sid"], """
SELECT pid, domain, array_to_string(sid_three, ',') AS sid FROM item_sid WHERE domain IN ('goods', 'live')""")

# Rows whose only key is their text.
FIX["keyed"] = f"""
keyed AS (
  SELECT doc_id, category, text_key || CASE WHEN c > 0 THEN '#' || CAST(c AS VARCHAR) ELSE '' END AS uid
  FROM (SELECT doc_id, CASE lang WHEN 'en' THEN 'rec' WHEN 'fr' THEN 'item' WHEN 'de' THEN 'user' ELSE 'world' END AS category,
               md5(coalesce(text, '')) AS text_key,
               row_number() OVER (PARTITION BY md5(coalesce(text, '')) ORDER BY md5('copy:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS c
        FROM documents))"""
Q["number_copies"] = with_(["keyed"], "\nSELECT doc_id, category, uid FROM keyed")
Q["split_eval_dups"] = with_(["keyed"], f"""
SELECT doc_id, uid, category, {split_case('rn', 'n')} AS split
FROM (SELECT *, {hrank('category', 'uid', '42')} AS rn, count(*) OVER (PARTITION BY category) AS n FROM keyed)""")
Q["resample_dups"] = with_(["keyed"], f"""
, sw AS (SELECT uid AS sample_id, category, {WEIGHTS_SQL} AS w FROM keyed)
{resample_sql('sw')}
SELECT draw_id, sample_id AS uid, category FROM drawn""")
Q["weights_default"] = with_(["samples"], """
SELECT sample_id, category, CAST(CASE WHEN category = 'rec' THEN 3.0 ELSE 1.0 END AS DOUBLE) AS w FROM samples""")
Q["shuffle_written"] = with_(["samples"], f"\nSELECT sample_id, category, {hrank('', 'sample_id', '42:order')} AS pos FROM samples")
Q["norm_history_nulls"] = with_(["alpaca"], f"""
, cut AS (SELECT conv_id, list_transform(history, lambda p: [CASE WHEN conv_id % 3 <> 1 THEN p[1] END,
                                                             CASE WHEN conv_id % 3 <> 2 THEN p[2] END]) AS h FROM alpaca)
SELECT conv_id, {history('h')} AS history_text FROM cut""")
Q["src_jsonl_mixed"] = with_(["samples"], """
SELECT sample_id, system, prompt, response FROM samples UNION ALL SELECT sample_id, system, prompt, response FROM samples""")
_names2, _body2 = mix_sql(2)
Q["mix_funnel_recipe"] = with_(_names2, _body2 + """
, raw AS (SELECT category AS source, count(*) AS n_raw FROM samples WHERE category IN ('rec', 'item', 'user') GROUP BY ALL
          UNION ALL SELECT 'world', count(*) FROM alpaca)
SELECT raw.source, n_raw, count(mix.source) AS n_kept, count(*) FILTER (WHERE split = 'train') AS n_train,
       count(*) FILTER (WHERE split = 'eval') AS n_eval
FROM raw LEFT JOIN mix ON mix.source = raw.source GROUP BY raw.source, n_raw""")
Q["mix_v3_alpaca_files"] = with_(["alpaca"], f"""
, one AS (SELECT instruction, input, output, md5(concat_ws(chr(1), chr(2), chr(2), chr(2), coalesce(instruction, chr(2)), coalesce(input, chr(2)),
                                                           coalesce(output, chr(2)))) AS k FROM alpaca)
, lines AS (SELECT * FROM one UNION ALL SELECT * FROM one)
, ids AS (SELECT *, row_number() OVER (PARTITION BY k) - 1 AS c FROM lines)
, u AS (SELECT 'item_ext' AS source, 'item' AS category, 'item_ext:' || k || CASE WHEN c > 0 THEN '#' || CAST(c AS VARCHAR) ELSE '' END AS sample_key,
               {strip("coalesce(instruction, '')")} AS system, {strip("coalesce(input, '')")} AS prompt, {strip("coalesce(output, '')")} AS response FROM ids)
, f AS (SELECT * FROM u WHERE {char_len('system', 'prompt', 'response')} <= 36000 AND NOT (prompt = '' AND response = ''))
SELECT source, category, sample_key, system, prompt, response, {split_case('rn', 'n')} AS split
FROM (SELECT *, {hrank('', 'sample_key', '42')} AS rn, count(*) OVER () AS n FROM f)""")
Q["generate_all_shuffled"] = with_(USER_CTES + ["item_caption", "items_j", "item_samples", "interest"], f"""
, evs AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY md5('42:' || CAST(user_id AS VARCHAR) || ':' ||
                                                                      CAST(e - 1 AS VARCHAR))) AS e2
          FROM ev WHERE user_id IN (SELECT user_id FROM elig))
SELECT task, key, system, prompt, response FROM item_samples
UNION ALL SELECT task, key, system, prompt, response FROM interest
UNION ALL SELECT 'next_item' AS task, CAST(user_id AS VARCHAR) AS key, '' AS system,
       {q(_G.USER_PROMPT_HEAD)} || coalesce(string_agg({event_line()}, {q(chr(10))} ORDER BY e2)
           FILTER (WHERE e2 < n_ev AND e2 <= 20), '') AS prompt,
       {q('<think>' + chr(10) + '</think>' + chr(10) + '["')} || max(tok) FILTER (WHERE e2 = n_ev) || '"]' AS response
FROM evs GROUP BY user_id""")
Q["length_report_subtypes"] = with_(["samples"], """
, c AS (SELECT category, substr(coalesce(system, ''), 1, 30) AS subtype, count(*) AS n FROM samples GROUP BY ALL)
SELECT category, rank, subtype, n, CAST(floor(n * 100 / total) AS BIGINT) AS pct FROM (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY n DESC, subtype) AS rank, sum(n) OVER (PARTITION BY category) AS total FROM c)
WHERE rank <= 5""")
