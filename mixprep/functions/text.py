"""Row-wise text operators as JVM-side Column expressions.

All functions return ``pyspark.sql.Column`` and stay inside whole-stage codegen
except the small higher-order lambdas over arrays (history, tokens).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------

# Python's str.strip() removes exactly these code points (str.isspace()).
PY_WHITESPACE_CLASS = (
    r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

# Domain -> semantic-ID prefix token.
DOMAIN_PREFIX = {
    "goods": "<|prod_begin|>",
    "live": "<|living_begin|>",
    "video/video": "<|video_begin|>",
    "video/ad": "<|ad_begin|>",
}

# Domain -> display label used in prompts (goods, streamer, short video, ad).
DOMAIN_LABEL = {
    "goods": "商品",
    "live": "主播",
    "video/video": "短视频",
    "video/ad": "广告",
}

# Caption summary separators, tried in this order.
SUMMARY_SEPARATORS = ("。", "；", "，", " ")

# Chat template pieces (documented ChatML form).
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"

# History flattening pieces (Alpaca history -> prompt prefix).
HISTORY_USER = "Previous User: "
HISTORY_ASSISTANT = "\nPrevious Assistant: "
HISTORY_END = "\n\n"


# ---------------------------------------------------------------------------
# N1 / N4 / N5 / N6
# ---------------------------------------------------------------------------

def py_strip(col) -> Column:
    """Python ``str.strip()``: Spark ``trim`` only removes U+0020."""
    cls = PY_WHITESPACE_CLASS
    return F.regexp_replace(_c(col), f"^{cls}+|{cls}+$", "")


def default_empty(col) -> Column:
    """A missing field counts as the empty string."""
    return F.coalesce(_c(col), F.lit(""))


def char_len(*cols) -> Column:
    """Code-point length of the concatenation of the given fields."""
    parts = [F.char_length(default_empty(c)) for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def token_estimate(length_col, chars_per_token: float = 3.0) -> Column:
    """Tokens ~ chars / 3 (4096 tokens ~ 12288 chars)."""
    return F.ceil(_c(length_col) / F.lit(float(chars_per_token))).cast("long")


# ---------------------------------------------------------------------------
# N7 / N8 / N9 semantic IDs and captions
# ---------------------------------------------------------------------------

def _lookup(col, table: dict, default=None) -> Column:
    expr = None
    c = _c(col)
    for k, v in table.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def domain_prefix(domain_col) -> Column:
    """Domain -> prefix token; unknown domain -> ''."""
    return _lookup(domain_col, DOMAIN_PREFIX, "")


def domain_label(domain_col, table: dict | None = None) -> Column:
    """Domain -> display label; unknown domain -> NULL (callers quarantine it)."""
    return _lookup(domain_col, table or DOMAIN_LABEL)


def sid_token(domain_col, sid_col) -> Column:
    """``prefix(domain) + <s_a_i><s_b_j><s_c_k>``; NULL when the sid has < 3 parts."""
    sid = _c(sid_col)
    parts = [F.get(sid, i).cast("string") for i in range(3)]
    return F.concat(domain_prefix(domain_col), F.lit("<s_a_"), parts[0], F.lit("><s_b_"), parts[1],
                    F.lit("><s_c_"), parts[2], F.lit(">"))


def caption_summary(col, max_len: int = 50) -> Column:
    """First present separator -> first 3 parts re-joined, cut to ``max_len``."""
    c = _c(col)
    out = F.substring(c, 1, max_len)
    for sep in reversed(SUMMARY_SEPARATORS):
        out = F.when(F.instr(c, sep) > 0, F.substring(F.substring_index(c, sep, 3), 1, max_len)).otherwise(out)
    return out


# ---------------------------------------------------------------------------
# N2 / N11 / N12 / N15 / S6
# ---------------------------------------------------------------------------

def _is_pair(p: Column) -> Column:
    return F.coalesce(F.size(p) == 2, F.lit(False))


def history_misfit(history_col) -> Column:
    """Whether a history holds anything but pairs (then ``history_prefix`` fails, as unpacking does)."""
    return F.coalesce(F.exists(_c(history_col), lambda p: ~_is_pair(p)), F.lit(False))


def history_prefix(history_col) -> Column:
    """``Previous User: u\\nPrevious Assistant: a\\n\\n`` per pair, in order. A NULL part reads ``None``; an
    entry that is not a pair fails the job (``normalize.split_misfits`` sets such rows aside first)."""
    h = F.coalesce(_c(history_col), F.array().cast("array<array<string>>"))
    part = lambda p, i: F.coalesce(F.get(p, i), F.lit("None"))
    return F.array_join(
        F.transform(h, lambda p: F.when(_is_pair(p), F.concat(F.lit(HISTORY_USER), part(p, 0), F.lit(HISTORY_ASSISTANT), part(p, 1), F.lit(HISTORY_END)))
                    .otherwise(F.raise_error(F.lit("a history entry is not a pair")).cast("string"))),
        "")


def chat_prefix_text(system, prompt) -> Column:
    """N11 without the response, with the generation prompt."""
    return F.concat(F.lit(f"{IM_START}system\n"), default_empty(system), F.lit(f"{IM_END}\n{IM_START}user\n"),
                    default_empty(prompt), F.lit(f"{IM_END}\n{IM_START}assistant\n"))


def chat_full_text(system, prompt, response) -> Column:
    """System, user and assistant turns in the ChatML form."""
    return F.concat(chat_prefix_text(system, prompt), default_empty(response), F.lit(f"{IM_END}\n"))


def weight_by_content(weights: Sequence[tuple[str, float]], system="system", prompt="prompt",
                      response="response", scope: str = "joined", default: float = 1.0) -> Column:
    """Weight of the first category (in list order) whose name occurs in the text.

    ``scope='joined'`` searches system+prompt+response; ``'separate'`` searches
    prompt+response or system (no match across the system/prompt border).
    """
    s, p, r = default_empty(system), default_empty(prompt), default_empty(response)
    joined = F.concat(s, p, r)
    pr = F.concat(p, r)
    expr = None
    for name, w in weights:
        if scope == "joined":
            cond = F.instr(joined, name) > 0
        elif scope == "separate":
            cond = (F.instr(pr, name) > 0) | (F.instr(s, name) > 0)
        else:
            raise ValueError(f"unknown scope {scope!r}")
        val = F.lit(float(w))
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return F.lit(float(default)) if expr is None else expr.otherwise(F.lit(float(default)))


def category_from_name(name_col, categories: Sequence[str]) -> Column:
    """First category that prefixes the (file) name; NULL when none does."""
    c = _c(name_col)
    expr = None
    for cat in categories:
        cond = c.startswith(cat)
        expr = F.when(cond, F.lit(cat)) if expr is None else expr.when(cond, F.lit(cat))
    return expr


def alias_merge(category_col, suffix: str = "_ext") -> Column:
    """``x_ext`` -> ``x`` (every occurrence, like ``str.replace``)."""
    return F.replace(_c(category_col), F.lit(suffix), F.lit(""))
