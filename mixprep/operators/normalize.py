"""Normalisation into the SFT sample schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from mixprep.functions.text import default_empty, history_misfit, history_prefix, py_strip


def split_misfits(df: DataFrame, history_col: str = "history") -> tuple[DataFrame, DataFrame]:
    """(rows that can be converted, rows whose history holds an entry that is not a pair)."""
    bad = history_misfit(history_col)
    return df.filter(~bad), df.filter(bad)


def alpaca_to_sft(df: DataFrame, keep=()) -> DataFrame:
    """N1 + N2 + N4: ``instruction/input/output/history`` -> ``system/prompt/response``.

    Fields are stripped like Python's ``str.strip()``; a non-empty history is
    flattened in front of the prompt. ``keep`` lists extra columns to carry.
    """
    prompt = F.concat(history_prefix("history"), py_strip(default_empty("input")))
    return df.select(*keep,
                     py_strip(default_empty("instruction")).alias("system"),
                     prompt.alias("prompt"),
                     py_strip(default_empty("output")).alias("response"))


def to_sft(df: DataFrame, keep=()) -> DataFrame:
    """Schema-aware normalisation (D5): SFT columns win, Alpaca columns fill the gaps.

    A source in SFT form passes through unchanged (missing fields -> ''); one in
    Alpaca form is converted as in :func:`alpaca_to_sft`. Rows with neither a
    prompt nor a response are kept but flagged by ``is_empty`` so callers can
    reject them.
    """
    cols = set(df.columns)

    def have(c):
        return F.col(c) if c in cols else F.lit(None).cast("string")

    hist = F.col("history") if "history" in cols else F.lit(None).cast("array<array<string>>")
    alp_prompt = F.concat(history_prefix(hist), py_strip(default_empty(have("input"))))
    system = F.coalesce(have("system"), py_strip(default_empty(have("instruction"))))
    prompt = F.coalesce(have("prompt"), F.when(have("input").isNotNull() | hist.isNotNull(), alp_prompt), F.lit(""))
    response = F.coalesce(have("response"), py_strip(default_empty(have("output"))))
    out = df.select(*keep, system.alias("system"), prompt.alias("prompt"), response.alias("response"))
    return out.withColumn("is_empty", (F.col("prompt") == "") & (F.col("response") == ""))


def chat_to_alpaca(conv: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Chat turns -> one Alpaca row per conversation.

    System turn -> instruction (''); the last user turn answered by the very next
    assistant turn -> input/output; earlier answered user turns -> history (NULL
    when there are none). Conversations without an answered user turn vanish.

    A conversation becomes one output row, so its turns are bounded by what a row
    can hold; ``lead`` runs per conversation and the pairs are collected once
    (hash-based object aggregation), the last pair being the last element. The system text is that of the
    first system turn (constant state per conversation). Turns without a conversation id belong to none and are left
    out (``orphan_turns`` returns them).
    """
    conv = conv.filter(F.col(conv_col).isNotNull())
    w = Window.partitionBy(conv_col).orderBy(turn_col)
    t = conv.select(conv_col, turn_col, role_col, text_col,
                    F.lead(role_col).over(w).alias("_nrole"), F.lead(text_col).over(w).alias("_ntext"))
    pairs = (t.filter((F.col(role_col) == "user") & (F.col("_nrole") == "assistant"))
             .select(conv_col, turn_col, F.col(text_col).alias("u"), F.col("_ntext").alias("a")))
    agg = pairs.groupBy(conv_col).agg(F.sort_array(F.collect_list(F.struct(turn_col, "u", "a"))).alias("_all"))
    agg = agg.withColumn("_last", F.element_at("_all", -1)).withColumn("_lt", F.col("_last")[turn_col])
    hist = F.transform(F.filter("_all", lambda p: p[turn_col] < F.col("_lt")), lambda p: F.array(p["u"], p["a"]))
    sysd = conv.filter(F.col(role_col) == "system").groupBy(conv_col).agg(F.min_by(text_col, turn_col).alias("_instr"))
    out = agg.join(sysd, conv_col, "left")
    return out.select(
        conv_col,
        F.coalesce(F.col("_instr"), F.lit("")).alias("instruction"),
        F.col("_last.u").alias("input"),
        F.col("_last.a").alias("output"),
        F.when(F.size(hist) > 0, hist).alias("history"))


#: Turns of a stretch, about.
STRETCH_ROWS = 100_000


def chat_pairs(conv: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
               parts: int | None = None) -> DataFrame:
    """N3 as rows, for conversations of any length: conversation, turn, u, a, is_last: a row per user turn that the very next turn answers.

    ``is_last`` marks the pair that is input and output; the others are history, which stays rows until something renders it. Turns are
    dealt by range of (conversation, turn) into stretches of about ``STRETCH_ROWS`` turns, so a conversation with a third of all turns is many stretches;
    ``lead`` runs within a stretch, and where a conversation goes on in a later one, that one's first turn is carried back (a row per stretch).
    Turns of one number go by role and digest of the text. Turns without a conversation id are left out.
    """
    from mixprep.session import stage
    spark = conv.sparkSession
    t = conv.filter(F.col(conv_col).isNotNull()).select(F.col(conv_col).alias("c"), F.col(turn_col).alias("t"), F.col(role_col).alias("role"), F.col(text_col).alias("text"),
                                                       F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("h"))
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-t.count() // STRETCH_ROWS))
    order = ["t", "role", "h"]
    placed = stage(t.repartitionByRange(parts, "c", *order).withColumn("part", F.spark_partition_id()), "stretches")
    first = placed.groupBy("c", "part").agg(F.min_by(F.struct("role", "text"), F.struct(*order)).alias("first"))
    several = placed.select("c", "part").distinct().groupBy("c").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("c")
    carried = first.join(several, "c", "left_semi").withColumn("carried", F.lead("first").over(Window.partitionBy("c").orderBy("part")))
    carried = stage(carried.filter("carried is not null").select("c", "part", "carried"), "carried")
    w = Window.partitionBy("c", "part").orderBy(*order)
    led = placed.withColumn("next", F.lead(F.struct("role", "text")).over(w)).join(carried, ["c", "part"], "left")
    following = F.coalesce("next", "carried")
    pairs = led.filter((F.col("role") == "user") & (following["role"] == "assistant")).select("c", "t", "h", F.col("text").alias("u"), following["text"].alias("a"))
    pairs = stage(pairs, "pairs")
    last = pairs.groupBy("c").agg(F.max(F.struct("t", "h")).alias("last"))
    out = pairs.join(last, "c")
    return out.select(F.col("c").alias(conv_col), F.col("t").alias(turn_col), "u", "a", (F.struct("t", "h") == F.col("last")).alias("is_last"))


def orphan_turns(conv: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Turns without a conversation id, which N3 leaves out."""
    return conv.filter(F.col(conv_col).isNull())
