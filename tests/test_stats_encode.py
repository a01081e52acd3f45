"""Length statistics and encoding against brute force; batch padding invariants."""

import random

from pyspark.sql import functions as F

from mixprep.operators import encode as E, stats
from mixprep.operators.normalize import chat_to_alpaca


def test_rank_percentiles_brute_force(spark):
    rnd = random.Random(1)
    rows = [("a", rnd.choice([1, 2, 2, 3, 5, 5, 5, 9])) for _ in range(997)] + [("b", v) for v in range(1, 11)] + [("c", 4)]
    df = spark.createDataFrame(rows, "g string, v long")
    got = {r.g: (r.p50, r.p90, r.p99) for r in stats.rank_percentiles(df, ["g"], "v").collect()}
    for g in ("a", "b", "c"):
        vals = sorted(v for k, v in rows if k == g)
        n = len(vals)
        assert got[g] == (vals[n // 2], vals[int(n * 0.9)], vals[int(n * 0.99)])
    assert got["b"][0] == 6                       # not percentile_disc (which gives 5)


def test_split_counts_rollup(spark):
    df = spark.createDataFrame([("a", "train"), ("a", "eval"), ("b", "train")], "category string, split string")
    got = {r.category: (r.n_train, r.n_eval) for r in stats.split_counts(df).collect()}
    assert got == {"a": (1, 1), "b": (1, 0), "TOTAL": (2, 1)}


def test_encode_masks_prompt_and_truncates(spark):
    df = spark.createDataFrame([(1, "sys", "hello world", "答案 ok"), (2, "", "x " * 50, "y")],
                               "id long, system string, prompt string, response string")
    rows = {r.id: r for r in E.encode(df, max_len=20, keep=["id"]).collect()}
    r1 = rows[1]
    assert len(r1.input_ids) == len(r1.labels) == len(r1.attention_mask) == r1.n_tokens_full
    assert r1.input_ids[0] == 1 and r1.input_ids[-1] == 2          # <|im_start|> ... <|im_end|>
    assert r1.labels[:r1.n_prefix] == [-100] * r1.n_prefix
    assert r1.labels[r1.n_prefix:] == r1.input_ids[r1.n_prefix:] and r1.n_supervised == 4
    r2 = rows[2]                                                    # prefix longer than the window
    assert len(r2.input_ids) == 20 and r2.n_supervised == 0 and set(r2.labels) == {-100}
    assert r2.n_tokens_full > 20


def test_pad_batches_invariants(spark):
    df = spark.range(21).select(F.col("id"), F.sequence(F.lit(1), (F.col("id") % 7 + 1).cast("int")).alias("input_ids"))
    df = df.withColumn("labels", F.col("input_ids")).withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids")))
    out = E.pad_batches(df, 8, "id", max_len=5).collect()
    by = {}
    for r in out:
        by.setdefault(r.batch_id, []).append(r)
    assert sorted(len(v) for v in by.values()) == [5, 8, 8]         # last batch smaller
    for rows in by.values():
        w = rows[0].width
        assert all(len(r.input_ids) == len(r.labels) == len(r.attention_mask) == w <= 5 for r in rows)
        assert sorted(r.row_in_batch for r in rows) == list(range(len(rows)))
        for r in rows:
            k = sum(r.attention_mask)
            assert r.input_ids[k:] == [0] * (w - k) and r.labels[k:] == [-100] * (w - k)


def test_chat_to_alpaca_pairs(spark):
    conv = spark.createDataFrame([
        (1, 0, "system", "S"), (1, 1, "user", "u1"), (1, 2, "assistant", "a1"), (1, 3, "user", "u2"),
        (1, 4, "assistant", "a2"), (1, 5, "user", "dangling"),
        (2, 0, "user", "only"),
        (3, 0, "user", "q"), (3, 1, "assistant", "a")], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat_to_alpaca(conv).collect()}
    assert set(got) == {1, 3}
    assert (got[1].instruction, got[1].input, got[1].output, got[1].history) == ("S", "u2", "a2", [["u1", "a1"]])
    assert (got[3].instruction, got[3].history) == ("", None)


def test_pluggable_tokenizer(spark):
    from mixprep.functions.tokenize import python_token_ids
    df = spark.createDataFrame([("a bb ccc",), ("",)], "t string")
    def factory():  # nested, so cloudpickle ships it by value to the Python workers
        return lambda s: [len(w) for w in s.split()]
    got = [r[0] for r in df.select(python_token_ids("t", factory)).collect()]
    assert got == [[1, 2, 3], []]
