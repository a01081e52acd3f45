"""The sub-word tokenizer against its library, one text at a time, and the mask where merges cross the border."""

import collections
import hashlib

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mixprep.functions import subword
from mixprep.functions.subword import Subword, encode_texts, token_counts
from mixprep.operators import encode as E
from mixprep.plans import queries as Q
from mixprep.plans.report import length_report

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.add_special_tokens(["<|im_start|>", "<|im_end|>"])
    return t


@pytest.fixture(scope="module")
def samples(spark):
    return {r.sample_id: r for r in Q._sft(spark, SF).collect()}


def chat(r):
    prefix = f"<|im_start|>system\n{r.system or ''}<|im_end|>\n<|im_start|>user\n{r.prompt or ''}<|im_end|>\n<|im_start|>assistant\n"
    return prefix, f"{r.response or ''}<|im_end|>\n"


def expected(library, prefix, rest, border):
    """(ids, tokens before the learned ones, crossing tokens) by the offsets of every token."""
    e = library.encode(prefix + rest, add_special_tokens=False)
    at = next((k for k, (_, b) in enumerate(e.offsets) if b > len(prefix)), len(e.ids))
    crossing = int(at < len(e.ids) and e.offsets[at][0] < len(prefix))
    n = {"mask": at + crossing, "learn": at, "prefix": len(library.encode(prefix, add_special_tokens=False).ids)}[border]
    return e.ids, n, crossing


def test_counts_by_the_library(spark, library, samples):
    got = {r.sample_id: r.n_tokens for r in Q.token_count_subword(spark, SF).collect()}
    assert got == {i: len(library.encode((r.system or "") + (r.prompt or "") + (r.response or ""), add_special_tokens=False).ids) for i, r in samples.items()}


def test_encode_query_by_the_library(spark, library, samples):
    rows = Q.encode_subword(spark, SF).collect()
    assert len(rows) == len(samples)
    for r in rows:
        ids, n, crossing = expected(library, *chat(samples[r.sample_id]), "mask")
        cut = ids[:2048]
        assert r.input_ids == ",".join(map(str, cut)) and r.n_tokens_full == len(ids) and r.n_border == crossing
        assert r.labels == ",".join(map(str, [-100] * min(n, len(cut)) + cut[n:])) and r.n_supervised == max(0, len(cut) - n)


def test_completion_query_crosses_borders(spark, library, samples):
    rows = Q.encode_completion(spark, SF).collect()
    for r in rows:
        s = samples[r.sample_id]
        ids, n, crossing = expected(library, s.prompt or "", s.response or "", "learn")
        assert (r.n_tokens_full, r.n_prefix, r.n_border, r.input_ids) == (len(ids), n, crossing, ",".join(map(str, ids[:2048])))
    assert sum(r.n_border for r in rows) > len(rows) // 4


CASES = [("Answer: inter", "national law"), ("a\n", "\n\nb"), ("x ", " y"), ("tail ", "🙂 ok"), ("", "all"), ("all", ""), ("", ""), (None, None), ("é", "́e"), ("日", "本語"),
         ("<|im_", "start|> joined"), ("w" * 300_000, "x" * 300_000), (" ", " "), ("un", "happy")]


@pytest.mark.parametrize("border", subword.BORDERS)
def test_borders_by_offsets(spark, library, border):
    df = spark.createDataFrame([(i, p, r, "x") for i, (p, r) in enumerate(CASES)], "id int, p string, r string, input_ids string").repartition(3)
    got = encode_texts(df, Subword(PATH), F.coalesce("p", F.lit("")), F.coalesce("r", F.lit("")), 50, ["id"], border)
    for r in got.collect():
        p, s = (x or "" for x in CASES[r.id])
        ids, n, crossing = expected(library, p, s, border)
        assert (list(r.input_ids), r.n_tokens_full, r.n_prefix, r.n_border) == (ids[:50], len(ids), n, crossing), CASES[r.id][:2]


def test_a_merge_over_the_border_is_told(spark):
    df = spark.createDataFrame([(1, "", "hi", "\n\nfoo"), (2, "", "hi", "foo")], "id int, system string, prompt string, response string")
    rows = {r.id: r for r in E.encode(df, 64, keep=["id"], tokenizer=Subword(PATH)).collect()}
    assert rows[1].n_border == 1 and rows[2].n_border == 0
    learn = {r.id: r for r in E.encode(df, 64, keep=["id"], tokenizer=Subword(PATH), border="learn").collect()}
    assert learn[1].n_supervised == rows[1].n_supervised + 1 and learn[2].n_supervised == rows[2].n_supervised
    with pytest.raises(ValueError):
        E.encode(df, 64, tokenizer=Subword(PATH), border="?")


def test_batches_are_cut_by_size(monkeypatch, spark, library):
    monkeypatch.setattr(subword, "BATCH_CHARS", 10)
    assert list(subword._batches([4, 4, 4, 30, 1, 1])) == [(0, 2), (2, 3), (3, 4), (4, 6)] and list(subword._batches([])) == []


def test_counts_of_no_rows_and_nulls(spark):
    df = spark.createDataFrame([], "id int, system string, prompt string, response string, n_tokens string")
    assert token_counts(df, Subword(PATH)).columns == ["id", "system", "prompt", "response", "n_tokens"]
    assert token_counts(df, Subword(PATH)).count() == 0
    df = spark.createDataFrame([(1, None, None, None)], df.schema.simpleString()[7:-1].replace(",n_tokens:string", "").replace(":", " "))
    assert [r.n_tokens for r in token_counts(df, Subword(PATH)).collect()] == [0]


def test_pipeline_and_report(spark, library, samples):
    rows = Q.encode_pipeline_subword(spark, SF).collect()
    for r in rows:
        ids, n, _ = expected(library, *chat(samples[r.sample_id]), "mask")
        assert 10 < len(ids) <= 1024 and r.ids_md5 == hashlib.md5(",".join(map(str, ids)).encode()).hexdigest() and r.n_supervised == len(ids) - n
    eval_ids = {r.sample_id for r in rows if r.split == "eval"}
    assert eval_ids and not eval_ids & {r.sample_id for r in rows if r.split == "train"}
    want = collections.Counter()
    for r in samples.values():
        want[r.category, len(library.encode(f"{r.system or ''}{r.prompt or ''}{r.response or ''}", add_special_tokens=False).ids)] += 1
    for r in length_report(Q._sft(spark, SF), tokenizer=Subword(PATH)).collect():
        lens = sorted(x for (c, x), k in want.items() if c == r.category for _ in range(k))
        assert (r.n, r.min_len, r.max_len, r.avg_len, r.p50) == (len(lens), lens[0], lens[-1], sum(lens) // len(lens), lens[len(lens) // 2])
