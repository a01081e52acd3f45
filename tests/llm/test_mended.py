"""Row keys, ties, names and shares that once went wrong."""

import time

import pytest
from pyspark.sql import functions as F

from mixprep.llm import language_id, shard_writer, toxicity
from mixprep.llm.embedding_dedup import embedding_dedup
from mixprep.llm.exact_dedup import drop_copies, exact_dedup
from mixprep.llm.near_dedup import drop_near_copies
from mixprep.llm.queries import tokenizer_path

WORDS = tokenizer_path("word_bpe_49k.json")


def test_equal_file_names_in_partition_folders(spark, tmp_path):
    df = spark.createDataFrame([(1, "same text", "a"), (2, "same text", "b"), (3, "other", "a")], "doc_id long, text string, lang string")
    path = str(tmp_path / "d e")
    df.coalesce(1).write.partitionBy("lang").parquet(path)
    rows = exact_dedup(spark, path).collect()
    assert len({r.locator for r in rows}) == 3 and sorted((r.doc_id, r.kept, r.group_size) for r in rows) == [(1, True, 2), (2, False, 2), (3, True, 1)]
    assert all(r.locator.startswith("lang=") for r in rows)
    assert sorted(r.doc_id for r in drop_copies(spark.read.parquet(path)).collect()) == [1, 3]
    one = str(tmp_path / "one.parquet")
    df.coalesce(1).write.parquet(one)
    file = next(p for p in (tmp_path / "one.parquet").iterdir() if p.suffix == ".parquet")
    assert sorted((r.doc_id, r.kept) for r in exact_dedup(spark, str(file)).collect()) == [(1, True), (2, False), (3, True)]


def test_hits_without_a_broadcast(spark, tmp_path, monkeypatch):
    from mixprep.llm import exact_dedup as module
    monkeypatch.setattr(module, "BROADCAST_HITS", 0)
    spark.range(300).select(F.col("id").alias("doc_id"), (F.col("id") % 40).cast("string").alias("text")).write.parquet(str(tmp_path / "d"))
    assert exact_dedup(spark, str(tmp_path / "d")).filter("kept").count() == 40


@pytest.mark.parametrize("name", ["copy_at", "dropped_key", "DROPPED_KEY", "copy_at_"])
def test_columns_with_working_names_stay(spark, name):
    words = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, words, "x"), (2, words, "y"), (3, "else", "z")], f"doc_id long, text string, {name} string")
    for out in (drop_copies(df), drop_near_copies(df)):
        assert out.columns == ["doc_id", "text", name] and sorted(r.doc_id for r in out.collect()) == [1, 3]


def test_labels_with_commas(spark):
    rows = [(1, [0.1], "a,0.5"), (2, [0.5, 0.1], "a"), (3, [0.5, 0.1], "a"), (4, [0.1], "1,a"), (5, [0.5, 0.1], "a,")]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")).collect()}
    assert got == {1: (0, 1), 2: (1, 2), 3: (1, 2), 4: (0, 4), 5: (0, 5)}


def test_exceptions_in_linear_time():
    lexicon = toxicity.Lexicon({"can*": 1.0, "idiot": 2.0}, ("trash can",))
    assert lexicon.matches("trash can idiot can") == (3.0, 2)
    took = []
    for n in (4_000, 32_000):
        began = time.process_time()
        assert lexicon.matches("trash can idiot " * n)[1] == n
        took.append(time.process_time() - began)
    assert took[1] < 40 * max(took[0], 0.005)


def test_outside_by_brute_force():
    import random
    rng = random.Random(1)
    for _ in range(300):
        best = {rng.randrange(40): 1.0 for _ in range(8)}
        spared = [(a, a + rng.randrange(9)) for a in (rng.randrange(40) for _ in range(5))]
        assert toxicity._outside(dict(best), list(spared)) == {s: w for s, w in best.items() if not any(x <= s < y for x, y in spared)}


def test_too_many_patterns_are_an_error(spark):
    name = lambda k: "".join(chr(97 + k // 26 ** j % 26) for j in range(4))
    rows = [(i, " ".join(f"{name(7 * i + j)} {w}" for j, w in enumerate(("alpha", "beta", "gamma") if i % 10 == 0 else ("nice", "words", "here"))), int(i % 10 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    with pytest.raises(ValueError, match="max_patterns"):
        toxicity.learn_lexicon(df, max_patterns=1, exceptions=())


def test_order_of_repeated_ids_does_not_depend_on_partitioning(spark):
    rows = [(7, f"word{i:02d}") for i in range(40)] + [(None, f"term{i:02d}") for i in range(40)] + [(i, "plain text") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for n in (1, 4):
        out = shard_writer.write_shards(df.repartition(n), WORDS, window=16).collect()
        found.append(sorted((str(r.doc_id), r.ids_crc32, r.slot) for r in out))
    assert found[0] == found[1] and len(found[0]) == 100


@pytest.mark.parametrize("kind", ["decimal(20,0)", "smallint", "string"])
def test_any_type_of_id(spark, kind):
    df = spark.range(5).select(F.col("id").cast(kind).alias("doc_id"), F.lit("a b").alias("text"))
    out = shard_writer.write_shards(df, WORDS, window=16)
    assert out.schema["doc_id"].dataType.simpleString() == kind and out.count() == 5


def test_dictionaries_hold_all_parts_of_a_text(spark):
    """The second half of a long text is in the dictionary, and so is every sampled text."""
    long = "alpha " * 20_000 + "omega " * 20_000
    rows = [(i, f"first{chr(97 + i)} " + long, "xx") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    raw = language_id.learn_profiles(df, sample_docs=1000).content["xx"]
    assert abs(raw.count(b"alpha") - raw.count(b"omega")) < 0.4 * raw.count(b"alpha") and len(raw) <= language_id.DICTIONARY_BYTES
    short = language_id.learn_profiles(spark.createDataFrame([(i, f"text number {chr(97 + i) * 5}", "yy") for i in range(20)], df.schema)).content["yy"]
    assert all((chr(97 + i) * 5).encode() in short for i in range(20))
    assert language_id._even([b"a" * 100, b"b" * 100], 1000) == b"a" * 100 + b" " + b"b" * 100
    cut = language_id._even([b"a" * 6400, b"b" * 6400], 1280)
    assert len(cut) <= 1280 and abs(cut.count(b"a") - cut.count(b"b")) < 100
