"""Tasks stay bounded where many rows share a place or an id."""

from collections import Counter

from pyspark.sql import functions as F

from mixprep.llm import packing, sharding
from mixprep.llm.queries import tokenizer_path


def test_places_of_small_sources_are_spread(make_docs, tmp_path):
    rows = [(i, f"t{i}", "en", f"own{i}") for i in range(300)] + [(300 + i, f"u{i}", "en", f"two{i // 2}") for i in range(300)]
    rows += [(600 + i, f"v{i}", "en", "big") for i in range(300)]
    got = sharding.interleave(make_docs(rows, tmp_path / "d"), shards=4, bucket_rows=50).collect()
    assert max(Counter(r.place * 18 >> 40 for r in got).values()) <= 100
    assert sorted(Counter(r.shard for r in got).values()) == [225] * 4
    big = Counter(r.shard for r in got if r.source == "big")
    assert max(big.values()) - min(big.values()) <= 40


def test_no_block_holds_all_rows_of_one_id(make_docs, tmp_path):
    rows = [(None, "one two three")] * 400 + [(7, "four five")] * 400 + [(1000 + i, f"text {i}") for i in range(400)]
    got = packing.pack(make_docs(rows, tmp_path / "d"), tokenizer_path("word_bpe_49k.json"), window=64, block_rows=100, payload="crc32").collect()
    assert len(got) == len(rows)
    assert max(Counter(r.sequence_id >> 32 for r in got).values()) <= 200


def test_places_of_repeated_ids_do_not_depend_on_partitioning(spark):
    """Rows of one id with equal lengths, equal rows in large numbers, and others: the same packing from any partitioning."""
    rows = [(7, f"word{i % 50} text") for i in range(200)] + [(None, "one two three")] * 300 + [(None, f"term{i}") for i in range(60)] + [(1000 + i, f"text {i}") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for n in (1, 5):
        got = packing.pack(df.repartition(n), tokenizer_path("word_bpe_49k.json"), window=64, block_rows=100, payload="crc32").collect()
        found.append(sorted((str(r.doc_id), r.ids_crc32, r.sequence_id, r.offset) for r in got))
    assert found[0] == found[1] and len(found[0]) == len(rows)
    assert max(Counter(s >> 32 for _, _, s, _ in found[0]).values()) <= 200
