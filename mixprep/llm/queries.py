"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mixprep.llm.common import fold, table


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from labelled rows whose ``crc32(doc_id) mod 4`` is not 2."""
    from mixprep.llm.toxicity import labelled_documents, learn_lexicon, toxicity
    docs = table(spark, sf_dir, "documents")
    seen = labelled_documents(docs, table(spark, sf_dir, "labels"), fold("id", 4) != 2)
    scored = toxicity(docs, learn_lexicon(seen), threshold=0.3)
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted", "n_matches")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes every text by the kind of the model (merging: the library's ids) and by Viterbi over the scores of its pieces; decodes both and holds
    the results against the text."""
    from mixprep.llm.sentencepiece_codec import encode
    path = tokenizer_path("piece_bpe_32k.model")
    text = F.replace(F.coalesce("text", F.lit("")), F.lit("\u2581"), F.lit(" "))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32(text.cast("binary")).alias("crc"))
    coded = encode(docs, path, keep={"crc": "bigint"}, viterbi=True, back="text_crc32")
    return coded.select("doc_id", "n_pieces", "n_byte_pieces", F.crc32("ids").alias("ids_crc32"), F.col("text_crc32_ids").alias("text_crc32"),
                        (F.col("text_crc32_ids") == F.col("crc")).alias("round_trip"), "n_viterbi_pieces", F.crc32("viterbi_ids").alias("viterbi_crc32"),
                        (F.col("text_crc32_viterbi_ids") == F.col("crc")).alias("viterbi_round_trip"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mixprep.llm.near_dedup import near_dedup
    return near_dedup(table(spark, sf_dir, "documents"), percent=85, words=5)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mixprep.llm.packing import pack
    return pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), window=2048, end_id=1, payload="crc32")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mixprep.llm.sharding import interleave
    rows = interleave(table(spark, sf_dir, "documents"), shards=8)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mixprep.llm.embedding_dedup import embedding_dedup
    return embedding_dedup(table(spark, sf_dir, "embeddings"), least=0.93)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mixprep.llm.token_counts import token_counts
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), limit=2048)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from documents whose ``crc32(doc_id) mod 5`` is not 0."""
    from mixprep.llm.language_id import language_id, learn_profiles
    docs = table(spark, sf_dir, "documents")
    found = language_id(docs, learn_profiles(docs, usable=fold("id", 5) != 0))
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "rejected")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mixprep.llm.exact_dedup import exact_dedup
    return exact_dedup(spark, f"{sf_dir}/documents.parquet").drop("locator")


def op10_shard_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mixprep.llm.shard_writer import write_shards
    rows = write_shards(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), window=256, end_id=1, pad_id=0)
    return rows.select("doc_id", "start", "length", F.col("index").alias("sequence_index"), "slot", "shard", "byte_offset", "ids_crc32")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mixprep.llm.whitening import whitening
    return whitening(table(spark, sf_dir, "embeddings"), components=16, scale=64.0, shift=1_000_000)


def op12_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mixprep.llm.exact_search import exact_top_k
    return exact_top_k(table(spark, sf_dir, "embeddings"), every=100, k=10, scale=1024.0)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mixprep.llm.conversation_repair import repair_damaged
    return repair_damaged(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_sentencepiece, op3_near_dedup, op4_packing, op5_sharding, op6_embedding_dedup, op7_token_counts, op8_language_id, op9_exact_dedup,
    op10_shard_writer, op11_whitening, op12_exact_search, op13_conversation_repair)}
ORACLE_SQL = {
    "op9_exact_dedup": r"""
with d as (select doc_id, coalesce(text, '') as t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') as norm from documents),
r as (select *, first_value(doc_id) over (partition by norm order by length(t) desc, doc_id) as keep_id,
             count(*) over (partition by norm) as group_size from d)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256 from r""",
    "op12_exact_search": r"""
with d as (select row_number() over () as row_key, vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as y
           from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.row_key, q.vec_id as query_id, c.vec_id,
             cast(list_sum(list_transform(list_zip(q.y, c.y), lambda p: p[1] * p[2])) as bigint) as score
      from d q join d c on q.vec_id % 100 = 0 and q.row_key <> c.row_key),
r as (select *, row_number() over (partition by row_key order by score desc, vec_id) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 10""",
}
