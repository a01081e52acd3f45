"""A training corpus from raw documents: toxicity, language, exact copies, near copies, packing.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and returns the documents that stay, with the
columns of ``documents``; the last returns the packed pieces. Between stages the documents are written as Parquet in
the shared folder and read again, which cuts lineage: a lost executor costs tasks of one stage alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mixprep.llm.common import fold, scratch_path, table
from mixprep.llm.exact_dedup import drop_copies
from mixprep.llm.language_id import drop_unknown, learn_profiles
from mixprep.llm.near_dedup import drop_near_copies
from mixprep.llm.packing import pack
from mixprep.llm.queries import tokenizer_path
from mixprep.llm.toxicity import drop_toxic, labelled_documents, learn_lexicon


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3; the lexicon is learned from the labels that op1 learns from."""
    seen = labelled_documents(docs, table(spark, sf_dir, "labels"), fold("id", 4) != 2)
    return drop_toxic(docs, learn_lexicon(seen), threshold=0.3)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is told apart; the profiles are learned from the rows that op8 learns from."""
    return drop_unknown(docs, learn_profiles(docs, usable=fold("id", 5) != 0))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.85."""
    return drop_near_copies(docs, percent=85)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that stay, in sequences of 2048 tokens."""
    return pack(docs, tokenizer_path("word_bpe_49k.json"), window=2048, end_id=1, payload="crc32")


STAGES = [("toxicity", toxicity), ("language_id", language), ("exact_dedup", exact_copies), ("near_dedup", near_copies), ("packing", packing)]

#: SQL has no tokenizer, compression or lexicon matching: the tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
