"""Rows are told apart by their place, not by their ids or the number of rows in their files."""

from pyspark.sql import functions as F

from mixprep.llm import exact_dedup, near_dedup

WORDS = [f"w{k}" for k in range(60)]
A, A2 = " ".join(WORDS), " ".join([*WORDS[:-1], "end"])
B, B2 = " ".join(reversed(WORDS)), " ".join([*reversed(WORDS[1:]), "end"])
C = "a text that has no like in the whole of this small table of rows"


def near(docs):
    return [(r.doc_id is None, r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_dedup(docs).collect()]


def test_rows_that_repeat_an_id_are_linked_by_their_own_text(make_docs, tmp_path):
    docs = make_docs([(1, C), (5, A), (5, B), (6, A2), (7, B2)], tmp_path / "d")
    got = near(docs)
    assert sorted((i, c) for _, i, _, c, _ in got) == [(1, 1), (5, 5), (5, 5), (6, 5), (7, 5)]
    assert [k for *_, k in got].count(True) == 3
    assert sorted(r.text for r in near_dedup.drop_near_copies(docs).collect()) == sorted([C, A, B])


def test_a_unique_text_stays_when_its_namesake_goes(make_docs, tmp_path):
    docs = make_docs([(5, A), (6, A2), (6, C)], tmp_path / "d")
    assert sorted(r.text for r in near_dedup.drop_near_copies(docs).collect()) == sorted([A, C])


def test_rows_without_ids_are_documents(make_docs, tmp_path):
    docs = make_docs([(None, A), (9, A2), (None, B), (None, B), (None, B2), (None, None)], tmp_path / "d")
    got = near(docs)
    assert sorted(str(c) for *_, c, _ in got) == ["9", "9"] + ["None"] * 4
    stays = [(r.doc_id, r.text) for r in near_dedup.drop_near_copies(docs).collect()]
    assert (9, A2) in stays and (None, None) in stays and len(stays) == 3


def test_copies_are_those_of_the_frame_not_of_its_files(spark, make_docs, tmp_path):
    docs = make_docs([(1, "a b"), (2, "ab"), (3, "x y"), (4, "z")], tmp_path / "d")
    assert exact_dedup.plain_path(docs) is not None
    other = docs.withColumn("text", F.when(F.col("doc_id") < 3, F.concat("text", F.col("doc_id").cast("string"))).otherwise(F.lit("same")))
    got = {r.doc_id: r.text for r in exact_dedup.drop_copies(other).collect()}
    assert got == {1: "a b1", 2: "ab2", 3: "same"}
    renamed = docs.select(F.col("doc_id"), F.col("text").alias("lang"), F.lit("one").alias("text"))
    assert [r.lang for r in exact_dedup.drop_copies(renamed).collect()] == ["a b"]
    assert exact_dedup.plain_path(other) is None and exact_dedup.plain_path(docs.filter("doc_id > 0")) is None
    assert exact_dedup.plain_path(spark.read.schema("doc_id bigint, text string").parquet(str(tmp_path / "d"))) is None
