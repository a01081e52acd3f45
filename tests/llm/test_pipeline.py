"""The pipeline: every stage on all that its predecessor kept, decisions held against brute force."""

import zlib

import pandas as pd
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from mixprep.llm import language_id, toxicity
from mixprep.llm.common import fold
from mixprep.llm.queries import tokenizer_path
from test_dedup import SPACES, near_by_brute_force

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "exact_dedup", "near_dedup", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[:5])
    rows = [s.count() for s in stages[:5]]
    assert rows == sorted(rows, reverse=True) and rows[4] > 0


def test_rows_stay_as_they_were(stages):
    first = {tuple(r) for r in stages[0].collect()}
    assert all({tuple(r) for r in s.collect()} <= first for s in stages[1:5])


def test_toxicity_and_language_decisions(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    lexicon = toxicity.learn_lexicon(toxicity.labelled_documents(stages[0], labels, fold("id", 4) != 2))
    assert set(texts(stages[1])) == {i for i, t in texts(stages[0]).items() if lexicon.score(lexicon.features(t or "")) < 0.3}
    profiles = language_id.learn_profiles(stages[1], usable=fold("id", 5) != 0)
    one = language_id._predictor(profiles)
    assert set(texts(stages[2])) == {i for i, t in texts(stages[1]).items() if one(t)[0] != "und" and one(t)[1] >= language_id.MIN_MARGIN}


def test_exact_decisions(stages):
    by = {}
    for i, t in texts(stages[2]).items():
        by.setdefault((t or "").translate(SPACES), []).append((-len(t or ""), i))
    assert set(texts(stages[3])) == {min(x)[1] for x in by.values()}


def test_near_decisions(stages):
    groups = near_by_brute_force(list(texts(stages[3]).items()))
    assert set(texts(stages[4])) == {i for i, (_, c) in groups.items() if i == c}


def test_pieces(stages):
    rows = stages[5].toPandas()
    t = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = {i: [*t.encode(x or "", add_special_tokens=False).ids, 1] for i, x in texts(stages[4]).items()}
    assert rows.groupby("doc_id").length.sum().to_dict() == {i: len(x) for i, x in want.items()}
    for r in rows.itertuples():
        import numpy as np
        assert r.ids_crc32 == zlib.crc32(np.array(want[r.doc_id][r.start:r.start + r.length], "<u4").tobytes())


def test_run_gives_the_rows_of_the_stages(spark, stages):
    key = ["doc_id", "start"]
    a, b = (x.toPandas().sort_values(key, ignore_index=True) for x in (corpus_pipeline.run(spark, SF), stages[5]))
    pd.testing.assert_frame_equal(a, b)


def test_every_stage_takes_edges_and_nothing(spark, edges, nothing):
    for docs in (edges, nothing):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, docs, SF)
            rows = got.count()
            assert rows >= (1 if docs is edges else 0), name
            assert docs is not nothing or rows == 0
            if name != "packing":
                assert got.columns == docs.columns
