"""Token counts (7), packing (4) and the word table below them, against the library and brute force."""

import zlib

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from mixprep.llm import packing, token_counts, word_tokens
from mixprep.llm.queries import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(text):
    words = word_tokens.WordTokens.of(PATH, "ids")
    return np.frombuffer(b"".join(words.values(word_tokens.split_words(text))), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list("abcThe'stve.,;!? \n\t\x0b\x1c\x85  \x01ÀéßǅİΣσ1٣🙂́")), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_ids_equal_the_library(text):
    assert ids_of(text) == Tokenizer_().encode(text, add_special_tokens=False).ids


def Tokenizer_(cache=[]):
    if not cache:
        cache.append(Tokenizer.from_file(PATH))
    return cache[0]


@pytest.mark.parametrize("text", ["", " ", "<|endoftext|> a<|startoftext|>b", "I'm he'll they've'S", "x" * 3000, "thethe" * 50 + ".", "a\r\nb\x0cc", "don''t ..!!"])
def test_ids_of_special_cases(library, text):
    assert ids_of(text) == library.encode(text, add_special_tokens=False).ids


def test_ids_of_real_texts(library):
    texts = pd.read_parquet(f"{SF}/documents.parquet").text.fillna("").tolist()
    assert [ids_of(t) for t in texts] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_every_piece_of_the_vocabulary_is_reached_by_ranks(library):
    """The ranks give the merges of the file: each whole word of the vocabulary is one token."""
    words = [w[:-4] for w in library.get_vocab() if w.endswith("</w>") and w[:-4].isalpha()]
    table = word_tokens.WordTokens(PATH, "ids")
    got = table.values(words)
    want = library.encode_batch(words, add_special_tokens=False)
    assert len(words) > 20_000 and [np.frombuffer(g, "<u4").tolist() for g in got] == [e.ids for e in want]


def test_a_full_table_keeps_giving_right_values(monkeypatch):
    monkeypatch.setattr(word_tokens, "KEPT_WORDS", 10)
    table = word_tokens.WordTokens(PATH, "count")
    words = [f"word{i % 37}" for i in range(200)]
    assert table.values(words) == table.values(words) == word_tokens.WordTokens(PATH, "count").values(words)


def test_safe_pieces_join_to_the_text():
    text = "ab cde  f " + "x" * 50 + " y z"
    pieces = word_tokens.safe_pieces(text, 7)
    assert "".join(pieces) == text and len(pieces) > 3
    assert sum(len(ids_of(p)) for p in pieces) == len(ids_of(text))


def test_counts_of_edges(edges, edge_rows, library):
    got = sorted(tuple(r) for r in token_counts.token_counts(edges, PATH).collect())
    want = sorted((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in edge_rows)
    assert [g[:3] for g in got] == want and all(g[3] == (g[2] > 2048) for g in got)


def test_counts_by_sentencepiece(spark, library):
    import sentencepiece
    path = tokenizer_path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, path).collect()}
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    assert got == {r.doc_id: len(sp.encode(r.text or "")) for r in docs.collect()}


def test_no_rows(nothing):
    assert token_counts.token_counts(nothing, PATH).count() == 0
    assert packing.pack(nothing, PATH).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_best_fit_decreasing_against_a_plain_search(lengths):
    window, offset = packing.best_fit_decreasing(lengths, 40)
    left = []
    want = {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [r for r in left if r >= lengths[i]]
        if fits:
            left.remove(min(fits))
            want[i] = min(fits)
            left.append(min(fits) - lengths[i])
        else:
            want[i] = 40
            left.append(40 - lengths[i])
    assert [40 - o for o in offset] == [want[i] for i in range(len(lengths))]  # the same capacities were taken
    for w in set(window):
        spans = sorted((offset[i], lengths[i]) for i in range(len(lengths)) if window[i] == w)
        at = 0
        for o, n in spans:
            assert o == at
            at += n
        assert at <= 40


def check_pieces(rows: pd.DataFrame, ids: list[tuple[int, list[int]]], window: int):
    assert rows.length.sum() == sum(len(x) for _, x in ids)
    for _, s in rows.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *np.cumsum(s.length).tolist()[:-1]]
        total = s.length.sum()
        assert total <= window and set(s.sequence_length) == {total}
        assert set(s.padded_length) == {total if total & (total - 1) == 0 else window}


@pytest.mark.parametrize("window,block", [(2048, 8192), (16, 4), (100, 3)])
def test_pack_edges(edges, edge_rows, library, window, block):
    rows = packing.pack(edges, PATH, window=window, block_rows=block, payload="ids").toPandas()
    ids = [(i, library.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in edge_rows]
    check_pieces(rows, ids, window)
    for i, want in ids:
        own = rows[rows.doc_id == i].sort_values("start", kind="stable")
        copies = sum(j == i for j, _ in ids)
        got = sorted(own.groupby("start").ids.apply(list).items())
        assert [s for s, _ in got] == list(range(0, len(want), window)) and all(len(x) == copies and len(set(x)) == 1 for _, x in got)
        assert np.frombuffer(b"".join(x[0] for _, x in got), "<u4").tolist() == want
        assert set(own.doc_tokens) == {len(want)}


def test_pack_query_on_the_table(spark, library):
    from mixprep.llm.queries import op4_packing
    rows = op4_packing(spark, SF).toPandas()
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    ids = dict(zip(docs.doc_id, ([*e.ids, 1] for e in library.encode_batch(docs.text.fillna("").tolist(), add_special_tokens=False))))
    check_pieces(rows, list(ids.items()), 2048)
    for r in rows.itertuples():
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes())
    used = rows.drop_duplicates("sequence_id")
    assert used.sequence_length.sum() / used.padded_length.sum() > 0.98


def test_place_does_not_depend_on_partitioning(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = packing.pack(docs, PATH, payload="crc32", block_rows=50).toPandas()
    b = packing.pack(docs.repartition(7), PATH, payload="crc32", block_rows=50).toPandas()
    by = ["doc_id", "start"]
    pd.testing.assert_frame_equal(a.sort_values(by, ignore_index=True), b.sort_values(by, ignore_index=True))
