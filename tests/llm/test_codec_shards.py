"""SentencePiece (2), sharding (5) and the shard writer (10): brute force, round trips and laws."""

import zlib

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st

from mixprep.llm import sentencepiece_codec as codec, shard_writer, sharding
from mixprep.llm.queries import op10_shard_writer, op2_sentencepiece, op5_sharding, tokenizer_path
from mixprep.llm.word_tokens import WordTokens, split_words

MODEL, WORDS = tokenizer_path("piece_bpe_32k.model"), tokenizer_path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pieces():
    return codec.Pieces.of(MODEL)


@pytest.fixture(scope="module")
def scores(pieces):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    usable = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    return {sp.id_to_piece(i): (i, sp.get_score(i)) for i in usable}


def ids_of(pieces, text):
    return np.frombuffer(b"".join(pieces.values(pieces.units(text))), "<u4").tolist()


def by_brute_force(text, scores, pieces):
    """Plain dynamic programming over the whole text, one character after another."""
    if not text:
        return []
    s = "▁" + text.replace(" ", "▁")
    low = min(v for _, v in scores.values()) - codec.UNKNOWN_PENALTY
    best, back = [0.0], [None]
    for e in range(1, len(s) + 1):
        found = []
        for b in range(max(0, e - 16), e):
            if s[b:e] in scores:
                found.append((best[b] + scores[s[b:e]][1], -b, scores[s[b:e]][0]))
            elif b == e - 1:
                found.append((best[b] + low, -b, None))
        score, b, i = max(found, key=lambda f: f[:2])
        best.append(score)
        back.append((-b, i))
    out, e = [], len(s)
    while e:
        b, i = back[e]
        out = ([i] if i is not None else [pieces.byte_id[x] for x in s[b:e].encode()]) + out
        e = b
    return out


@settings(max_examples=250, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list("the quick, on  \n\tandé日🙂ß")), st.characters(exclude_categories=["Cs"], exclude_characters="▁")), max_size=50))
def test_viterbi_by_brute_force_and_round_trip(text):
    pieces = codec.Pieces.of(MODEL)
    got = ids_of(pieces, text)
    assert got == by_brute_force(text, _scores(), pieces)
    assert pieces.decode(np.array(got, "<u4").tobytes()) == text


def _scores(cache=[]):
    if not cache:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
        usable = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        cache.append({sp.id_to_piece(i): (i, sp.get_score(i)) for i in usable})
    return cache[0]


def test_real_texts_by_brute_force(pieces, scores):
    for t in pd.read_parquet(f"{SF}/documents.parquet").text.fillna("").tolist()[:40]:
        assert ids_of(pieces, t[:3000]) == by_brute_force(t[:3000], scores, pieces)


def test_decode_agrees_with_the_library(pieces):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for t in ("a b  c", " lead", "trail ", "日本🙂", "x\ny", "", "  "):
        ids = sp.encode(t)
        assert pieces.decode(np.array(ids, "<u4").tobytes()) == sp.decode(ids) == t


def test_codec_edges(edges, edge_rows, nothing):
    coded = codec.encode(edges, MODEL)
    back = codec.decode(coded, MODEL)
    assert sorted((r.doc_id, r.text) for r in back.collect()) == sorted((i, t or "") for i, t in edge_rows)
    assert all(r.n_pieces == len(r.ids) // 4 for r in coded.collect())
    assert codec.encode(nothing, MODEL).count() == 0 and codec.decode(codec.encode(nothing, MODEL), MODEL).count() == 0


def test_codec_query(spark):
    rows = op2_sentencepiece(spark, SF).toPandas()
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert rows.round_trip.all() and len(rows) == len(docs)
    want = {i: np.array(library.encode(t or ""), "<u4").tobytes() for i, t in zip(docs.doc_id, docs.text)}
    assert {r.doc_id: (r.n_pieces, r.ids_crc32) for r in rows.itertuples()} == {i: (len(x) // 4, zlib.crc32(x)) for i, x in want.items()}


def check_shards(rows: pd.DataFrame, docs: pd.DataFrame, shards: int):
    assert len(rows) == len(docs)
    counts = rows.groupby("shard").size().reindex(range(shards), fill_value=0)
    assert counts.max() - counts.min() <= 1
    for _, s in rows.groupby("shard"):
        assert sorted(s.slot) == list(range(len(s)))


def test_sharding_query(spark):
    rows = op5_sharding(spark, SF)
    plan = rows._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    rows, docs = rows.toPandas(), pd.read_parquet(f"{SF}/documents.parquet")
    check_shards(rows, docs, 8)
    want = {i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in zip(docs.doc_id, docs.text)}
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows.itertuples()} == want and set(rows.law) == {"rows"} and rows.grown_shard.isna().all()


@pytest.mark.parametrize("bucket_rows", [2000, 40, 7])
def test_every_shard_matches_the_mixture(spark, bucket_rows):
    """A source with a third of all rows, large, small and null ones."""
    rows = [(i, f"t{i}", "hot" if i % 3 == 0 else "mid" if i % 7 else None if i % 2 else "few") for i in range(3001)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = sharding.interleave(df, shards=8, bucket_rows=bucket_rows).toPandas()
    check_shards(got, pd.DataFrame(rows), 8)
    got["source"] = got.source.fillna("-")
    share = got.groupby("source").size() / len(got)
    for _, s in got.groupby("shard"):
        assert ((s.groupby("source").size() - share * len(s)).abs() <= 2).all()
    again = sharding.interleave(df.repartition(5), shards=8, bucket_rows=bucket_rows * 3).toPandas()
    key = ["doc_id"]
    assert got.sort_values(key)[["shard", "slot"]].values.tolist() == again.sort_values(key)[["shard", "slot"]].values.tolist()


def test_order_by_brute_force(spark):
    rows = [(i, f"t{i}", f"s{i % 4 if i % 5 else 0}") for i in range(500)]
    got = sharding.interleave(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), shards=3, bucket_rows=20).toPandas()
    got = got.sort_values(["shard", "slot"])
    for _, s in got.groupby("source"):
        steps = s.place.to_numpy() * len(s) / 2 ** 40                       # rank - 1, and the source's shift by less than a step
        assert 0 <= steps[0] < 1
        assert np.allclose(steps - steps[0], np.arange(len(s)), atol=1e-3)    # the order of all rows keeps that of each source, without gaps
    assert got.place.is_monotonic_increasing


def test_sharding_edges(edges, edge_rows, nothing):
    got = sharding.interleave(edges, shards=8).toPandas()
    check_shards(got, pd.DataFrame(edge_rows), 8)
    assert sorted(zip(got.doc_id, got["size"])) == sorted((i, len((t or "").encode()) + 1) for i, t in edge_rows)
    assert sharding.interleave(nothing).count() == 0
    check_shards(sharding.interleave(edges.limit(3), shards=8).toPandas(), pd.DataFrame(range(3)), 8)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_feistel_is_a_permutation_with_an_inverse(n):
    slots = shard_writer.feistel(np.arange(n), n, 7)
    assert sorted(slots.tolist()) == list(range(n))
    assert shard_writer.feistel(slots, n, 7, inverse=True).tolist() == list(range(n))
    if n > 100:
        assert (slots != shard_writer.feistel(np.arange(n), n, 8)).mean() > 0.9 and abs(np.corrcoef(slots, np.arange(n))[0, 1]) < 0.15


def sequences(rows, window):
    table, out = WordTokens.of(WORDS, "ids"), []
    for i, t in rows:
        ids = np.frombuffer(b"".join(table.values(split_words(t or ""))), "<u4").tolist() + [1]
        out += [(i, k, ids[k:k + window]) for k in range(0, len(ids), window)]
    return out


def check_files(rows: pd.DataFrame, folder: str, want, window: int, shard_bytes: int):
    n, per = len(want), shard_writer.per_shard(window, shard_bytes)
    assert sorted(rows.slot) == list(range(n)) and sorted(rows["index"]) == list(range(n))
    assert (rows["index"] == shard_writer.feistel(rows.slot.to_numpy(), n, 20_240, inverse=True)).all()
    records = list(shard_writer.read_slots(folder, 0, n, window, per))
    assert len(records) == n
    found = []
    for r in rows.itertuples():
        assert (r.shard, r.byte_offset) == (r.slot // per, r.slot % per * window * 2)
        ids = records[r.slot][:r.length]
        assert not records[r.slot][r.length:].any() and zlib.crc32(ids.tobytes()) == r.ids_crc32
        found.append((r.doc_id, r.start, ids.tolist()))
    assert sorted(found) == sorted(want)
    middle = list(shard_writer.read_slots(folder, n // 2, n, window, per))      # going on from the middle
    assert np.array_equal(middle, records[n // 2:])


@pytest.mark.parametrize("window,shard_bytes", [(256, 16 << 20), (16, 320)])
def test_shards_hold_every_sequence(spark, edges, edge_rows, window, shard_bytes):
    rows = shard_writer.write_shards(edges.filter("doc_id not in (6, 7)"), WORDS, window=window, shard_bytes=shard_bytes).toPandas()
    check_files(rows, rows.folder[0], sequences([r for r in edge_rows if r[0] not in (6, 7)], window), window, shard_bytes)


def test_long_documents_and_the_shuffled_path(spark, edges, edge_rows, monkeypatch):
    monkeypatch.setattr(shard_writer, "BROADCAST_ROWS", 0)
    rows = shard_writer.write_shards(edges, WORDS, window=512, shard_bytes=64 << 10).toPandas()
    check_files(rows, rows.folder[0], sequences(edge_rows, 512), 512, 64 << 10)


def test_order_does_not_depend_on_partitioning(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    by = ["doc_id", "start"]
    a, b = (shard_writer.write_shards(d, WORDS).toPandas().sort_values(by, ignore_index=True).drop(columns="folder") for d in (docs, docs.repartition(6)))
    pd.testing.assert_frame_equal(a, b)


def test_a_file_written_again_is_the_same_file(tmp_path):
    for _ in range(2):
        shard_writer.put(f"file://{tmp_path}/x", "shard-000000.bin", b"abcd")
    assert [p.name for p in (tmp_path / "x").iterdir()] == ["shard-000000.bin"] and (tmp_path / "x/shard-000000.bin").read_bytes() == b"abcd"


def test_writer_query_and_nothing(spark, nothing):
    rows = op10_shard_writer(spark, SF).toPandas()
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    want = sequences(list(zip(docs.doc_id, docs.text)), 256)
    assert sorted(zip(rows.doc_id, rows.start, rows.length)) == sorted((i, k, len(x)) for i, k, x in want)
    assert sorted(rows.slot) == list(range(len(want)))
    assert shard_writer.write_shards(nothing, WORDS).count() == 0
