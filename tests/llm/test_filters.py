"""Toxicity (1) and language identification (8): held-out accuracy, matching by brute force, edges."""

import random
import zlib

import numpy as np
import pandas as pd
import pytest

from mixprep.llm import language_id, toxicity
from mixprep.llm.queries import op1_toxicity, op8_language_id

SF = "/root/testdata/sf0.1"


def auc(pos, neg):
    order = np.argsort(np.concatenate([pos, neg]), kind="stable")
    values = np.concatenate([pos, neg])[order]
    rank = pd.Series(values).rank().to_numpy()
    of = np.empty(len(order))
    of[order] = rank
    return (of[:len(pos)].sum() - len(pos) * (len(pos) + 1) / 2) / (len(pos) * len(neg))


def test_held_out_toxicity(spark):
    got = op1_toxicity(spark, SF).toPandas()
    docs, labels = pd.read_parquet(f"{SF}/documents.parquet"), pd.read_parquet(f"{SF}/labels.parquet")
    assert sorted(got.doc_id) == sorted(docs.doc_id) and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert auc(held.score[held.toxic == 1].to_numpy(), held.score[held.toxic == 0].to_numpy()) > 0.85
    assert (held.toxic[held.predicted == 1] == 1).mean() > 0.95 and (held.predicted[held.toxic == 1] == 1).mean() > 0.75


LEXICON = toxicity.Lexicon({"idiot": 3.0, "siob*": 2.0, "trash": 1.5, "scum": 1.0}, ("trash can",))


@pytest.mark.parametrize("text,weight", [
    ("an IDIOT here", 3.0), ("1d10t", 3.0), ("іdіоt", 3.0), ("ＩＤＩＯＴ!", 3.0), ("id​iot", 3.0), ("!d|ot!!", 3.0), ("$cum$$$", 1.0), ("tr@sh|", 1.5), ("idiotic", 0.0), ("anidiot", 0.0), ("slobber", 2.0), ("5l0b", 2.0),
    ("trash", 1.5), ("trash can", 0.0), ("Trash   CAN and trash", 1.5), ("trash\ncan't", 0.0), ("idiot idiot.idiot", 9.0), ("", 0.0), ("...", 0.0), ("scum,idiot", 4.0)])
def test_matches(text, weight):
    x = LEXICON.features(text)
    assert abs(x[0] - weight) < 1e-9


def test_matches_against_brute_force():
    rnd = random.Random(1)
    weights = {"ab": 1.0, "abc": 2.0, "ab*": 0.5, "ca*": 4.0, "b": 3.0}
    lexicon = toxicity.Lexicon(weights, ())
    for _ in range(300):
        words = ["".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 5))) for _ in range(rnd.randrange(0, 12))]
        want = sum(max([w for p, w in weights.items() if (x.startswith(p[:-1]) if p[-1] == "*" else x == p)], default=0) for x in words)
        assert lexicon.matches(" ".join(words))[0] == pytest.approx(want)


def test_longer_texts_of_equal_matches_score_lower():
    text = "idiot " + "fine " * 5
    a, b = LEXICON.features(text), LEXICON.features(text + "fine " * 500)
    assert LEXICON.score(a) > LEXICON.score(b) > LEXICON.score((0.0, 0.0))


def test_learning_finds_words_beginnings_and_leaves_chance_out(spark):
    rnd = random.Random(2)
    filler = ["".join(rnd.choice("mnopqrt") for _ in range(5)) for _ in range(300)]
    rows = []
    for i in range(600):
        words = [rnd.choice(filler) for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            words[3] = "vilest" if i % 2 else "grub" + rnd.choice(filler)
        rows.append((i, " ".join(words), int(toxic)))
    rows += [(1000, None, 1), (1001, "vilest", None), (1002, rows[0][1], 1)]
    found = toxicity.learn_lexicon(spark.createDataFrame(rows, "doc_id bigint, text string, toxic int"))
    assert toxicity.fold_text("vilest") in found.weights or toxicity.fold_text("vile") + "*" in found.weights
    assert "grub*" in found.weights and len(found.weights) <= 6
    assert found.score(found.features("a vilest thing")) > 0.3 > found.score(found.features("a plain thing"))


def test_no_labels_score_all_alike(spark, edges, edge_rows):
    empty = toxicity.learn_lexicon(spark.createDataFrame([], "doc_id bigint, text string, toxic int"))
    got = toxicity.toxicity(edges, empty).collect()
    assert len(got) == len(edge_rows) and len({r.score for r in got}) == 1


def test_toxicity_edges(edges, edge_rows, nothing):
    got = toxicity.toxicity(edges, LEXICON).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in edge_rows) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.toxicity(nothing, LEXICON).count() == 0
    assert toxicity.drop_toxic(edges, LEXICON).count() == len(edge_rows) and toxicity.drop_toxic(nothing, LEXICON).count() == 0
    assert toxicity.drop_toxic(edges, LEXICON).columns == edges.columns


def test_long_texts_count_whole(make_docs, tmp_path):
    docs = make_docs([(1, "fine " * 200_000 + "idiot"), (2, "fine " * 200_000)], tmp_path / "d")
    assert {r.doc_id: r.n_matches for r in toxicity.toxicity(docs, LEXICON).collect()} == {1: 1, 2: 0}


def test_held_out_languages(spark):
    got = op8_language_id(spark, SF).toPandas()
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    assert sorted(got.doc_id) == sorted(docs.doc_id) and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    both = got.merge(docs, on="doc_id")
    held = both[both.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.97
    letters = both.text.fillna("").map(lambda t: any(map(str.isalpha, t)))
    assert ((both.lang_pred == "und") == ~letters).all()
    assert got.rejected.mean() < 0.01


PROFILES = language_id.Profiles({"aa": b"the quick brown fox jumps over the lazy dog and runs away " * 20, "bb": "der schnelle braune fuchs springt über den faulen hund ".encode() * 20})


def test_smallest_compression_wins_by_brute_force():
    """Long texts: the chunk sizes with each dictionary, added up."""
    import zstandard as zstd
    text = "the quick brown fox runs over the lazy hund und springt " * 400
    raw = language_id.letters(text)
    sizes = {}
    for lang, content in PROFILES.content.items():
        c = zstd.ZstdCompressor(level=PROFILES.level, dict_data=zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT),
                                write_content_size=False, write_checksum=False, write_dict_id=False)
        d = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT))
        parts = [c.compress(raw[k:k + PROFILES.chunk]) for k in range(0, len(raw), PROFILES.chunk)]
        assert b"".join(d.decompress(p, max_output_size=PROFILES.chunk) for p in parts) == raw
        sizes[lang] = sum(map(len, parts))
    lang, margin = language_id.classify(text, PROFILES.compressors(), PROFILES.chunk)
    assert lang == "aa" and 0 < margin < 1 and abs(min(sizes.values()) / max(sizes.values()) + margin - 1) < 0.05


@pytest.mark.parametrize("text,lang", [("the lazy dog", "aa"), ("der faule hund springt", "bb"), ("THE LAZY DOG!!", "aa"), ("", "und"), (None, "und"), (" 12 3.4 ", "und")])
def test_short_texts(spark, text, lang):
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    r = language_id.language_id(df, PROFILES).first()
    assert r.lang_pred == lang and (lang != "und" or (r.score == 0 and r.rejected))


def test_language_edges(spark, edges, edge_rows, nothing):
    got = language_id.language_id(edges, PROFILES).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in edge_rows)
    assert language_id.language_id(nothing, PROFILES).count() == 0
    none = language_id.learn_profiles(nothing)
    assert none.content == {} and {r.lang_pred for r in language_id.language_id(edges, none).collect()} == {"und"}
    assert language_id.drop_unknown(edges, none).count() == len(edge_rows)
    stays = language_id.drop_unknown(edges, PROFILES)
    assert stays.columns == edges.columns and {r.doc_id for r in stays.collect()}.isdisjoint({1, 2, 3, 12})
    assert language_id.drop_unknown(nothing, PROFILES).count() == 0


def test_more_languages_than_the_bound(spark):
    df = spark.createDataFrame([(i, "some text", f"l{i}") for i in range(5)], "doc_id bigint, text string, lang string")
    with pytest.raises(ValueError):
        language_id.learn_profiles(df, max_languages=4)
