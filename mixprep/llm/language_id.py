"""Language ID (8): compression with per-language zstandard raw-content dictionaries.

A dictionary per language holds sample texts of that language, as they are. A text is compressed with each
of them, and the language whose dictionary gives the fewest bytes wins. Where the two best are
closer than a margin, the prediction is marked as rejected. Texts and dictionaries are lower case, with ASCII
digits, signs and white space as single blanks. Long texts are compressed in chunks, so that a dictionary
counts for all of a text, and not just for its beginning. Short texts follow a piece of the dictionary, whose
own size is taken off: alone they may not shrink at all, and all sizes would be equal.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mixprep.llm.common import arrow_map, filter_rows, keep_columns

#: Bytes of a dictionary and of a chunk; the compression level.
DICTIONARY_BYTES, CHUNK_BYTES, LEVEL = 192 << 10, 8 << 10, 5
#: Bytes up to which a text is short, and bytes of the dictionary put before it.
SHORT_BYTES, PRIMER_BYTES = 1 << 10, 128
UNKNOWN = "und"
#: Share of bytes by which the best language must beat the second.
MIN_MARGIN = 0.002
_LETTERS = bytes(c if chr(c).isalpha() else 32 for c in range(128)) + bytes(range(128, 256))


def letters(text: str) -> bytes:
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split())


@dataclass
class Profiles:
    """Language -> raw content of its dictionary."""
    content: dict[str, bytes]
    level: int = LEVEL
    chunk: int = CHUNK_BYTES

    def compressors(self) -> list[tuple[str, object, bytes, int]]:
        """(language, compressor, primer, size of the primer alone)."""
        import zstandard as zstd
        out = []
        for lang, raw in sorted(self.content.items()):
            d = zstd.ZstdCompressionDict(raw, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=self.level)
            c = zstd.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
            out.append((lang, c, raw[-PRIMER_BYTES:] + b" ", len(c.compress(raw[-PRIMER_BYTES:]))))
        return out


def classify(text: str, compressors: list, chunk: int) -> tuple[str, float]:
    """(language, margin): the margin is the share of bytes saved against the second best."""
    raw = letters(text)
    if len(raw) < SHORT_BYTES:
        sizes = sorted((max(1, len(c.compress(primer + raw)) - alone), lang) for lang, c, primer, alone in compressors)
    else:
        chunks = [raw[k:k + chunk] for k in range(0, len(raw), chunk)]
        sizes = sorted((sum([len(c.compress(x)) for x in chunks]), lang) for lang, c, _, _ in compressors)
    if len(sizes) < 2:
        return sizes[0][1], 1.0
    return sizes[0][1], (sizes[1][0] - sizes[0][0]) / sizes[1][0]


def learn_profiles(docs: DataFrame, usable: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                   sample_docs: int = 100, pieces: int = 8, max_languages: int = 256, dictionary_bytes: int = DICTIONARY_BYTES) -> Profiles:
    """Dictionaries from a bounded sample: about ``sample_docs`` labelled documents a language, chosen by a hash of the id, joined in hash order.

    The bound is on documents. All of them share the ``dictionary_bytes`` evenly, and of a text longer than its share ``pieces`` pieces are taken, one at a
    hashed place in each equal stretch of the whole text: no part of a text is left out for where it stands.

    ``usable`` is a condition on the column ``id``. Rows without language or text are left out. More than
    ``max_languages`` languages are an error, as the driver's share would no longer be bounded. Copies of a text count once.
    """
    rows = keep_columns(docs, {id_col: "id", text_col: "text", lang_col: "lang"}).filter("lang is not null and text is not null")
    if usable is not None:
        rows = rows.filter(usable)
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(max_languages + 1).collect()}
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not counts:
        return Profiles({})
    rate = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, sample_docs / n))])
    order = F.xxhash64(F.lit("language"), "id")
    chosen = rows.filter(F.shiftrightunsigned(order, 11) / F.lit(float(2 ** 53)) < rate[F.col("lang")])
    # A piece's characters: its part of an even share. Letters of more than one byte may make the whole longer; that is evened out below.
    size = max(8, dictionary_bytes // (sample_docs * pieces))
    begin = F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), lambda k: (F.floor((k + F.pmod(F.xxhash64("h", k), F.lit(1024)) / 1024.0) * (F.col("n") - size) / pieces) + 1).cast("int"))
    whole = F.transform(begin, lambda b: F.substr("text", b, F.lit(size)))
    taken = F.when(F.col("n") <= size * pieces, F.array("text")).otherwise(whole)
    texts: dict[str, dict[tuple, int]] = {}
    for r in chosen.select("lang", "text", order.alias("h"), F.char_length("text").alias("n")).select("lang", "h", taken.alias("pieces")).collect():
        of, text = texts.setdefault(r["lang"], {}), tuple(r["pieces"])
        of[text] = min(r["h"], of.get(text, r["h"]))
    joined = {lang: _even([b" ".join(letters(p) for p in t) for t in sorted(found, key=lambda t: (found[t], t))], dictionary_bytes) for lang, found in texts.items()}
    return Profiles({lang: raw for lang, raw in joined.items() if len(raw) >= 8})


def _even(texts: list[bytes], limit: int) -> bytes:
    """The texts joined, in ``limit`` bytes: where they are longer, stretches of all of them are left out evenly, a part of each run of 64 bytes."""
    raw = b" ".join(texts)
    if len(raw) <= limit:
        return raw
    keep = max(1, 64 * limit // len(raw))
    return b"".join(raw[k:k + keep] for k in range(0, len(raw), 64))[:limit]


def language_id(df: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """Per row: the id column, lang_pred, score (0 to 1: the margin, 0.1 or more counts as 1), rejected.

    ``und``, with score 0 and rejected, where the text is null or holds no letter, and for every text where
    no profile was learned. ``rejected`` also marks margins below ``min_margin``. Equal sizes go to the
    alphabetically first language. Whole texts are compressed. Repeated rows are predicted each; null ids stay;
    other columns are not read; no rows in, no rows out. One pass, no shuffle.
    """
    id_type = df.schema[id_col].dataType.simpleString()

    def make():
        one = _predictor(profiles)

        def step(batch: pa.RecordBatch) -> dict:
            got = [one(t) for t in batch.column("text").to_pylist()]
            return {"id": batch.column("id"), "lang_pred": [g[0] for g in got], "margin": pa.array([float(g[1]) for g in got], pa.float64())}
        return step

    out = arrow_map(keep_columns(df, {id_col: "id", text_col: "text"}), make, f"id {id_type}, lang_pred string, margin double")
    return out.select(F.col("id").alias(id_col), "lang_pred", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("margin") * 10)).alias("score"),
                      ((F.col("lang_pred") == UNKNOWN) | (F.col("margin") < min_margin)).alias("rejected"))


def _predictor(profiles: Profiles):
    compressors = profiles.compressors()

    def one(text: str | None) -> tuple[str, float]:
        if not compressors or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        return classify(text, compressors, profiles.chunk)
    return one


def drop_unknown(df: DataFrame, profiles: Profiles, text_col: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """The rows, with all their columns, whose language is predicted with a margin of ``min_margin`` at least.
    Null texts and texts without a letter go. With no profile learned, nothing can be told and all rows stay."""
    if not profiles.content:
        return df

    def make():
        one = _predictor(profiles)

        def keep(texts) -> list[bool]:
            got = [one(t) for t in texts.to_pylist()]
            return [lang != UNKNOWN and margin >= min_margin for lang, margin in got]
        return keep
    return filter_rows(df, make, text_col)
