"""Toxicity (1): a weighted lexicon matched by Aho-Corasick on folded text, normalised by length.

* Folding: homoglyphs of other scripts and digit or sign substitutions become plain letters, so that
  a disguised word meets its lexicon entry. Letters that one sign may stand for (i, l, 1, !, |) share
  one class. Patterns are folded alike.
* Lexicon: whole words and word beginnings with a weight each, learned from labelled rows: by how much the log-odds
  of a document that holds them, at the lower confidence bound of P(toxic | pattern), exceed those of all.
* Exception phrases: matches inside one of them do not count.
* Score: matched weights, and matched weights a word, through a logistic curve fitted to the same rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mixprep.llm.common import arrow_map, filter_rows, keep_columns, rate_sample, ship, stage
from mixprep.llm.near_dedup import shingle_set

#: Letters of other scripts that look like Latin ones, and digits and signs that stand for letters.
HOMOGLYPHS = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ԁ": "d", "ԛ": "q", "һ": "h", "ј": "j",
              "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
              "υ": "u", "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ո": "n", "օ": "o"}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
#: Signs that do so only before a letter; elsewhere they are signs.
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i"}
#: Harmless phrases around words that lexicons tend to hold.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "clown car", "circus clown", "sore loser", "pond scum")
#: Matched weight above which more adds nothing but density.
MOST = 30.0
#: Characters of a word beginning.
PREFIXES = (4, 5, 6, 7, 8)


def _fold_table() -> dict[int, str]:
    table = {ord(a): b for a, b in HOMOGLYPHS.items()}
    table |= {ord(a.upper()): b for a, b in HOMOGLYPHS.items() if len(a.upper()) == 1}
    table |= {ord(a): b for a, b in SUBSTITUTES.items()}
    wide = {c: unicodedata.normalize("NFKC", chr(c)).lower() for c in range(0xFF01, 0xFF5F)}              # full width
    table |= {c: SUBSTITUTES.get(v, v) if v.isalnum() else " " for c, v in wide.items()}
    table |= {c: "" for c in (0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD)}                              # invisible
    table = {c: "i" if v == "l" else v for c, v in table.items()}
    return table | {ord("l"): "i", ord("L"): "i"}


FOLD = _fold_table()
#: Folding of plain ASCII at C speed; ``SIGNS`` stay for the pattern below.
_ASCII_FOLD = bytes(ord(FOLD.get(ord(chr(c).lower()), chr(c).lower())) if chr(c).isalpha() or chr(c) in SUBSTITUTES else c if chr(c) in SIGNS else 32
                    for c in range(128)) + bytes(range(128, 256))
_SIGN = re.compile(rb"([@$!|])(?=[a-z\x80-\xff])|[@$!|]+")


def fold_text(text: str) -> str:
    """Folded lower-case letters; signs and white space become blanks."""
    raw = text.encode("utf-8", "surrogatepass").translate(_ASCII_FOLD)  # bytes of other letters are above 127 and stay
    if b"@" in raw or b"$" in raw or b"!" in raw or b"|" in raw:
        raw = _SIGN.sub(lambda m: SIGNS[m[1].decode()].encode() if m[1] else b" ", raw)
    if raw.isascii():
        return raw.decode("ascii")
    text = raw.decode("utf-8", "surrogatepass")
    for c in set(text):
        if ord(c) > 127 and ord(c) in FOLD:
            text = text.replace(c, FOLD[ord(c)])
    return text.lower()


def patterns_of(folded: str) -> set[str]:
    """The words of a text, and their beginnings marked with ``*``."""
    words = {w for w in folded.split() if len(w) > 2}
    return words | {w[:k] + "*" for w in words for k in PREFIXES if len(w) > k}


@dataclass
class Lexicon:
    """Folded pattern -> weight; a pattern that ends in ``*`` matches word beginnings, others whole words.

    ``curve`` holds intercept and the slopes of the matched weight, up to ``MOST``, and of
    log(1 + 100 * matched weight / (words + 20)).
    """
    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] = (-4.0, 2.0, 2.0)
    _automaton: object = field(default=None, repr=False, compare=False)

    def automaton(self):
        """Patterns with a blank before (and behind, for whole words), over text framed by blanks."""
        if self._automaton is None:
            import ahocorasick
            made: dict[str, list] = {}
            for p, w in self.weights.items():
                key = f" {p[:-1]}" if p.endswith("*") else f" {p} "
                made[key] = [max(w, made.get(key, [0])[0]), len(key), False]
            for p in self.exceptions:
                made[f" {' '.join(fold_text(p).split())} "] = [0.0, len(" ".join(fold_text(p).split())) + 2, True]
            a = ahocorasick.Automaton()
            for key, value in made.items():
                a.add_word(key, tuple(value))
            a.make_automaton()
            self._automaton = a
        return self._automaton

    def matches(self, folded: str) -> tuple[float, int]:
        """(sum of weights, number) of matched words; a word counts once, by its heaviest pattern."""
        a = self.automaton()
        if not len(a):
            return 0.0, 0
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (weight, length, exception) in a.iter(f" {folded} "):
            start = end - length + 1
            if exception:
                spared.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
        if spared and best:
            best = _outside(best, spared)
        return sum(best.values()), len(best)

    def features(self, text: str) -> tuple[float, float, int]:
        folded = fold_text(text)
        if "  " in folded:
            folded = " ".join(folded.split())
        weight, n = self.matches(folded)
        if not n:
            return 0.0, 0.0, 0
        words = folded.count(" ") + 1
        return min(weight, MOST), math.log1p(100 * weight / (words + 20)), n

    def score(self, x: tuple[float, float]) -> float:
        a, b, c = self.curve
        z = max(-30.0, min(30.0, a + b * x[0] + c * x[1]))
        return 1 / (1 + math.exp(-z))


def _outside(best: dict[int, float], spared: list[tuple[int, int]]) -> dict[int, float]:
    """The matches that begin in none of the spared stretches ``[a, b)``: one pass over both in order."""
    spared.sort()
    out, reach, k = {}, -1, 0
    for s in sorted(best):
        while k < len(spared) and spared[k][0] <= s:
            reach = max(reach, spared[k][1])
            k += 1
        if s >= reach:
            out[s] = best[s]
    return out


def _lower_bound(hits: float, n: float, z: float = 2.6) -> float:
    """Wilson's lower confidence bound of a share."""
    p = hits / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps with a small ridge; slopes are kept from falling below 0."""
    m = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(3)
    ridge = np.diag([1e-3, 0.05, 0.05])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(m @ w, -30, 30)))
        step = np.linalg.solve(m.T @ (m * (p * (1 - p))[:, None]) + ridge, m.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(max(w[1], 0)), float(max(w[2], 0))


def learn_lexicon(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = 12_000,
                  max_patterns: int = 4_000, min_docs: int = 5, least: float = 0.35, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """Lexicon and curve from labelled documents.

    Learns from all rows up to ``max_rows``, beyond that from a hash sample of that expected size
    (bounded and documented: what the driver receives is at most the patterns held by ``min_docs`` toxic
    rows of the sample, and three numbers a row). Rows without a label are left out. Of texts that share their
    least shingle hash, as copies and most near copies do, one counts for each label: a copied text says no more
    about its words than one. No labelled row, or none of one class: an empty lexicon, which scores all texts alike.
    """
    rows = keep_columns(labelled, {id_col: "id", text_col: "text", label_col: "label"}).filter("label is not null")
    rows = rows.select("id", F.coalesce("text", F.lit("")).alias("text"), F.col("label").cast("int").alias("label"))
    rows = rate_sample(rows, "id", max_rows, rows.count())
    ship(labelled.sparkSession)

    def family():
        def step(batch: pa.RecordBatch) -> dict:
            sets = [shingle_set(t) for t in batch.column("text").to_pylist()]
            return {"family": pa.array([int(s[0].astype(np.int64)) if len(s) else None for s in sets], pa.int64()),
                    **{c: batch.column(c) for c in ("id", "text", "label")}}
        return step

    id_type = rows.schema["id"].dataType.simpleString()
    rows = arrow_map(rows, family, f"family bigint, id {id_type}, text string, label int")
    rows = rows.groupBy("family", "label").agg(F.min(F.struct("id", "text")).alias("first")).select("first.text", "label")
    rows = stage(rows.repartition(16), "labelled")   # bounded; both passes below read it

    def count(batches):
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        total = [0, 0]
        for b in batches:
            for text, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
                seen[1 if label else 0].update(patterns_of(fold_text(text)))
                total[1 if label else 0] += 1
        names = list(set(seen[0]) | set(seen[1]))
        yield pa.RecordBatch.from_pydict({"pattern": ["", *names], "clean": pa.array([total[0], *(seen[0][p] for p in names)], pa.int64()),
                                          "toxic": pa.array([total[1], *(seen[1][p] for p in names)], pa.int64())})

    found = (rows.mapInArrow(count, "pattern string, clean bigint, toxic bigint").groupBy("pattern").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
             .filter(f"pattern = '' or (toxic >= {min_docs} and toxic > {least} * clean)").collect())
    counts = {r["pattern"]: (r["clean"], r["toxic"]) for r in found}
    n_clean, n_toxic = counts.pop("", (0, 0))
    if not n_clean or not n_toxic:
        return Lexicon({}, exceptions, (math.log((n_toxic + 0.5) / (n_clean + 0.5)), 0.0, 0.0))
    weights = {}
    for p, (clean, toxic) in counts.items():
        bound = _lower_bound(toxic, clean + toxic)
        if toxic >= max(min_docs, 0.01 * n_toxic) and bound >= max(least, 2 * n_toxic / (n_clean + n_toxic)):
            weights[p] = math.log(bound / (1 - bound)) - math.log(n_toxic / n_clean)
    # A word or longer beginning adds nothing to a shorter beginning that weighs as much.
    kept = {p: w for p, w in weights.items() if not any(weights.get(p[:k] + "*", -1e9) >= w - 0.1 for k in PREFIXES if len(p.rstrip("*")) > k)}
    if len(kept) > max_patterns:
        raise ValueError(f"{len(kept)} patterns learned, max_patterns is {max_patterns}: raise it or min_docs")
    lexicon = Lexicon(kept, exceptions)

    def features(batches):
        for b in batches:
            x = [lexicon.features(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"a": [v[0] for v in x], "b": [v[1] for v in x], "label": b.column("label")})

    sample = rows.mapInArrow(features, "a double, b double, label int").toPandas()
    lexicon._automaton = None
    lexicon.curve = _curve(sample[["a", "b"]].to_numpy(float), (sample["label"].to_numpy() != 0).astype(float))
    return lexicon


def toxicity(df: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """Per row: the id column, score (0 to 1), n_matches, predicted (1 if ``score >= threshold``).

    Whole texts are scored. Null, empty and blank texts hold no match and get the score of a text
    without one. Repeated rows are scored each; null ids stay; other columns are not read; no rows
    in, no rows out. One pass, no shuffle; the lexicon (at most ``max_patterns`` entries) goes with the task.
    """
    id_type = df.schema[id_col].dataType.simpleString()
    lexicon._automaton = None

    def make():
        own = Lexicon(lexicon.weights, lexicon.exceptions, lexicon.curve)

        def step(batch: pa.RecordBatch) -> dict:
            x = [own.features(t or "") for t in batch.column("text").to_pylist()]
            return {"id": batch.column("id"), "score": [own.score(v) for v in x], "n_matches": pa.array([v[2] for v in x], pa.int64())}
        return step

    rows = keep_columns(df, {id_col: "id", text_col: "text"})
    out = arrow_map(rows, make, f"id {id_type}, score double, n_matches bigint")
    return out.select(F.col("id").alias(id_col), "score", "n_matches", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(df: DataFrame, lexicon: Lexicon, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows, with all their columns, whose text scores below ``threshold``. Null and blank texts hold no match."""
    lexicon._automaton = None

    def make():
        own = Lexicon(lexicon.weights, lexicon.exceptions, lexicon.curve)
        return lambda texts: [own.score(own.features(t or "")) < threshold for t in texts.to_pylist()]
    return filter_rows(df, make, text_col)


def labelled_documents(docs: DataFrame, labels: DataFrame, usable: Column, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
                       max_rows: int = 12_000) -> DataFrame:
    """Texts of labelled rows for ``learn_lexicon``: a bounded hash sample of the labels picks the ids first, so
    only they meet the texts. ``usable`` is a condition on the id column ``id``."""
    ids = keep_columns(labels, {id_col: "id", label_col: "label"}).filter("label is not null").filter(usable)
    ids = rate_sample(ids, "id", max_rows, ids.count())
    ids = F.broadcast(ids.select(F.col("id").alias("label_id"), "label"))  # about max_rows ids at most
    return keep_columns(docs, {id_col: "id", text_col: "text"}).join(ids, F.col("id") == F.col("label_id")).select(
        F.col("id").alias(id_col), F.col("text").alias(text_col), F.col("label").alias(label_col))
