"""Word-at-a-time ids of a ``tokenizers`` file whose pre-tokenizer never crosses white space.

ASCII white space is a safe boundary there: the normaliser turns every run of it into one blank,
the splitting pattern drops blanks, and no added token holds one, so the ids of a text are the
ids of its white-space separated words in order. Each worker keeps a bounded table of words it
has already encoded and encodes the others in batches:

* words of Latin letters, with or without one closing sign, by byte-pair ranks in ``tiktoken``
  (same merges, about ten times faster; used only for files of that one layout, see ``_ranks``);
* all other words by the library itself.

The tests hold the ids of whole texts against the library.
"""

from __future__ import annotations

import json
import os

import numpy as np

#: Words kept per worker process, and the longest word kept, in characters.
KEPT_WORDS, KEPT_CHARS = 300_000, 40
#: Letters whose lower case and NFC form are one letter each, and signs that may close a word of them.
LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyzÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ")
CLOSING = frozenset(".,;:!?")
#: The layout in which letters and punctuation of a word are encoded apart.
LETTERS_APART = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "\x01"
_of_process: dict = {}


def split_words(text: str) -> list[str]:
    """Words between ASCII white space; empty strings stand between two blanks."""
    for ch in "\t\n\r\x0b\x0c":
        if ch in text:
            text = text.replace(ch, " ")
    return text.split(" ")


def safe_pieces(text: str, limit: int) -> list[str]:
    """The text cut at blanks into pieces of about ``limit`` characters; a longer word stays whole."""
    out, a = [], 0
    while len(text) - a > limit:
        b = text.rfind(" ", a, a + limit)
        if b <= a:
            b = text.find(" ", a + limit)
        if b < 0:
            break
        out.append(text[a:b])
        a = b
    out.append(text[a:])
    return out


def _byte_of_char() -> dict[str, int]:
    """The byte behind each printable stand-in of byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(other)}


def _ranks(spec: dict):
    """(encoding, id by rank, whether a rank ends a word) for word-end BPE, else None.

    The word end is one more byte: joining it to the last byte has the lowest ranks, as the
    vocabulary has a word-end form of every byte; the file's merges follow in their order.
    """
    model, split = spec["model"], (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
    if model.get("type") != "BPE" or model.get("end_of_word_suffix") != "</w>" or split.get("pattern") != {"Regex": LETTERS_APART}:
        return None
    import tiktoken
    byte = _byte_of_char()

    def raw(piece: str) -> bytes:
        body, end = (piece[:-4], END.encode()) if piece.endswith("</w>") else (piece, b"")
        return bytes(byte[ch] for ch in body) + end

    ranks = {bytes([b]): b for b in range(256)} | {bytes([b]) + END.encode(): 256 + b for b in range(256)}
    for n, pair in enumerate(model["merges"]):
        ranks.setdefault(raw("".join(pair.split(" ") if isinstance(pair, str) else pair)), 512 + n)
    special = {t["content"] for t in spec["added_tokens"]}
    ids = {raw(p): i for p, i in model["vocab"].items() if p not in special}
    by_rank, ends = np.full(max(ranks.values()) + 1, -1, np.int64), np.zeros(max(ranks.values()) + 1, bool)
    for piece, rank in ranks.items():
        by_rank[rank], ends[rank] = ids.get(piece, -1), piece.endswith(END.encode())
    return tiktoken.Encoding("ranks", pat_str=f"[^{END}]*{END}", mergeable_ranks=ranks, special_tokens={}), by_rank, ends


class WordTable:
    """``values(words)`` with a bounded table of words already done; ``_encode`` does the others in batches."""

    def __init__(self):
        self.known: dict = {}
        self.kept = KEPT_WORDS

    def _encode(self, words: list[str]) -> dict:
        raise NotImplementedError

    def values(self, words: list[str]) -> list:
        got = list(map(self.known.get, words))
        if None not in got:
            return got
        at = [i for i, v in enumerate(got) if v is None]
        new = list({words[i] for i in at})
        extra: dict = {}
        for k in range(0, len(new), 50_000):
            extra.update(self._encode(new[k:k + 50_000]))
        if len(self.known) < self.kept:
            self.known.update((w, v) for w, v in extra.items() if len(w) <= KEPT_CHARS)
        for i in at:
            got[i] = extra[words[i]]
        return got


class WordTokens(WordTable):
    """``values(words)`` gives per word its ids as little-endian bytes (``kind='ids'``) or their number."""

    def __init__(self, path: str, kind: str = "ids", dtype: str = "<u4", kept: int = KEPT_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.ranks = _ranks(json.load(f))
        self.kind, self.dtype, self.kept = kind, dtype, kept
        self.known = {"": b"" if kind == "ids" else 0}

    @classmethod
    def of(cls, path: str, kind: str = "ids", dtype: str = "<u4", kept: int = KEPT_WORDS) -> "WordTokens":
        key = (path, kind, dtype)
        if key not in _of_process:
            _of_process[key] = cls(path, kind, dtype, kept)
        return _of_process[key]

    def _by_library(self, words: list[str]) -> dict:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        if self.kind == "ids":
            return {w: np.asarray(e.ids, self.dtype).tobytes() for w, e in zip(words, found)}
        return {w: len(e) for w, e in zip(words, found)}

    def _encode(self, words: list[str]) -> dict:
        if not self.ranks:
            return self._by_library(words)
        simple, parts, count, other = [], [], [], []
        for w in words:
            if w.isalpha():
                parts.append(w)
                count.append(1)
            elif w[-1] in CLOSING and w[:-1].isalpha():
                parts += w[:-1], w[-1]
                count.append(2)
            else:
                other.append(w)
                continue
            simple.append(w)
        if not LETTERS.issuperset(set("".join(simple)) - CLOSING):  # other scripts are for the library
            plain = [w for w in simple if LETTERS.issuperset(w[:-1] if w[-1] in CLOSING else w)]
            return (self._encode(plain) if plain else {}) | self._by_library(list(set(words).difference(plain)))
        if not simple:
            return self._by_library(other)
        encoding, by_rank, ends = self.ranks
        found = np.asarray(encoding.encode_ordinary(END.join(parts).lower() + END))
        ids, stop = by_rank[found], np.flatnonzero(ends[found]) + 1
        if len(stop) != len(parts) or ids.min() < 0:  # not this layout after all
            return self._by_library(words)
        stop = stop[np.cumsum(count) - 1]
        if self.kind == "ids":
            data, at = ids.astype(self.dtype).tobytes(), (stop * np.dtype(self.dtype).itemsize).tolist()
            out = {w: data[a:b] for w, a, b in zip(simple, [0, *at], at)}
        else:
            out = dict(zip(simple, np.diff(stop, prepend=0).tolist()))
        return out | self._by_library(other) if other else out
