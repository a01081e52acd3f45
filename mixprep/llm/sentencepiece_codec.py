"""SentencePiece encoding and decoding (2): batched merging (BPE models) or Viterbi (unigram models) in numpy.

A text with its blanks escaped falls into units: a run of blanks and the word behind it. Pieces hold blanks only at their
beginning, so the segmentation of a text is that of its units, one by one. A character that no piece holds becomes
its UTF-8 bytes.

BPE (``MergedPieces``): the two neighbours whose joint piece scores best merge first, the leftmost of equals, until none
do. Units are cut between characters that stand together in no piece; cuts of equal length advance together, one
merge each a round.
Unigram (``Pieces``): the segmentation with the highest sum of piece scores; ties go to the longest last piece. Units of
equal length advance together: at every end position the hashes of all substrings that end there probe the sorted keys
of the pieces, and vectorised maxima keep score and backpointer.
"""

from __future__ import annotations

import heapq
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mixprep.llm.common import arrow_map, byte_batches, keep_columns
from mixprep.llm.word_tokens import WordTable

BLANK = "▁"
#: What a character without a piece costs more than the worst piece.
UNKNOWN_PENALTY = 10.0
BATCH_BYTES = 2 << 20
#: Units of which a worker keeps both segmentations.
KEPT_PAIRS = 300_000
#: Characters that merge in one numpy batch, and the length from which a cut merges by a heap, alone.
MERGE_CHARS, LONG_CUT = 200_000, 64
#: Units of equal length advance together as long as they have this many substrings.
VITERBI_CELLS = 400_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bits of a hash that the table of possible keys leaves out, and those that the table of first keys leaves out.
_MAYBE, _NEAR = np.uint64(44), np.uint64(46)
#: Spreads hashes of short pieces over all upper bits (odd, so no two hashes meet).
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_UNIT = re.compile(" +[^ ]*")
_of_process: dict = {}


class Pieces(WordTable):
    """The pieces of a model file; ``values(units)`` gives the ids of units, by Viterbi, as little-endian 32-bit bytes.

    A unit is named without its first blank: ``"word"`` for one blank and a word.
    """

    def __init__(self, path: str):
        super().__init__()
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        self.byte_id = {int(names[i][1:-1], 16): i for i in range(n) if model.is_byte(i)}
        self.unknown = model.unk_id()
        # What an ASCII character that no piece holds becomes: one byte's piece.
        self.ascii = np.array([self.byte_id[k] if len(self.byte_id) == 256 else self.unknown for k in range(128)])
        normal = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        if any(BLANK in names[i].lstrip(BLANK) for i in normal):
            raise ValueError("a piece holds a blank behind a letter: units would not be independent")
        self.longest = max(len(names[i]) for i in normal)
        self.power = np.array([pow(int(_BASE), k, 1 << 64) for k in range(self.longest + 1)], np.uint64)
        keys = np.array([self._hash(names[i]) for i in normal], np.uint64) * _SPREAD
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(normal)[order]
        self.lengths = np.array([len(names[i]) for i in normal])[order]
        self.scores = np.array([model.get_score(i) for i in normal], np.float64)[order]
        if len(np.unique(self.keys)) != len(keys):
            raise ValueError("two pieces share a hash")
        self.maybe = np.zeros(1 << 64 - int(_MAYBE), bool)   # most substrings are no piece: their keys need no search
        self.maybe[self.keys >> _MAYBE] = True
        # The sorted keys from the first with a hash's upper bits on; the last one stands behind all hashes.
        self.first = np.searchsorted(self.keys, np.arange(1 << 64 - int(_NEAR), dtype=np.uint64) << _NEAR).astype(np.int32)
        self.deepest = int(np.bincount((self.keys >> _NEAR).astype(np.int64)).max())
        self.keys, self.lengths = np.append(self.keys, np.uint64(2 ** 64 - 1)), np.append(self.lengths, 0)
        self.unknown_score = self.scores.min() - UNKNOWN_PENALTY
        raw = {v: bytes([k]) for k, v in self.byte_id.items()}
        control = {i for i in range(n) if model.is_control(i)}
        self.raw = [raw[i] if i in raw else b"" if i in control else " ⁇ ".encode() if i == self.unknown else names[i].replace(BLANK, " ").encode() for i in range(n)]

    @classmethod
    def of(cls, path: str) -> "Pieces":
        if (cls, path) not in _of_process:
            _of_process[cls, path] = cls(path)
        return _of_process[cls, path]

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for ch in piece:
            h = (h * int(_BASE) + ord(ch) + 1) % (1 << 64)
        return h

    def _probe(self, h: np.ndarray) -> np.ndarray:
        """Places in the sorted keys at which the hashes ``h`` are, if they are keys."""
        at = self.first[h >> _NEAR]
        for _ in range(self.deepest):
            at = at + (self.keys[at] < h)
        return at

    def viterbi(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For units (n x length, code points): ids (n x length, filled from the right, -1 for an unknown character and
        -2 for no piece) and begins of the pieces."""
        n, length = chars.shape
        prefix = np.zeros((length + 1, n), np.uint64)
        for k in range(length):
            prefix[k + 1] = prefix[k] * _BASE + chars[:, k] + np.uint64(1)
        # Per size of a piece: the rows in which one ends, and which, cut by its end.
        hits = []
        for size in range(1, min(length, self.longest) + 1):
            h = (prefix[size:] - prefix[:-size] * self.power[size]) * _SPREAD
            at, row = np.nonzero(self.maybe[h >> _MAYBE])
            h = h[at, row]
            found = self._probe(h)
            hit = np.flatnonzero((self.keys[found] == h) & (self.lengths[found] == size))
            row, found = row[hit], found[hit]
            hits.append((size, np.searchsorted(at[hit] + size, np.arange(length + 2)).tolist(), row, self.scores[found], self.ids[found]))
        best, back, piece = np.zeros((length + 1, n)), np.zeros((length + 1, n), np.int64), np.full((length + 1, n), -1, np.int64)
        for end in range(1, length + 1):
            # A character alone, first as an unknown one; then ever longer pieces, which win ties.
            here, best_back, best_piece = best[end], back[end], piece[end]
            here[:], best_back[:] = -np.inf, end - 1
            for size, cut, row, score, ids in hits:
                own = slice(cut[end], cut[end + 1])
                r = row[own]
                if len(r):
                    total = best[end - size, r] + score[own]
                    wins = total >= here[r]
                    r = r[wins]
                    here[r], best_back[r], best_piece[r] = total[wins], end - size, ids[own][wins]
                if size == 1:
                    alone = np.flatnonzero(best_piece < 0)
                    here[alone] = best[end - 1, alone] + self.unknown_score
        back, piece = back.T, piece.T
        ids, begin = np.full((n, length), -2, np.int64), np.zeros((n, length), np.int64)
        end, column = np.full(n, length), length - 1
        rows = np.arange(n)
        while len(rows):
            ids[rows, column], begin[rows, column] = piece[rows, end[rows]], back[rows, end[rows]]
            end[rows] = back[rows, end[rows]]
            rows, column = rows[end[rows] > 0], column - 1
        return ids, begin

    def _encode(self, units: list[str]) -> dict:
        out = {}
        by_length: dict[int, list[str]] = {}
        for u in units:
            by_length.setdefault(len(u) + 1, []).append(u)
        for length, same in by_length.items():
            step = max(1, VITERBI_CELLS // (length * min(length, self.longest)))
            for k in range(0, len(same), step):
                part = same[k:k + step]
                text = "".join([BLANK + u.replace(" ", BLANK) for u in part])
                chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(part), length)
                ids, begin = self.viterbi(chars.astype(np.uint64))
                at, k = np.nonzero(ids == -1)
                ch = chars[at, begin[at, k]]
                ids[at[ch < 128], k[ch < 128]] = self.ascii[ch[ch < 128]]
                odd = (ids == -1).any(axis=1)
                count = (ids != -2).sum(axis=1)
                data = ids.astype("<u4").tobytes()
                for i, (u, c, strange) in enumerate(zip(part, count.tolist(), odd.tolist())):
                    if strange:
                        out[u] = self._with_bytes(u, ids[i, length - c:], begin[i, length - c:])
                    else:
                        out[u] = data[4 * ((i + 1) * length - c):4 * (i + 1) * length]
        return out

    def _with_bytes(self, unit: str, ids: np.ndarray, begin: np.ndarray) -> bytes:
        found: list[int] = []
        chars = " " + unit
        for i, b in zip(ids.tolist(), begin.tolist()):
            if i >= 0:
                found.append(i)
            else:
                raw = chars[b].encode("utf-8", "surrogatepass")
                found += [self.byte_id[x] for x in raw] if len(self.byte_id) == 256 else [self.unknown]
        return np.array(found, "<u4").tobytes()

    @staticmethod
    def units(text: str) -> list[str]:
        """Units of a text behind the blank that is put before every text that is not empty."""
        if not text:
            return []
        text = text.replace(BLANK, " ")
        if "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [u[1:] for u in _UNIT.findall(" " + text)]

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters, the first blank goes."""
        raw = b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


class MergedPieces(Pieces):
    """The pieces of a BPE model; ``values(units)`` gives the library's ids."""

    def __init__(self, path: str):
        super().__init__(path)
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in self.ids.tolist()]
        if any(model.is_unused(i) for i in range(model.get_piece_size())) or any(kind == _USER_DEFINED for kind in _spec(path)[1]):
            raise ValueError("unused and user-defined pieces of BPE models are not merged by score alone")
        self.ranks = np.unique(self.scores, return_inverse=True)[1].astype(np.int32)
        self.rank_of = dict(zip(names, self.ranks.tolist()))
        self.at = {name: k for k, name in enumerate(names)}
        self.together = np.array(sorted({ord(a) << 32 | ord(b) for name in names for a, b in zip(name, name[1:])}), np.uint64)

    def _find(self, h: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        """Places of pieces by hash and length; -1 for no piece."""
        h = h * _SPREAD
        at = self._probe(h)
        return np.where((self.keys[at] == h) & (self.lengths[at] == lengths), at, -1).astype(np.int32)

    def merge(self, chars: np.ndarray, piece: np.ndarray) -> None:
        """For cuts (n x length, code points): ``piece`` (n x length), which has the piece of every character, gets that of
        every merged piece at its begin, and -2 behind it."""
        n, length = chars.shape
        prefix = np.zeros((n, length + 1), np.uint64)
        for k in range(length):
            prefix[:, k + 1] = prefix[:, k] * _BASE + chars[:, k] + np.uint64(1)
        after = np.tile(np.arange(1, length + 2, dtype=np.int32), (n, 1))
        before = np.tile(np.arange(-1, length, dtype=np.int32), (n, 1))
        joint = np.full((n, length), -1, np.int32)       # the piece of a symbol and its right neighbour, and its rank
        joint[:, :-1] = self._find(prefix[:, 2:] - prefix[:, :-2] * self.power[2], 2)
        rank = np.where(joint >= 0, self.ranks[joint], -1)

        def look(rows: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
            size = end - begin
            fits = size <= self.longest
            h = prefix[rows, end] - prefix[rows, begin] * self.power[np.where(fits, size, 0)]
            found = np.where(fits, self._find(h, size), -1)
            joint[rows, begin], rank[rows, begin] = found, np.where(found >= 0, self.ranks[found], -1)

        rows = np.arange(n)
        while True:
            at = rank[rows].argmax(axis=1)
            live = rank[rows, at] >= 0
            rows, at = rows[live], at[live]
            if not len(rows):
                return
            gone = after[rows, at]
            end = after[rows, gone]
            piece[rows, at], piece[rows, gone] = joint[rows, at], -2
            rank[rows, gone], rank[rows, at] = -1, -1
            after[rows, at], before[rows, end] = end, at
            more = end < length
            look(rows[more], at[more], after[rows[more], end[more]])
            more = at > 0
            look(rows[more], before[rows[more], at[more]], end[more])

    def _merge_long(self, text: str, piece: np.ndarray) -> None:
        """``merge`` for one long cut."""
        after, before, heap = list(range(1, len(text) + 2)), list(range(-1, len(text))), []
        alive = [True] * len(text)

        def look(begin: int, end: int) -> None:
            rank = self.rank_of.get(text[begin:end]) if end - begin <= self.longest else None
            if rank is not None:
                heapq.heappush(heap, (-rank, begin, end))

        for b in range(len(text) - 1):
            look(b, b + 2)
        while heap:
            _, b, end = heapq.heappop(heap)
            gone = after[b]
            if not alive[b] or gone >= end or after[gone] != end:
                continue
            piece[b], piece[gone], alive[gone] = self.at[text[b:end]], -2, False
            after[b], before[end] = end, b
            if end < len(text):
                look(b, after[end])
            if b > 0:
                look(before[b], end)

    def _encode(self, units: list[str]) -> dict:
        out: dict = {}
        for a, b in byte_batches([len(u) + 1 for u in units], MERGE_CHARS):
            self._encode_some(units[a:b], out)
        return out

    def _encode_some(self, units: list[str], out: dict) -> None:
        text = "".join([BLANK + u.replace(" ", BLANK) for u in units])
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        stop = np.cumsum([len(u) + 1 for u in units])
        piece = self._find(chars + np.uint64(1), 1)
        pair = chars[:-1] << np.uint64(32) | chars[1:]
        place = np.minimum(np.searchsorted(self.together, pair), len(self.together) - 1)
        cut = np.concatenate(([True], self.together[place] != pair))
        cut[stop[:-1]] = True
        begin = np.flatnonzero(cut)
        size = np.diff(begin, append=len(chars))
        for length in np.unique(size[(size > 1) & (size < LONG_CUT)]).tolist():
            at = begin[size == length][:, None] + np.arange(length)
            found = piece[at]
            self.merge(chars[at], found)
            piece[at] = found
        for k in np.flatnonzero(size >= LONG_CUT).tolist():
            self._merge_long(text[begin[k]:begin[k] + size[k]], piece[begin[k]:begin[k] + size[k]])
        begin = np.flatnonzero(piece != -2)
        ids = np.where(piece[begin] >= 0, self.ids[piece[begin]], -1)
        lone = np.flatnonzero(ids < 0)
        lone = lone[chars[begin[lone]] < 128]
        ids[lone] = self.ascii[chars[begin[lone]].astype(np.int64)]
        last = np.searchsorted(begin, stop)
        odd = np.add.reduceat(ids < 0, np.concatenate(([0], last[:-1]))) > 0
        data = ids.astype("<u4").tobytes()
        a = 0
        for u, b, strange, first in zip(units, last.tolist(), odd.tolist(), (stop - [len(u) + 1 for u in units]).tolist()):
            out[u] = self._with_bytes(u, ids[a:b], begin[a:b] - first) if strange else data[4 * a:4 * b]
            a = b


class TwoWays(WordTable):
    """``values(units)`` gives pairs of a unit's ids: by the kind of the model, and by Viterbi over the scores of its pieces."""

    def __init__(self, path: str):
        super().__init__()
        self.own, self.best = pieces_of(path), Pieces.of(path)
        self.kept = KEPT_PAIRS

    @classmethod
    def of(cls, path: str) -> "TwoWays":
        if (cls, path) not in _of_process:
            _of_process[cls, path] = cls(path)
        return _of_process[cls, path]

    def _encode(self, units: list[str]) -> dict:
        best = self.best._encode(units)
        return {u: (ids, best[u]) for u, ids in self.own._encode(units).items()}


_UNIGRAM, _BPE, _USER_DEFINED = 1, 2, 4


def _spec(path: str) -> tuple[int, list[int]]:
    """The kind of a model file and those of its pieces."""
    from sentencepiece import sentencepiece_model_pb2
    with open(path, "rb") as f:
        model = sentencepiece_model_pb2.ModelProto.FromString(f.read())
    return model.trainer_spec.model_type, [p.type for p in model.pieces]


def pieces_of(path: str) -> Pieces:
    """The codec of a model file, by its kind; once a process."""
    if ("kind", path) not in _of_process:
        _of_process["kind", path] = _spec(path)[0]
    kind = _of_process["kind", path]
    if kind not in (_UNIGRAM, _BPE):
        raise ValueError("neither a unigram nor a BPE model")
    return (MergedPieces if kind == _BPE else Pieces).of(path)


#: What decoding gives, as Spark types: the text, or the crc32 of its UTF-8 bytes.
DECODED = {"text": "string", "text_crc32": "bigint"}


def decoded(pieces: Pieces, ids: list[bytes | None], value: str) -> pa.Array:
    """The texts of ids, or what ``value`` names of them."""
    texts = (pieces.decode(x or b"") for x in ids)
    return pa.array([zlib.crc32(t.encode()) for t in texts], pa.int64()) if value == "text_crc32" else pa.array(list(texts), pa.string())


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: dict[str, str] | None = None, viterbi: bool = False,
           back: str | None = None) -> DataFrame:
    """Per row: the id column, ids (little-endian unsigned 32-bit, as binary), n_pieces, n_byte_pieces (pieces of single
    bytes), and the columns of ``df`` named in ``keep`` (name -> Spark type).

    With ``viterbi`` also viterbi_ids and n_viterbi_pieces: the segmentation of the highest sum of scores, which is ``ids`` for a unigram
    model and what a unigram model of the same pieces and scores would give for a BPE model. Both come from one pass and one table of known units.
    With ``back`` (a name of ``DECODED``) also ``{back}_ids`` and, with ``viterbi``, ``{back}_viterbi_ids``: what ``decode`` gives for these columns, in the same pass,
    so that the ids need not go through a second worker process.

    Null and empty texts have no ids; repeated rows are encoded each; null ids stay; other columns are not read;
    no rows in, no rows out. U+2581 in a text counts as a blank, as in the library. One pass, no shuffle.
    """
    keep = keep or {}
    id_type = df.schema[id_col].dataType.simpleString()

    def make():
        pieces = pieces_of(path)
        table = TwoWays.of(path) if viterbi else pieces
        single = np.zeros(len(pieces.raw), bool)
        single[list(pieces.byte_id.values())] = True

        def step(batch: pa.RecordBatch) -> dict:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            out, best = [], []
            for a, b in byte_batches([len(t) for t in texts], BATCH_BYTES):
                split = [pieces.units(t) for t in texts[a:b]]
                got, at = table.values([u for us in split for u in us]), 0
                for us in split:
                    own = got[at:at + len(us)]
                    if viterbi:
                        best.append(b"".join([y for _, y in own]))
                        own = [x for x, _ in own]
                    out.append(b"".join(own))
                    at += len(us)
            found = {"id": batch.column("id"), "ids": pa.array(out, pa.binary()), "n_pieces": pa.array([len(x) // 4 for x in out], pa.int64()),
                     "n_byte_pieces": pa.array([int(single[np.frombuffer(x, "<u4")].sum()) for x in out], pa.int64())}
            if viterbi:
                found |= {"viterbi_ids": pa.array(best, pa.binary()), "n_viterbi_pieces": pa.array([len(x) // 4 for x in best], pa.int64())}
            if back:
                found |= {f"{back}_{c}": decoded(pieces, x, back) for c, x in (("ids", out), ("viterbi_ids", best)) if c in found}
            return found | {f"kept_{c}": batch.column(f"kept_{c}") for c in keep}
        return step

    rows = keep_columns(df, {id_col: "id", text_col: "text"}) if not keep else df.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), *[F.col(f"`{c}`").alias(f"kept_{c}") for c in keep])
    more = {"viterbi_ids": "binary", "n_viterbi_pieces": "bigint"} if viterbi else {}
    if back:
        more |= {f"{back}_{c}": DECODED[back] for c in ("ids", "viterbi_ids") if c == "ids" or viterbi}
    schema = ", ".join([f"id {id_type}", "ids binary", "n_pieces bigint", "n_byte_pieces bigint", *(f"{c} {t}" for c, t in more.items()),
                        *(f"kept_{c} {t}" for c, t in keep.items())])
    out = arrow_map(rows, make, schema)
    return out.select(F.col("id").alias(id_col), "ids", "n_pieces", "n_byte_pieces", *more, *[F.col(f"kept_{c}").alias(c) for c in keep])


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str | list[str] = "ids", keep: dict[str, str] | None = None, crc: bool = False) -> DataFrame:
    """Per row: the id column, text (with ``crc``: text_crc32 of its UTF-8 bytes instead), and the columns in ``keep``.

    With a list of columns as ``ids_col`` each is decoded, to ``text_<column>`` (``text_crc32_<column>``).
    The inverse of ``encode`` for every text without U+2581. Null ids_col is the empty text; no rows in, no rows out.
    """
    keep = keep or {}
    id_type = df.schema[id_col].dataType.simpleString()
    value = "text_crc32" if crc else "text"
    names = {value: ids_col} if isinstance(ids_col, str) else {f"{value}_{c}": c for c in ids_col}

    def make():
        pieces = pieces_of(path)

        def step(batch: pa.RecordBatch) -> dict:
            found = {"id": batch.column("id")}
            for name in names:
                found[name] = decoded(pieces, batch.column(f"of_{name}").to_pylist(), value)
            return found | {f"kept_{c}": batch.column(f"kept_{c}") for c in keep}
        return step

    rows = df.select(F.col(f"`{id_col}`").alias("id"), *[F.col(f"`{c}`").alias(f"of_{name}") for name, c in names.items()],
                     *[F.col(f"`{c}`").alias(f"kept_{c}") for c in keep])
    out = arrow_map(rows, make, ", ".join([f"id {id_type}", *(f"{name} {DECODED[value]}" for name in names), *(f"kept_{c} {t}" for c, t in keep.items())]))
    return out.select(F.col("id").alias(id_col), *names, *[F.col(f"kept_{c}").alias(c) for c in keep])
