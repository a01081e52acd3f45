"""Conversation structure repair (13): faults of every turn, the cheapest repair by a run-length dynamic programme (``turn_costs``), and its audit.

Turns are dealt by range of (conversation, turn, role, digest of the text, input row) and sorted, so a conversation with a third of all turns is many
partitions. A task reads its partition in order and finishes every conversation that lies inside it, holding one at a time. The first and
the last conversation of a partition may go on next door: their turns are handed on as they are, and these conversations, at most two a
partition, are put together from stretches (the part of a conversation in one partition):

1. duplicates: of the digests of a stretch only the first row counts, and of those only the ones that an earlier stretch has;
2. a stretch becomes the min-plus matrix of its runs, which are multiplied from the back to give every stretch the costs behind it;
3. each stretch is unrolled from all four states, the states are followed from the front, and so each stretch gets its edits;
4. the repaired lines go in order through one digest per conversation: SHA-256 has no other order, so they stream through a task, held a batch at a time.

Other than that stream, no task holds more than a partition. The result is the one of a conversation read at once, wherever it was cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mixprep.llm import turn_costs as costs
from mixprep.llm.common import ship, stage

#: Turns of a partition, about.
PART_ROWS = 50_000
BLANK = "[^\\x20\\x09-\\x0D]"
STATS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def damaged(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, role, text, times): the rows after the test damage by crc32 of ``conv:turn`` mod 20; ``times`` says how often a row is there.

    A null in the crc's text, a role or a text is one space. Dropped rows stay with ``times`` 0, so their conversation is not lost.
    """
    space = F.lit(" ")
    written = [F.coalesce(F.col(f"`{c}`").cast("string"), space) for c in (conv_col, turn_col)]
    k = F.crc32(F.concat(written[0], F.lit(":"), written[1])) % 20
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), space)
    text = F.when(k <= 1, F.lit("")).when(k == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(k == 4, F.lit("user")).otherwise(F.coalesce(F.col(f"`{role_col}`").cast("string"), space))
    return df.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"),
                     F.when(k == 0, 0).when(k == 3, 2).otherwise(1).alias("times"))


def as_they_are(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, role, text, times) without any damage; a null role or text is one space."""
    value = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    return df.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("bigint").alias("turn"), value(role_col).alias("role"), value(text_col).alias("text"), F.lit(1).alias("times"))


def _flags() -> list[Column]:
    """blank, and truncated where not blank."""
    last = F.substring(F.regexp_replace("text", "[\\x20\\x09-\\x0D]+$", ""), -1, 1)
    return [(~F.col("text").rlike(BLANK)).alias("blank"), (~last.isin(".", "!", "?")).alias("truncated")]


class Tally:
    """Counts over turns in order; ``duplicate`` is told per turn."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.rows = self.distinct = 0
        self.low = self.high = self.last_turn = self.first = self.last = None
        self.symbols: list[int] = []

    def add(self, turn, initial: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        duplicate, truncated = duplicate and not blank, truncated and not blank and not duplicate
        self.blank, self.duplicate, self.truncated, self.rows = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated, self.rows + 1
        if self.rows == 1:
            self.first = initial
        else:
            self.illegal += (self.last, initial) not in LEGAL
        self.last = initial
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.distinct += turn != self.high
            self.high = turn
        self.symbols.append(costs.symbol(initial, blank or duplicate, truncated))

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.distinct


def _whole(conv, rows: list[tuple]) -> tuple:
    """The result of a conversation from its turns (turn, role, text, times, blank, truncated) in order."""
    tally, seen, roles, texts = Tally(), set(), [], []
    for turn, role, text, many, blank, truncated in rows:
        for _ in range(many):
            key = (role, text)
            tally.add(turn, role[:1], blank, key in seen, truncated)
            seen.add(key)
            roles.append(role)
            texts.append(text)
    rle = costs.runs(tally.symbols)
    letters, state = costs.unroll(rle, costs.ending())[0]
    tail = costs.closing(state)
    out, _ = costs.lines([*letters, tail], [*roles, ""], [*texts, ""])
    return (conv, tally.gaps(), tally.blank, tally.duplicate, tally.truncated, tally.illegal, costs.run_cost(rle), "".join(letters) + tail,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


RAW = ("turn", "role", "text", "times", "blank", "truncated")


def _finish(conv_type: pa.DataType):
    """Results of the conversations inside a partition, and the rows of its first and last one."""
    schema = pa.schema([("conv", conv_type), *[(c, pa.int64()) for c in STATS], ("audit", pa.string()), ("repaired_sha256", pa.string()), ("part", pa.int64()), ("seq", pa.int64()),
                        ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("times", pa.int32()), ("blank_turn", pa.bool_()), ("cut_turn", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq, began, first, now, held = TaskContext.get().partitionId(), 0, False, True, None, []

        def batch(done: list[tuple], raw: list[tuple]) -> pa.RecordBatch:
            none = [None] * len(done)
            columns = [[d[0] for d in done] + [r[0] for r in raw]]
            columns += [[d[i] for d in done] + [None] * len(raw) for i in range(1, 9)]
            columns += [none + [r[i] for r in raw] for i in range(1, 9)]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for b in batches:
            done, raw = [], []
            for conv, *row in zip(*(b.column(c).to_pylist() for c in ("conv", *RAW))):
                if began and conv != now:
                    if not first:
                        done.append(_whole(now, held))
                    first, held = False, []
                began, now = True, conv
                if first:
                    raw.append((conv, part, seq, *row))         # may have begun in an earlier partition: not held
                    seq += 1
                else:
                    held.append(tuple(row))
            if done or raw:
                yield batch(done, raw)
        for a in range(0, len(held), 1024):
            yield batch([], [(now, part, a + k, *row) for k, row in enumerate(held[a:a + 1024])])
    return run, schema


def _stretch(key, rows: pd.DataFrame, late: pd.DataFrame) -> pd.DataFrame:
    """A stretch: its counts and borders, its runs and its matrix."""
    if not len(rows):
        return pd.DataFrame()
    rows = rows.sort_values("seq")
    seen, tally = set(late["digest"]), Tally()
    for turn, initial, many, blank, truncated, digest in zip(rows["turn"], rows["initial"], rows["times"], rows["blank_turn"], rows["cut_turn"], rows["digest"]):
        for _ in range(many):
            tally.add(None if pd.isna(turn) else int(turn), initial, blank, digest in seen, truncated)
            seen.add(digest)
    rle = costs.runs(tally.symbols)
    return pd.DataFrame([{"ck": key[0], "part": key[1], "rows": tally.rows, "blank": tally.blank, "duplicate": tally.duplicate, "truncated": tally.truncated, "illegal": tally.illegal,
                          "distinct": tally.distinct, "low": tally.low, "high": tally.high, "first": tally.first, "last": tally.last,
                          "runs": [x for r in rle for x in r], "matrix": [x for r in costs.matrix_of(rle) for x in r]}], dtype=object)


STRETCH = ("ck string, part bigint, rows bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, distinct bigint, low bigint, high bigint, "
           "first string, last string, runs array<bigint>, matrix array<bigint>")


def _backwards(key, rows: pd.DataFrame) -> pd.DataFrame:
    """Costs behind every stretch of a conversation and, in its first row, the counts of the whole."""
    rows = rows.sort_values("part")
    v, behind = costs.ending(), []
    for m in reversed(rows["matrix"].tolist()):
        behind.append(list(v))
        v = costs.onto([[int(x) for x in m[i:i + 4]] for i in range(0, 16, 4)], v)
    out = pd.DataFrame({"ck": [key[0]] * len(rows), "part": rows["part"].tolist(), "behind": behind[::-1]}, dtype=object)
    full = rows[rows["rows"] > 0]
    illegal = int(full["illegal"].sum()) + sum((a, b) not in LEGAL for a, b in zip(full["last"], full["first"].iloc[1:]))
    timed = full[full["low"].notna()]
    gaps = 0
    if len(timed):
        distinct = int(timed["distinct"].sum()) - sum(a == b for a, b in zip(timed["high"], timed["low"].iloc[1:]))      # a turn on both sides of a border
        gaps = int(timed["high"].iloc[-1]) - int(timed["low"].iloc[0]) + 1 - distinct
    whole = {"gaps": gaps, "blank": int(rows["blank"].sum()), "duplicate": int(rows["duplicate"].sum()), "truncated": int(rows["truncated"].sum()), "illegal": illegal, "cost": int(v[0])}
    for name, value in whole.items():
        out[name] = pd.Series([value] + [None] * (len(out) - 1), dtype=object)
    out["last_part"] = [False] * (len(out) - 1) + [True]
    return out


def _unrolled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edits of a stretch, turn after turn, from each of the four states, and the states they lead to."""
    for rows in batches:
        edits, after = [], []
        for flat, behind in zip(rows["runs"], rows["behind"]):
            flat = [int(x) for x in flat]
            made = costs.unroll(list(zip(flat[::2], flat[1::2])), tuple(int(x) for x in behind), range(4))
            edits.append(["|".join(letters) for letters, _ in made])
            after.append([s for _, s in made])
        yield pd.DataFrame({"ck": rows["ck"].tolist(), "part": rows["part"].tolist(), "last_part": rows["last_part"].tolist(), "edits": edits, "after": after}, dtype=object)


def _forwards(key, rows: pd.DataFrame) -> pd.DataFrame:
    """The state in which every stretch begins."""
    rows, state, begins = rows.sort_values("part"), costs.NOTHING, []
    for after in rows["after"]:
        begins.append(state)
        state = int(after[state])
    return pd.DataFrame({"ck": [key[0]] * len(rows), "part": rows["part"].tolist(), "begin": begins, "close": [""] * (len(begins) - 1) + [costs.closing(state)]}, dtype=object)


def _repaired(key, rows: pd.DataFrame, edits: pd.DataFrame) -> pd.DataFrame:
    """The repaired lines of a stretch, in order."""
    rows = rows.sort_values("seq")
    roles = [r for r, n in zip(rows["role"], rows["times"]) for _ in range(n)]
    texts = [t for t, n in zip(rows["text"], rows["times"]) for _ in range(n)]
    e = edits.iloc[0]
    letters = (e["edits"].split("|") if roles else []) + [e["close"]]
    out, _ = costs.lines(letters, [*roles, ""], [*texts, ""], int(e["begin"]))
    return pd.DataFrame({"ck": [key[0]] * len(out), "part": [key[1]] * len(out), "seq": list(range(len(out))), "line": out}, dtype=object)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, which come in order."""
    now, digest = None, None
    for b in batches:
        out = []
        for ck, line in zip(b.column("ck").to_pylist(), b.column("line").to_pylist()):
            if ck != now:
                if digest:
                    out.append((now, digest.hexdigest()))
                now, digest = ck, hashlib.sha256(line.encode())
            else:
                digest.update(b"\n" + line.encode())
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.string()) for i in (0, 1)], names=["ck", "repaired_sha256"])
    if digest:
        yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([digest.hexdigest()])], names=["ck", "repaired_sha256"])


def _joined(rows: DataFrame) -> DataFrame:
    """Results of the conversations that were handed on, from their rows."""
    ck = F.when(F.col("conv").isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col("conv").cast("string")))
    rows = rows.withColumn("ck", ck)
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    thin = stage(rows.select("ck", "conv", "part", "seq", "turn", F.substring("role", 1, 1).alias("initial"), "times", "blank_turn", "cut_turn", digest.alias("digest")), "turns")
    firsts = thin.filter("times > 0 and not blank_turn").groupBy("ck", "digest", "part").agg(F.lit(1).alias("one"))
    earliest = firsts.groupBy("ck", "digest").agg(F.min("part").alias("least"), F.count(F.lit(1)).alias("parts")).filter("parts > 1").drop("parts")
    late = stage(firsts.join(earliest, ["ck", "digest"]).filter("part > least").select("ck", "part", "digest"), "late")
    turns = thin.select("ck", "part", "seq", "turn", "initial", "times", "blank_turn", "cut_turn", "digest")
    stretches = stage(turns.groupBy("ck", "part").cogroup(late.groupBy("ck", "part")).applyInPandas(_stretch, STRETCH), "stretches")
    stats = ", ".join(f"{c} bigint" for c in STATS)
    behind = stage(stretches.drop("runs").groupBy("ck").applyInPandas(_backwards, f"ck string, part bigint, behind array<bigint>, {stats}, last_part boolean"), "behind")
    ways = stretches.select("ck", "part", "runs").join(behind.select("ck", "part", "behind", "last_part"), ["ck", "part"])
    ways = stage(ways.mapInPandas(_unrolled, "ck string, part bigint, last_part boolean, edits array<string>, after array<int>"), "edits")
    begins = stage(ways.select("ck", "part", "after").groupBy("ck").applyInPandas(_forwards, "ck string, part bigint, begin int, close string"), "begins")
    chosen = stage(ways.join(begins, ["ck", "part"]).select("ck", "part", F.element_at("edits", F.col("begin") + 1).alias("edits"), "begin", "close"), "chosen")
    lines = rows.select("ck", "part", "seq", "role", "text", "times").groupBy("ck", "part").cogroup(chosen.groupBy("ck", "part")).applyInPandas(
        _repaired, "ck string, part bigint, seq bigint, line string")
    digests = lines.repartition("ck").sortWithinPartitions("ck", "part", "seq").select("ck", "line").mapInArrow(_digests, "ck string, repaired_sha256 string")
    piece = F.struct("part", F.concat(F.replace("edits", F.lit("|"), F.lit("")), F.col("close")).alias("letters"))
    audits = chosen.groupBy("ck").agg(F.array_join(F.transform(F.sort_array(F.collect_list(piece)), lambda p: p["letters"]), "").alias("audit"))
    names = thin.groupBy("ck").agg(F.first("conv").alias("conv"))
    out = behind.filter("cost is not null").select("ck", *STATS).join(names, "ck").join(audits, "ck").join(digests, "ck", "left")
    return out.select("conv", *STATS, "audit", F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))


def repair(turns: DataFrame, conv_col: str = "conv_id", part_rows: int = PART_ROWS, parts: int | None = None) -> DataFrame:
    """One row per conversation: its id column, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``turns`` has (conv, turn, role, text, times) as ``damaged`` or ``as_they_are`` make them. Turns are taken by number, nulls first; rows of one number
    by role, then by the digest of their text. A null id is a conversation of its own. A conversation all of whose rows have ``times`` 0 has zeros, an empty audit and
    the digest of nothing. An empty text is blank. No rows in, no rows out.
    """
    spark = turns.sparkSession
    ship(spark)
    kind = turns.schema["conv"].dataType
    n = turns.count()
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // part_rows))
    keyed = turns.select("*", *_flags(), F.md5("text").alias("h"), F.monotonically_increasing_id().alias("row"))
    order = ["conv", "turn", "role", "h", "row"]
    placed = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("conv", *RAW)
    run, _ = _finish(pa.int64() if kind.simpleString() in ("bigint", "int") else pa.string())
    if kind.simpleString() not in ("bigint", "int", "string"):
        raise TypeError(f"conversation ids must be whole numbers or strings, not {kind.simpleString()}")
    name = "string" if kind.simpleString() == "string" else "bigint"
    made = stage(placed.withColumn("conv", F.col("conv").cast(name)).mapInArrow(
        run, f"conv {name}, " + ", ".join(f"{c} bigint" for c in STATS) + ", audit string, repaired_sha256 string, part bigint, seq bigint, turn bigint, role string, text string, "
             "times int, blank_turn boolean, cut_turn boolean"), "conversations")
    inside = made.filter("part is null").select("conv", *STATS, "audit", "repaired_sha256")
    handed = made.filter("part is not null").select("conv", "part", "seq", "turn", "role", "text", "times", "blank_turn", "cut_turn")
    return inside.unionByName(_joined(handed)).withColumn("conv", F.col("conv").cast(kind)).withColumnRenamed("conv", conv_col)


def repair_damaged(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", **options) -> DataFrame:
    """``repair`` of the table after the test damage (``damaged``). Other columns are not read."""
    return repair(damaged(df, conv_col, turn_col, role_col, text_col), conv_col, **options)
