"""Conversation repair against a search over all edits, on whole tables and on conversations cut at every place."""

import hashlib
import heapq
import random
import re
import zlib

import pyarrow.parquet as pq
import pytest

from mixprep.llm import turn_costs as costs
from mixprep.llm.conversation_repair import as_they_are, repair, repair_damaged
from mixprep.llm.queries import QUERIES

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def search(turns):
    """(cost, audit, lines) by uniform-cost search in the order (cost, audit); turns are (role, text, must go, truncated)."""
    heap, seen = [(0, "", 0, 0, ())], set()
    while heap:
        c, audit, i, s, lines = heapq.heappop(heap)
        if (i, s) in seen:
            continue
        seen.add((i, s))
        if i == len(turns) and s in (0, 3):
            return c, audit, list(lines)
        need, to = ("user", 2) if s != 2 else ("assistant", 3)
        heapq.heappush(heap, (c + 5, audit + "I", i, to, (*lines, need + ":")))
        if i < len(turns):
            role, text, must_go, truncated = turns[i]
            heapq.heappush(heap, (c + 2, audit + "D", i + 1, s, lines))
            if not must_go:
                c += 5 * truncated
                if role[:1] == "s" and s == 0:
                    heapq.heappush(heap, (c, audit + "K", i + 1, 1, (*lines, f"{role}:{text}")))
                if role[:1] == need[0]:
                    heapq.heappush(heap, (c, audit + "K", i + 1, to, (*lines, f"{role}:{text}")))
                heapq.heappush(heap, (c + 1, audit + "R", i + 1, to, (*lines, f"{need}:{text}")))


def brute(rows, damage=True):
    """conv_id -> the row of the result, as text."""
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        written = [" " if x is None else str(x) for x in (conv, turn)]
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(":".join(written).encode()) % 20 if damage else 19
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        mine += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    for conv, mine in out.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, turns, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in mine:
            solid = re.sub("[\x20\x09-\x0D]", "", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            turns.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        numbers = [t for t, _, _ in mine if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, lines = search(turns)
        out[conv] = (conv, gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return sorted(map(str, out.values()))


def result(df):
    assert df.columns == COLUMNS
    return sorted(str(tuple(r)) for r in df.collect())


def test_programme_by_search():
    rng = random.Random(1)
    for _ in range(5000):
        turns = [(rng.choice("suaxu"), "", rng.random() < 0.25, rng.random() < 0.3) for _ in range(rng.randrange(9))]
        rle = costs.runs([costs.symbol(r, g, t) for r, _, g, t in turns])
        letters, state = costs.unroll(rle, costs.ending())[0]
        assert (costs.run_cost(rle), "".join(letters) + costs.closing(state)) == search(turns)[:2]
        assert costs.onto(costs.matrix_of(rle), costs.ending())[0] == costs.run_cost(rle)


def test_long_runs_by_single_turns():
    for sym in range(9):
        v = costs.ending()
        for n in range(1, 200):
            v = costs.onto(costs.power(sym, 0), v)
            assert costs.run_onto(sym, n, costs.ending()) == v == costs.onto(costs.run_matrix(sym, n), costs.ending())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_by_brute_force(spark, sf):
    rows = pq.read_table(f"/root/testdata/{sf}/conversations.parquet", columns=["conv_id", "turn", "role", "text"]).to_pylist()
    assert result(QUERIES["op13_conversation_repair"](spark, f"/root/testdata/{sf}")) == brute([tuple(r.values()) for r in rows])


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "conv_id bigint, turn bigint, role string, text string, times int, h string, conv string")


def invented(seed, convs, turns, words):
    rng = random.Random(seed)
    return [(c, rng.choice([None, *range(turns * 2)]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]), rng.choice(words))
            for c in convs for _ in range(rng.randrange(turns))]


WORDS = ["One.", "Two!", "Three", " \t\n", "", None, "a.b", "four? ", "five. ", "\U0001f642."]


@pytest.mark.parametrize("seed, parts", [(1, 1), (2, 4), (3, 40)])
def test_conversations_cut_anywhere(spark, seed, parts):
    """Long and short conversations over up to forty partitions, with nulls, ties, repeats and foreign roles."""
    rows = invented(seed, [None, *range(12)], 40, WORDS) + [(99, t, ("user", "assistant")[t % 2], f"Text {t}.") for t in range(150)]
    assert result(repair_damaged(frame(spark, rows).repartition(3), parts=parts)) == brute(rows)


def test_undamaged_and_sound_conversations_cost_nothing(spark):
    rows = [(c, t, r, f"{r} {c} {t}.") for c in range(30) for t, r in enumerate(["system", "user", "assistant", "user", "assistant"])]
    got = repair(as_they_are(frame(spark, rows), "conv_id", "turn", "role", "text"), parts=7)
    assert result(got) == brute(rows, damage=False)
    assert {tuple(r)[1:8] for r in got.collect()} == {(0, 0, 0, 0, 0, 0, "KKKKK")}


def test_one_conversation_of_equal_rows(spark):
    rows = [(5, None, "user", "Same."),] * 3000 + [(6, 1, "user", "Same.")]
    got = repair(as_they_are(frame(spark, rows), "conv_id", "turn", "role", "text"), parts=9)
    assert result(got) == brute(rows, damage=False)


def test_all_rows_dropped(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = result(repair_damaged(frame(spark, [(conv, 0, "user", "Hi.")])))
    assert got == [str((conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()))]


def test_long_text_and_string_ids(spark):
    rows = [("a", 0, "user", "word " * 200_000 + "?"), ("a", 1, "assistant", "x" * 300_000), ("a", 2, "user", " " * 100_000)]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    assert result(repair(as_they_are(df, "conv_id", "turn", "role", "text"))) == brute(rows, damage=False)


def test_no_rows(spark):
    assert result(repair_damaged(frame(spark, []))) == []
