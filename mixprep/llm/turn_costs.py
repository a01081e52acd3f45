"""Cheapest repairs of a row of turns: a run-length dynamic programme over min-plus matrices.

A turn is a symbol of its role's initial and its fault. Four states say what the repaired turns so far end in: nothing (0), the system turn (1), a user turn (2), an
assistant turn (3); a repair may end in 0 or 3. A symbol is a 4 x 4 matrix of costs between states in the min-plus algebra, where the product
of matrices is the cost of turns one after another. So a run of n equal symbols is the n-th power, from cached binary powers, and
stretches of a conversation can be worked out apart and put together.

Costs-to-go run from the end to the front. Each edit leads to one state alone, so the least letter that keeps to the cheapest cost, turn after turn, gives the
ASCII-least of all cheapest audits.
"""

from __future__ import annotations

from functools import cache
from itertools import groupby

INF = 1 << 60
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state a user or assistant turn leads to, and the initial it must have there.
NEXT, NEEDS = (USER, USER, ASSISTANT, USER), "uuau"
ENDS = (0, INF, INF, 0)
UNIT = tuple(tuple(0 if i == j else INF for j in range(4)) for i in range(4))

#: Symbols: 0 must go; else 1 + 2 * (place of the initial in "sua", 3 for any other) + truncated.
GONE = 0


def symbol(initial: str, must_go: bool, truncated: bool) -> int:
    return GONE if must_go else 1 + 2 * ("sua".find(initial) if initial in ("s", "u", "a") else 3) + truncated


def _edits(sym: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state after) of the edits of one turn, without insertions."""
    out = [("D", DELETE, state)]
    if sym != GONE:
        initial, extra = "sua-"[(sym - 1) // 2], TRUNCATED * ((sym - 1) % 2)
        if initial == NEEDS[state]:
            out.append(("K", KEEP + extra, NEXT[state]))
        elif initial == "s" and state == NOTHING:
            out.append(("K", KEEP + extra, SYSTEM))
        out.append(("R", REROLE + extra, NEXT[state]))
    return out


def times(a, b):
    """Min-plus product."""
    return tuple(tuple(min(INF, min(r[k] + b[k][j] for k in range(4))) for j in range(4)) for r in a)


def onto(a, v):
    """Min-plus product of a matrix and a column."""
    return tuple(min(INF, min(r[k] + v[k] for k in range(4))) for r in a)


@cache
def insertions():
    """Any number of insertions."""
    one = tuple(tuple(INSERT if j == NEXT[i] else 0 if i == j else INF for j in range(4)) for i in range(4))
    two = times(one, one)
    return times(two, two)


@cache
def power(sym: int, k: int):
    """The matrix of 2^k turns of a symbol, with insertions before each."""
    if k:
        return times(power(sym, k - 1), power(sym, k - 1))
    row = [[INF] * 4 for _ in range(4)]
    for state in range(4):
        for _, cost, after in _edits(sym, state):
            row[state][after] = min(row[state][after], cost)
    return times(insertions(), row)


def run_matrix(sym: int, n: int):
    m = UNIT
    for k in range(n.bit_length()):
        if n >> k & 1:
            m = times(m, power(sym, k))       # powers of one matrix commute
    return m


def run_onto(sym: int, n: int, v):
    for k in range(n.bit_length()):
        if n >> k & 1:
            v = onto(power(sym, k), v)
    return v


def runs(symbols) -> list[tuple[int, int]]:
    """(symbol, length) of the runs of equal symbols."""
    return [(s, sum(1 for _ in g)) for s, g in groupby(symbols)]


def matrix_of(rle):
    m = UNIT
    for sym, n in rle:
        m = times(m, run_matrix(sym, n))
    return m


def run_cost(rle) -> int:
    """The cheapest cost of a whole conversation."""
    v = ending()
    for sym, n in reversed(rle):
        v = run_onto(sym, n, v)
    return v[NOTHING]


def ending():
    """Costs-to-go behind the last turn: insertions may still follow."""
    return onto(insertions(), ENDS)


def _relative(v) -> tuple[int, tuple]:
    low = min(v)
    return low, tuple(x - low if x < INF else INF for x in v)


@cache
def _step(sym: int, after):
    """Costs-to-go before one turn, relative to ``after``'s least: (least, rest)."""
    return _relative(onto(power(sym, 0), after))


@cache
def _choose(sym: int, after, state: int) -> tuple[str, int]:
    """Letters for one turn, insertions before it included, and the state behind it."""
    to_go, letters = onto(power(sym, 0), after), ""
    while True:
        options = [(letter, cost + after[t], t) for letter, cost, t in _edits(sym, state)] + [("I", INSERT + to_go[NEXT[state]], NEXT[state])]
        letter, _, t = min(o for o in options if o[1] == to_go[state])
        letters += letter
        state = t
        if letter != "I":
            return letters, state


def unroll(rle, after, states=(NOTHING,)) -> list[tuple[list[str], int]]:
    """Letters of every turn, and the state behind the last, from each of ``states``, if ``after`` are the costs-to-go behind.

    Costs at the borders of runs come from the powers; inside a run they repeat, so each of its turns is a look-up.
    """
    borders = [after]
    for sym, n in reversed(rle):
        borders.append(run_onto(sym, n, borders[-1]))
    borders.reverse()
    out = [([], s) for s in states]
    for (sym, n), behind in zip(rle, borders[1:]):
        inside = [_relative(behind)[1]]
        for _ in range(n - 1):
            inside.append(_step(sym, inside[-1])[1])
        for i, (letters, state) in enumerate(out):
            for v in reversed(inside):
                got, state = _choose(sym, v, state)
                letters.append(got)
            out[i] = (letters, state)
    return out


def closing(state: int) -> str:
    """Letters behind the last turn."""
    letters = ""
    while state not in (NOTHING, ASSISTANT):
        letters, state = letters + "I", NEXT[state]
    return letters


def lines(letters, roles, texts, state: int = NOTHING) -> tuple[list[str], int]:
    """Repaired ``role:text`` lines of turns and the state behind them; ``letters`` is a string of edits per turn."""
    out = []
    for edits, role, text in zip(letters, roles, texts):
        for e in edits:
            if e == "D":
                continue
            name = "user" if NEXT[state] == USER else "assistant"
            if e == "I":
                out.append(name + ":")
                state = NEXT[state]
            elif e == "R":
                out.append(f"{name}:{text}")
                state = NEXT[state]
            else:
                out.append(f"{role}:{text}")
                state = SYSTEM if role[:1] == "s" else NEXT[state]
    return out, state
