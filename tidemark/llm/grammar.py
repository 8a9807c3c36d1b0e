"""Repair programs over grammar-compressed sequences: Re-Pair rules, and a min-plus matrix with audit ropes a rule.

A conversation is a string of symbols, one a row: its role's initial (o for any other), in capitals if the row is
truncated, x if it has to go. Edits are letters with costs: Keep 0, Rerole 1, Delete 2, Insert 5; a truncated
row that stays costs 5 more. The initials that result are read by an automaton of four states (nothing yet,
after s, after u, after a), so each symbol is a 4 x 4 matrix of the cheapest cost from state to state, with the
inserts before the row in it. Matrices of a pair multiply, once a rule, whatever number of conversations use it.

Of equal costs the ASCII-least letters win. Strings of edits that use up the same rows from the same state end
with an edit of a row and spell different letters for different end states, so none is the beginning of another:
they are in a strict order, which later edits can't change. A matrix therefore keeps the rank of its end states
in each row, and ropes are joined but never compared.
"""

from __future__ import annotations

from dataclasses import dataclass

ALPHABET = "suaoSUAOx"
STATES = range(4)
#: Where an initial leads to from each state; None is no way.
STEP = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Inserts from a state to each state: their number.
INSERTS = ((0, None, 1, 2), (None, 0, 1, 2), (None, None, 0, 1), (None, None, 1, 0))
#: Inserts that bring each state to an accepted end.
CLOSING = (0, 2, 1, 0)


@dataclass(frozen=True)
class Matrix:
    """cost and rope of each pair of states (None: no way); rank: the order of a row's ropes."""

    cost: tuple
    rope: tuple
    rank: tuple


def _ranked(cells: list[dict]) -> Matrix:
    """cells: for each start {end: (cost, order key, rope)}."""
    cost, rope, rank = [], [], []
    for row in cells:
        order = {j: r for r, j in enumerate(sorted(row, key=lambda j, row=row: row[j][1]))}
        cost.append(tuple(row[j][0] if j in row else None for j in STATES))
        rope.append(tuple(row[j][2] if j in row else None for j in STATES))
        rank.append(tuple(order.get(j) for j in STATES))
    return Matrix(tuple(cost), tuple(rope), tuple(rank))


def _edits(symbol: str, state: int):
    """(end, cost, letter) of each edit of a row."""
    yield state, DELETE, "D"
    if symbol == "x":
        return
    more, own = (TRUNCATED if symbol.isupper() else 0), symbol.lower()
    if own in STEP and STEP[own][state] is not None:
        yield STEP[own][state], KEEP + more, "K"
    for to in "ua":
        if STEP[to][state] is not None:
            yield STEP[to][state], REROLE + more, "R"


def of_symbol(symbol: str) -> Matrix:
    cells = []
    for i in STATES:
        row = {}
        for k in STATES:
            if INSERTS[i][k] is not None:
                for j, cost, letter in _edits(symbol, k):
                    word = "I" * INSERTS[i][k] + letter
                    found = (cost + INSERT * INSERTS[i][k], word, word)
                    row[j] = min(row.get(j, found), found)
        cells.append(row)
    return _ranked(cells)


def product(a: Matrix, b: Matrix) -> Matrix:
    cells = []
    for i in STATES:
        row = {}
        for j in STATES:
            ways = [(a.cost[i][k] + b.cost[k][j], (a.rank[i][k], b.rank[k][j]), k) for k in STATES if a.cost[i][k] is not None and b.cost[k][j] is not None]
            if ways:
                cost, order, k = min(ways)
                row[j] = (cost, order, (a.rope[i][k], b.rope[k][j]))
        cells.append(row)
    return _ranked(cells)


def matrices(rules: list[tuple[str, str, str]]) -> dict[str, Matrix]:
    """Of every symbol: the alphabet's, and bottom-up those of the rules (symbol, left, right), in order of their making."""
    found = {c: of_symbol(c) for c in ALPHABET}
    for symbol, left, right in rules:
        found[symbol] = product(found[left], found[right])
    return found


def spelled(rope) -> str:
    """The letters of a rope."""
    out, left = [], [rope]
    while left:
        x = left.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            left += (x[1], x[0])
    return "".join(out)


class Walk:
    """The cheapest edits of one sequence, symbol by symbol from the start: a row of four cells."""

    def __init__(self, table: dict[str, Matrix]):
        self.table, self.cells = table, {0: (0, 0, "")}

    def take(self, symbols: str) -> None:
        for c in symbols:
            m, now = self.table[c], {}
            for j in STATES:
                ways = [(v[0] + m.cost[k][j], (v[1], m.rank[k][j]), k) for k, v in self.cells.items() if m.cost[k][j] is not None]
                if ways:
                    cost, order, k = min(ways)
                    now[j] = (cost, order, (self.cells[k][2], m.rope[k][j]))
            ranks = {j: r for r, j in enumerate(sorted(now, key=lambda j, now=now: now[j][1]))}
            self.cells = {j: (v[0], ranks[j], v[2]) for j, v in now.items()}

    def end(self) -> tuple[int, str]:
        """(cost, audit) with the inserts that close the sequence."""
        cost, _, state = min((v[0] + INSERT * CLOSING[j], v[1], j) for j, v in self.cells.items())
        return cost, spelled(self.cells[state][2]) + "I" * CLOSING[state]


def chosen(pairs: list[tuple[str, int]], most: int) -> list[str]:
    """Pairs (with their counts, the most frequent first) whose places don't overlap: no symbol is both a left and a right one."""
    left, right, out = set(), set(), []
    for pair, _ in pairs:
        a, b = pair
        if a not in right and b not in left and (a != b or (a not in left and b not in right)):
            left.add(a)
            right.add(b)
            out.append(pair)
            if len(out) == most:
                break
    return out
