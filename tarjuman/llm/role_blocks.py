"""Cheapest edits of a conversation's rows, by Four-Russians block tables.

A row is a symbol: 2 * role + truncated for the roles system, user, assistant and any
other, or ``GONE`` for a row that must go. The accepted role orders are an automaton of
four states: nothing said yet, after the system, after the user, after the assistant.
The cost vector of a place holds, per state, the least cost of all that follows. Costs
of one vector differ by little, so less their least one there are few vectors; they are
found by closure. The tables give, per vector behind a block of ``LENGTH`` symbols and
block, the vector before it and the least cost gained: a block is one lookup, taken from
the last to the first.

Tracing goes forward. A block's inner vectors are expanded backward from the vector
behind it, and every row takes the letter that is ASCII-least among those that stay at
the least cost, so that the letters in a row are least among all cheapest edits.
"""

from functools import lru_cache

import numpy as np

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = "sua"
GONE = 8
SYMBOLS = 9
LENGTH = 4
NEVER = 1 << 20
#: The edits: delete 3, insert 2, keep 0, rerole 2, and 1 for a truncated row that stays.
COSTS = {"D": 3, "I": 2, "K": 0, "R": 2}
CUT = 1

#: The state after a user or assistant row is put at a state: only one of them fits.
_NEXT = (USER, USER, ASSISTANT, USER)
#: The state after a kept row, by state and role.
_KEPT = {
    (START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (ASSISTANT, 1): USER, (USER, 2): ASSISTANT,
}
Vector = tuple[int, ...]


def role_at(state: int) -> str:
    """The role of a row that is put, or given a new role, at ``state``."""
    return "assistant" if state == USER else "user"


def after(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """``(letter, cost, next state)`` of the edits that consume a row."""
    edits = [("D", COSTS["D"], state)]
    if symbol != GONE:
        role, cut = divmod(symbol, 2)
        if (state, role) in _KEPT:
            edits.append(("K", COSTS["K"] + CUT * cut, _KEPT[state, role]))
        edits.append(("R", COSTS["R"] + CUT * cut, _NEXT[state]))
    return edits


def with_inserts(base: list[int]) -> Vector:
    """Costs when rows may be inserted first. Two inserts in a row lead back to a state."""
    cost = list(base)
    for _ in range(2):
        cost = [min(c, COSTS["I"] + cost[_NEXT[s]], NEVER) for s, c in enumerate(cost)]
    return tuple(cost)


def before(symbol: int, behind: Vector) -> Vector:
    """The cost vector in front of a row, from the one behind it."""
    return with_inserts([min(c + behind[n] for _, c, n in after(symbol, s)) for s in range(4)])


def normalised(vector: Vector) -> tuple[Vector, int]:
    least = min(vector)
    return tuple(c - least if c < NEVER // 2 else NEVER for c in vector), least


class Tables:
    """All vectors reachable from the end and from each single state, and the lookups."""

    def __init__(self):
        self.end, _ = normalised(with_inserts([0, NEVER, NEVER, 0]))
        units = [tuple(0 if s == t else NEVER for s in range(4)) for t in range(4)]
        self.vectors = [self.end, *units]
        known = {v: i for i, v in enumerate(self.vectors)}
        step, gain = [], []
        for vector in self.vectors:  # grows while it is walked
            row = [normalised(before(symbol, vector)) for symbol in range(SYMBOLS)]
            for found, _ in row:
                if found not in known:
                    known[found] = len(self.vectors)
                    self.vectors.append(found)
            step.append([known[found] for found, _ in row])
            gain.append([least for _, least in row])
        self.id_of, self.step = known, step
        self.block, self.gained = np.array(step, np.int32), np.array(gain, np.int32)
        single, more = self.block, self.gained
        for _ in range(LENGTH - 1):
            # One symbol in front of the blocks so far: [vector, symbol, rest].
            self.gained = more[self.block].transpose(0, 2, 1) + self.gained[:, None, :]
            self.block = single[self.block].transpose(0, 2, 1)
            self.gained = self.gained.reshape(len(step), -1)
            self.block = self.block.reshape(len(step), -1)
        self.rows = [
            [[self._row(symbol, vector, state) for state in range(4)] for symbol in range(SYMBOLS)]
            for vector in self.vectors
        ]

    def _row(self, symbol: int, behind: Vector, state: int) -> tuple[str, int]:
        """The letters for a row entered in ``state``, inserts first, and the state after it."""
        here, letters = before(symbol, behind), ""
        if here[state] >= NEVER:
            return "", state
        while True:
            best = [("I", _NEXT[state])] if COSTS["I"] + here[_NEXT[state]] == here[state] else []
            best += [(x, n) for x, c, n in after(symbol, state) if c + behind[n] == here[state]]
            letter, state = min(best)
            letters += letter
            if letter != "I":
                return letters, state

    def boundaries(self, symbols: np.ndarray, end: int) -> tuple[list[int], int, int]:
        """Vectors behind each block, the first row's vector and the cost gained in all.

        The first block may be short.
        """
        odd = len(symbols) % LENGTH
        codes = symbols[odd:].reshape(-1, LENGTH) @ (SYMBOLS ** np.arange(LENGTH - 1, -1, -1))
        behind, vector, cost = [], end, 0
        for code in codes[::-1].tolist():
            behind.append(vector)
            vector, cost = int(self.block[vector, code]), cost + int(self.gained[vector, code])
        if odd:
            behind.append(vector)
            for symbol in symbols[:odd][::-1].tolist():
                cost += normalised(before(symbol, self.vectors[vector]))[1]
                vector = self.step[vector][symbol]
        return behind[::-1], vector, cost

    def trace(self, symbols: np.ndarray, end: int, state: int) -> tuple[list[str], int]:
        """The letters of every row and the state behind the last one."""
        behind, _, _ = self.boundaries(symbols, end)
        first = len(symbols) % LENGTH or LENGTH
        letters, at = [], 0
        for number, vector in enumerate(behind):
            block = symbols[at:first + number * LENGTH].tolist()
            at += len(block)
            inner = [vector]
            for symbol in block[:0:-1]:
                inner.append(self.step[inner[-1]][symbol])
            for symbol, own in zip(block, reversed(inner)):
                edits, state = self.rows[own][symbol][state]
                letters.append(edits)
        return letters, state

    def matrix(self, symbols: np.ndarray) -> list[int]:
        """Least costs from each state before the rows to each state behind them, row by row."""
        columns = []
        for state in range(4):
            _, vector, cost = self.boundaries(symbols, 1 + state)
            columns.append([c + cost if c < NEVER else NEVER for c in self.vectors[vector]])
        return [columns[t][s] for s in range(4) for t in range(4)]

    def through(self, matrix: list[int], end: int) -> int:
        """The vector before rows of that matrix, from the one behind them."""
        behind = self.vectors[end]
        found = tuple(min(min(matrix[4 * s + t] + behind[t] for t in range(4)), NEVER) for s in range(4))
        return self.id_of[normalised(found)[0]]


def closing(state: int) -> str:
    """Inserts that complete a conversation that ends in ``state``."""
    letters = ""
    while state not in (START, ASSISTANT):
        letters, state = letters + "I", _NEXT[state]
    return letters


def next_state(state: int) -> int:
    """The state after an insert or a new role."""
    return _NEXT[state]


def kept_state(state: int, symbol: int) -> int:
    """The state after a row is kept."""
    return _KEPT[state, symbol // 2]


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()
