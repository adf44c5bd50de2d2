"""Cheapest edits of role and fault sequences, by a grammar that many sequences share.

A conversation is well formed if the initials of its roles match ``(s?(ua)+)?``. Four states follow that
form: 0 nothing yet, 1 after ``s``, 2 after ``u``, 3 after ``a``; a row's matrix holds, from each state to
each, the least cost of the edits up to and at this row, and of equally cheap ones the least in letters.
Matrices multiply in the (min, +) way, and their letters are joined as ropes. Frequent pairs of symbols
become rules, as in Re-Pair; a rule's matrix is made once, from those of its two parts, and used wherever
the rule occurs.

Of equally cheap edits of the same rows none is the beginning of another, as the letters give the cost.
So the least in letters stays least whatever is joined to both.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

STATES = 4
CLASSES = "sua?"                        # initials that count, and all others
SOUND, CUT_SHORT, MUST_GO = range(3)    # what a symbol says of its row beside its class
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1     # costs
_FORWARD = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_ADDED = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}   # the one role that may follow
# the least inserts from state to state, and to a well-formed end
_INSERTS = {(0, 0): 0, (0, 2): 1, (0, 3): 2, (1, 1): 0, (1, 2): 1, (1, 3): 2, (2, 2): 0, (2, 3): 1, (3, 2): 1, (3, 3): 0}
_CLOSING = (0, 2, 1, 0)
_LEAF = 64                              # letters that are joined outright

Rope = str | tuple                      # letters, or (left, right, length)
Entry = tuple[int, Rope] | None         # cost and edits; None: no way
Matrix = list[Entry]                    # from state * STATES + to state


def _length(rope: Rope) -> int:
    return len(rope) if isinstance(rope, str) else rope[2]


def joined(a: Rope, b: Rope) -> Rope:
    n = _length(a) + _length(b)
    if isinstance(a, str) and isinstance(b, str) and (n <= _LEAF or not a or not b):
        return a + b
    return (a, b, n)


def letters(rope: Rope) -> str:
    out, waiting = [], [rope]
    while waiting:
        top = waiting.pop()
        if isinstance(top, str):
            out.append(top)
        else:
            waiting += (top[1], top[0])
    return "".join(out)


def before(a: Rope, b: Rope) -> bool:
    """Whether ``a`` is less. Parts that both share are passed over whole."""
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y:
            continue
        if isinstance(x, tuple) and (isinstance(y, str) or x[2] >= y[2]):
            left += (x[1], x[0])
            right.append(y)
        elif isinstance(y, tuple):
            right += (y[1], y[0])
            left.append(x)
        else:
            n = min(len(x), len(y))
            if x[:n] != y[:n]:
                return x[:n] < y[:n]
            left += [x[n:]] if x[n:] else []
            right += [y[n:]] if y[n:] else []
    return bool(right)


def better(a: Entry, b: Entry) -> bool:
    """Whether ``a`` is cheaper than ``b``, or as cheap and less."""
    return a is not None and (b is None or a[0] < b[0] or (a[0] == b[0] and before(a[1], b[1])))


def row_matrix(symbol: int) -> Matrix:
    """Inserts, then the edit of one row."""
    role, fault = CLASSES[symbol // 3], symbol % 3
    late = TRUNCATED if fault == CUT_SHORT else 0
    out: Matrix = [None] * (STATES * STATES)
    for (start, at), inserts in _INSERTS.items():
        ways = [(at, DELETE, "D")]
        if fault != MUST_GO:
            for (state, initial), end in _FORWARD.items():
                if state == at and initial == role:
                    ways.append((end, KEEP + late, "K"))
                elif state == at and initial != "s":
                    ways.append((end, REROLE + late, "R"))
        for end, cost, letter in ways:
            entry = (INSERT * inserts + cost, "I" * inserts + letter)
            place = start * STATES + end
            if better(entry, out[place]):
                out[place] = entry
    return out


def product(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = []
    for i in range(0, STATES * STATES, STATES):
        out += step(a[i:i + STATES], b)[0]
    return out


def step(row: list[Entry], matrix: Matrix) -> tuple[list[Entry], list[int]]:
    """The entries after the matrix, and the state before it that each comes from."""
    out, origin = [], []
    for j in range(STATES):
        best, of = None, -1
        for k in range(STATES):
            left, right = row[k], matrix[k * STATES + j]
            if left is None or right is None:
                continue
            cost = left[0] + right[0]
            if best is not None and cost > best[0]:
                continue
            entry = (cost, joined(left[1], right[1]))
            if better(entry, best):
                best, of = entry, k
        out.append(best)
        origin.append(of)
    return out, origin


class Grammar:
    """Symbols 0 to 11 are rows, later ones are rules of two symbols each."""

    MOST = 50_000       # rules kept from one call to the next

    def __init__(self):
        self.rules: dict[tuple[int, int], int] = {}
        self.matrices = [row_matrix(s) for s in range(3 * len(CLASSES))]

    def _rule(self, pair: tuple[int, int]) -> int:
        found = self.rules.get(pair)
        if found is None:
            found = self.rules[pair] = len(self.matrices)
            self.matrices.append(product(self.matrices[pair[0]], self.matrices[pair[1]]))
        return found

    def compress(self, sequences: list[list[int]]) -> list[list[int]]:
        """Re-Pair: the most frequent pair becomes one symbol, until no pair occurs twice."""
        symbols = [s for sequence in sequences for s in (*sequence, -1)]
        n = len(symbols)
        after, back = list(range(1, n + 1)), list(range(-1, n - 1))
        where: defaultdict[tuple[int, int], set[int]] = defaultdict(set)
        for at in range(n - 1):
            if symbols[at] >= 0 and symbols[at + 1] >= 0:
                where[symbols[at], symbols[at + 1]].add(at)
        queue = [(-len(places), pair) for pair, places in where.items() if len(places) > 1]
        heapq.heapify(queue)
        while queue:
            count, pair = heapq.heappop(queue)
            places = where.get(pair, ())
            if len(places) < 2:
                continue
            if len(places) != -count:           # it has changed since it was queued
                heapq.heappush(queue, (-len(places), pair))
                continue
            new, met = self._rule(pair), set()
            del where[pair]
            for at in sorted(places):
                gone = after[at]
                if symbols[at] != pair[0] or symbols[gone] != pair[1]:      # it overlapped the one before
                    continue
                left, right = back[at], after[gone]
                if left >= 0 and symbols[left] >= 0:
                    where[symbols[left], pair[0]].discard(left)
                    where[symbols[left], new].add(left)
                    met.add((symbols[left], new))
                if symbols[right] >= 0:         # a sequence ends with -1, so there is a symbol
                    where[pair[1], symbols[right]].discard(gone)
                    where[new, symbols[right]].add(at)
                    met.add((new, symbols[right]))
                symbols[at], symbols[gone] = new, -2
                after[at], back[right] = right, at
            for pair in met:
                if len(where[pair]) > 1:
                    heapq.heappush(queue, (-len(where[pair]), pair))
        out: list[list[int]] = [[]]
        for symbol in symbols:
            if symbol == -1:
                out.append([])
            elif symbol >= 0:
                out[-1].append(symbol)
        return out[:-1]

    def solve(self, sequences: list[list[int]]) -> list[Matrix]:
        """The matrix of each sequence, none of them empty; equal ones are worked out once."""
        if len(self.rules) > self.MOST:
            self.__init__()
        distinct = list(dict.fromkeys(map(tuple, sequences)))
        solved = {}
        for sequence, short in zip(distinct, self.compress([list(s) for s in distinct]), strict=True):
            matrix = self.matrices[short[0]]
            for symbol in short[1:]:
                matrix = product(matrix, self.matrices[symbol])
            solved[sequence] = matrix
        return [solved[tuple(s)] for s in sequences]


def closed(row: list[Entry]) -> tuple[int, Rope, int]:
    """Cost, edits and last state of the best way to a well-formed end."""
    best, of = None, 0
    for state, inserts in enumerate(_CLOSING):
        if row[state] is not None:
            entry = (row[state][0] + INSERT * inserts, joined(row[state][1], "I" * inserts))
            if better(entry, best):
                best, of = entry, state
    return best[0], best[1], of


def lines(edits: str, symbols: str, state: int) -> tuple[list[tuple[int, str, int | None, str | None]], int]:
    """What the edits leave: (place among the edits, edit, row or None, new role or None), and the last state.

    ``symbols`` has a character for each row, the class and fault as ``chr(65 + symbol)``.
    """
    out, row = [], 0
    for place, letter in enumerate(edits):
        if letter == "K":
            out.append((place, letter, row, None))
            state = _FORWARD[state, CLASSES[(ord(symbols[row]) - 65) // 3]]
        elif letter in "RI":
            role, state = _ADDED[state]
            out.append((place, letter, row if letter == "R" else None, role))
        row += letter != "I"
    return out, state
