"""Generalised LR repair of role sequences.

The grammar of a conversation's role initials, ``(s?(ua)+)?``, is compiled into
LR(0) tables. A graph-structured stack holds one node per (LR state, node below
it); nodes are shared, and stacks whose top node is equal are merged, the one of
least (cost, audit) staying. Edits of a row: keep, give another role, delete;
turns may be inserted anywhere.

Two edit sequences over the same rows that cost the same are never a prefix of
one another (the longer one would hold only additional inserts, which cost), so
the order of two audits outlives any common continuation, and merging by the
least (cost, audit) loses no cheapest repair.

The rows' effect on the stack tops is composed (``transfer``), so a part of a
conversation can be worked on without the rows before it.
"""

from __future__ import annotations

from functools import lru_cache

#: Start symbol first; C is a conversation, P closed exchanges, X an open one.
GRAMMAR = (("C", ""), ("C", "P"), ("P", "Xa"), ("X", "u"), ("X", "su"), ("X", "Pu"))
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 2, 3, 2, 1

Level = dict[int, tuple[int, str]]


def _closure(items: frozenset) -> frozenset:
    items, todo = set(items), list(items)
    while todo:
        rule, dot = todo.pop()
        after = GRAMMAR[rule][1][dot:dot + 1]
        for k, (head, _) in enumerate(GRAMMAR):
            if head == after and (k, 0) not in items:
                items.add((k, 0))
                todo.append((k, 0))
    return frozenset(items)


class RoleParser:
    """LR(0) automaton and graph-structured stack; a node is a number."""

    def __init__(self):
        start = _closure(frozenset((k, 0) for k, (head, _) in enumerate(GRAMMAR) if head == GRAMMAR[0][0]))
        self._states, self._goto, todo = {start: 0}, {}, [start]
        while todo:
            items = todo.pop()
            for symbol in {GRAMMAR[r][1][d] for r, d in items if d < len(GRAMMAR[r][1])}:
                moved = _closure(frozenset((r, d + 1) for r, d in items if GRAMMAR[r][1][d:d + 1] == symbol))
                if moved not in self._states:
                    self._states[moved] = len(self._states)
                    todo.append(moved)
                self._goto[self._states[items], symbol] = self._states[moved]
        self._done = {n: [r for r, d in items if d == len(GRAMMAR[r][1])] for items, n in self._states.items()}
        self._nodes: dict[tuple[int, int], int] = {(0, -1): 0}
        self._stacks = [(0, -1)]
        self.start = 0
        # stacks of this grammar have bounded depth: the nodes that can lie on top between symbols
        self.tops, todo = [0], [0]
        while todo:
            node = todo.pop()
            for symbol in "sua":
                for after in self.shift(node, symbol):
                    if after not in self.tops:
                        self.tops.append(after)
                        todo.append(after)
        self.next_role = {t: [s for s in ROLES if self.shift(t, s)] for t in self.tops}

    def _push(self, node: int, symbol: str) -> int | None:
        state = self._goto.get((self._stacks[node][0], symbol))
        if state is None:
            return None
        key = (state, node)
        if key not in self._nodes:
            self._nodes[key] = len(self._stacks)
            self._stacks.append(key)
        return self._nodes[key]

    def shift(self, node: int, symbol: str) -> list[int]:
        """The tops after reading ``symbol``, reductions done."""
        first = self._push(node, symbol)
        todo, out = [] if first is None else [first], []
        while todo:
            top = todo.pop()
            state = self._stacks[top][0]
            for rule in self._done[state]:
                head, body = GRAMMAR[rule]
                if head != GRAMMAR[0][0]:
                    under = top
                    for _ in body:
                        under = self._stacks[under][1]
                    reduced = self._push(under, head)
                    if reduced is not None:
                        todo.append(reduced)
            if any((state, s) in self._goto for s in "sua") or self.accepts(top):
                out.append(top)
        return out

    def accepts(self, node: int) -> bool:
        state, under = self._stacks[node]
        return any(GRAMMAR[r][0] == GRAMMAR[0][0] for r in self._done[state]) and (
            node == self.start or under == self.start)

    def inserted(self, level: Level) -> Level:
        """``level`` with any number of turns inserted."""
        level, todo = dict(level), list(level)
        while todo:
            node = todo.pop()
            cost, audit = level[node]
            for symbol in ROLES:
                for after in self.shift(node, symbol):
                    found = (cost + INSERT, audit + "I")
                    if after not in level or found < level[after]:
                        level[after] = found
                        todo.append(after)
        return level

    def read(self, level: Level, initial: str, must_go: bool, cut_short: bool) -> Level:
        """All tops after one more row and its edits."""
        out: Level = {}

        def reach(node, cost, audit):
            if node not in out or (cost, audit) < out[node]:
                out[node] = (cost, audit)

        extra = CUT_SHORT if cut_short else 0
        for node, (cost, audit) in self.inserted(level).items():
            reach(node, cost + DELETE, audit + "D")
            if must_go:
                continue
            for after in self.shift(node, initial):
                reach(after, cost + KEEP + extra, audit + "K")
            for symbol in ROLES:
                for after in self.shift(node, symbol):
                    reach(after, cost + REROLE + extra, audit + "R")
        return out


PARSER = RoleParser()


@lru_cache(maxsize=None)
def _row(entry: int, initial: str, must_go: bool, cut_short: bool) -> tuple:
    level = PARSER.read({entry: (0, "")}, initial, must_go, cut_short)
    return tuple((node, cost, audit) for node, (cost, audit) in level.items())


def transfer(level: Level, rows: list[tuple[str, bool, bool]]) -> Level:
    """``level`` after ``rows`` of (role initial, must be deleted, cut short).
    An initial that the grammar does not know is given as the empty text."""
    for row in rows:
        out: Level = {}
        for entry, (cost, audit) in level.items():
            for node, more, letters in _row(entry, *row):
                total = cost + more
                if node not in out or total < out[node][0] or (
                        total == out[node][0] and audit + letters < out[node][1]):
                    out[node] = (total, audit + letters)
        level = out
    return level


def compose(level: Level, moves: dict[int, Level]) -> Level:
    """``level`` after a part whose transfer from each entry is ``moves``."""
    out: Level = {}
    for entry, (cost, audit) in level.items():
        for node, (more, letters) in moves[entry].items():
            total = cost + more
            if node not in out or total < out[node][0] or (
                    total == out[node][0] and audit + letters < out[node][1]):
                out[node] = (total, audit + letters)
    return out


def cheapest(level: Level) -> tuple[int, str]:
    """The least (cost, audit) whose roles the grammar accepts."""
    return min(found for node, found in PARSER.inserted(level).items() if PARSER.accepts(node))


def apply_edits(rows: list[tuple[str, str]], audit: str, node: int) -> tuple[list[tuple[str, str]], int]:
    """The (role, text) turns that ``audit`` makes of ``rows`` from stack top
    ``node``, and the top after them."""
    out, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        if edit == "K":
            role, text = rows[at]
            symbol = role[:1]
        else:
            (symbol,) = PARSER.next_role[node]
            role, text = ROLES[symbol], "" if edit == "I" else rows[at][1]
        at += edit != "I"
        out.append((role, text))
        (node,) = PARSER.shift(node, symbol)
    return out, node
