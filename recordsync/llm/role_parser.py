"""A generalised LR parser that repairs: weighted edits over a graph-structured stack.

The tables are SLR(1), made from the grammar; a cell may hold several actions.  Stacks share their tails: a vertex is a
state on another vertex and equal ones are one object, so stacks with equal tops merge, and of what led there the least
(cost, audit) stays.  A frontier holds the vertices after a row; audits stand in it by rank, not by text: two audits of
as many rows that end in a row's letter are no proper prefixes of one another, so their order does not change by what
follows.  Frontiers recur, and a transition between two is worked out once.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import cache
from typing import NamedTuple

#: Roles by their initials: a conversation is empty, or pairs of user and assistant after at most one system turn.
GRAMMAR = (("conversation", ()), ("conversation", ("s", "pairs")), ("conversation", ("pairs",)),
           ("pairs", ("pairs", "u", "a")), ("pairs", ("u", "a")))
END = "$"
#: What edits cost, and the roles that Rerole and Insert can give.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}


class Vertex(NamedTuple):
    """A stack: a state of the automaton on the stack below it."""

    state: int
    below: Vertex | None


class Tables:
    """LR(0) states of a grammar with SLR(1) reductions."""

    def __init__(self, grammar: tuple = GRAMMAR) -> None:
        self.rules = (("start", (grammar[0][0],)), *grammar)
        self.heads = {head for head, _ in self.rules}
        self.terminals = sorted({x for _, body in self.rules for x in body} - self.heads)
        self.states: list[frozenset] = [self._closed({(0, 0)})]
        self.moves: dict[tuple[int, str], int] = {}
        for number, items in enumerate(self.states):  # grows while it is walked
            for symbol in sorted({self._next(i) for i in items} - {None}):
                to = self._closed({(r, at + 1) for r, at in items if self._next((r, at)) == symbol})
                if to not in self.states:
                    self.states.append(to)
                self.moves[number, symbol] = self.states.index(to)
        self.follow = self._follow()

    def _next(self, item: tuple[int, int]) -> str | None:
        body = self.rules[item[0]][1]
        return body[item[1]] if item[1] < len(body) else None

    def _closed(self, items: set) -> frozenset:
        found, todo = set(items), list(items)
        while todo:
            head = self._next(todo.pop())
            fresh = {(r, 0) for r, (h, _) in enumerate(self.rules) if h == head} - found
            found |= fresh
            todo += fresh
        return frozenset(found)

    def _follow(self) -> dict[str, set]:
        empty, first = set(), {t: {t} for t in self.terminals} | {h: set() for h in self.heads}
        follow: dict[str, set] = {h: set() for h in self.heads}
        follow["start"].add(END)
        before = None
        while before != (before := (len(empty), sum(map(len, first.values())), sum(map(len, follow.values())))):
            for head, body in self.rules:
                if all(x in empty for x in body):
                    empty.add(head)
                for i, x in enumerate(body):
                    if all(y in empty for y in body[:i]):
                        first[head] |= first[x]
                    if x in self.heads:
                        rest = body[i + 1:]
                        for k, y in enumerate(rest):
                            if all(z in empty for z in rest[:k]):
                                follow[x] |= first[y]
                        if all(z in empty for z in rest):
                            follow[x] |= follow[head]
        return follow

    def reductions(self, state: int, ahead: str) -> list[int]:
        return [r for r, at in self.states[state] if r and at == len(self.rules[r][1]) and ahead in self.follow[self.rules[r][0]]]


class Edit(NamedTuple):
    """A row as the parser sees it: the initial of its role ('' if no terminal), whether it may stay, is truncated."""

    initial: str
    live: bool
    truncated: bool


class Parser:
    """Repairs of rows by the least (cost, audit)."""

    def __init__(self, grammar: tuple = GRAMMAR) -> None:
        self.tables = Tables(grammar)
        self.start = Vertex(0, None)
        self.advance, self.step, self.final = cache(self._advance), cache(self._step), cache(self._final)

    def _reduced(self, vertex: Vertex, ahead: str) -> list[Vertex]:
        """The vertex and all that reductions before ``ahead`` make of it."""
        found, todo = [vertex], [vertex]
        while todo:
            top = todo.pop()
            for r in self.tables.reductions(top.state, ahead):
                head, body = self.tables.rules[r]
                below = top
                for _ in body:
                    below = below.below
                to = Vertex(self.tables.moves[below.state, head], below)
                if to not in found:
                    found.append(to)
                    todo.append(to)
        return found

    def _advance(self, vertex: Vertex, terminal: str) -> tuple[Vertex, ...]:
        """Stacks after reading ``terminal``."""
        return tuple(Vertex(to, v) for v in self._reduced(vertex, terminal)
                     if (to := self.tables.moves.get((v.state, terminal))) is not None)

    def accepts(self, vertex: Vertex) -> bool:
        whole = (0, 1)
        return any(whole in self.tables.states[v.state] for v in self._reduced(vertex, END))

    def vertices(self) -> list[Vertex]:
        """All stacks between two rows, in a fixed order (finite as the grammar's pairs nest to the left)."""
        found = [self.start]
        for v in found:
            found += [w for t in self.tables.terminals for w in self.advance(v, t) if w not in found]
        return found

    def _inserted(self, frontier: tuple) -> dict:
        """vertex: (cost, rank, letters, index) after any insertions before the next row."""
        best = {v: (cost, rank, "", i) for i, (v, cost, rank) in enumerate(frontier)}
        todo = list(best)
        while todo:
            v = todo.pop()
            cost, rank, letters, i = best[v]
            for terminal in ROLES:
                for w in self.advance(v, terminal):
                    made = (cost + INSERT, rank, letters + "I", i)
                    if w not in best or made < best[w]:
                        best[w] = made
                        todo.append(w)
        return best

    def _step(self, frontier: tuple, row: Edit) -> tuple[int, tuple, tuple]:
        """(cost added to all, next frontier, (index before, letters) per vertex of it) for a row."""
        best: dict = {}

        def offer(v: Vertex, made: tuple) -> None:
            if v not in best or made < best[v]:
                best[v] = made

        for v, (cost, rank, letters, i) in self._inserted(frontier).items():
            offer(v, (cost + DELETE, rank, letters + "D", i))
            if not row.live:
                continue
            cost += TRUNCATED * row.truncated
            for w in self.advance(v, row.initial):
                offer(w, (cost, rank, letters + "K", i))
            for terminal in ROLES:
                for w in self.advance(v, terminal):
                    offer(w, (cost + REROLE, rank, letters + "R", i))
        least = min(made[0] for made in best.values())
        ranks = {key: n for n, key in enumerate(sorted({made[1:3] for made in best.values()}))}
        return (least, tuple((v, made[0] - least, ranks[made[1:3]]) for v, made in best.items()),
                tuple((made[3], made[2]) for made in best.values()))

    def _final(self, frontier: tuple) -> tuple[int, int, str] | None:
        """(cost, index, letters) of the least repair that ends here; None if none does."""
        ends = [made for v, made in self._inserted(frontier).items() if self.accepts(v)]
        if not ends:
            return None
        cost, _, letters, i = min(ends)
        return cost, i, letters

    def run(self, entry: Vertex, rows: Iterable[Edit]) -> tuple[int, tuple, list]:
        """(cost of all, last frontier, steps) of rows from a stack on."""
        frontier, cost, steps = ((entry, 0, 0),), 0, []
        for row in rows:
            added, frontier, back = self.step(frontier, row)
            cost += added
            steps.append(back)
        return cost, frontier, steps

    @staticmethod
    def audit(steps: list, index: int) -> str:
        """The letters that led to a vertex of the last frontier."""
        out = []
        for back in reversed(steps):
            index, letters = back[index]
            out.append(letters)
        return "".join(reversed(out))

    def repair(self, rows: Iterable[Edit]) -> tuple[int, str]:
        cost, frontier, steps = self.run(self.start, rows)
        more, index, letters = self.final(frontier)
        return cost + more, self.audit(steps, index) + letters
