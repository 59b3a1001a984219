"""Several byte patterns as one deterministic automaton."""

from __future__ import annotations

import re
from collections.abc import Iterable
from re import _constants as c
from re import _parser as parser

import numpy as np

#: The byte after the end of a text; it is in no pattern, so it ends every match.
RESET = 10


class Nfa:
    """Thompson construction of one pattern over bytes, from the syntax tree of ``re``."""

    def __init__(self, pattern: str) -> None:
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []
        self.start, self.end = self.state(), self.state()
        self.build(parser.parse(pattern), self.start, self.end, 0)

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def build(self, tree: Iterable, a: int, b: int, flags: int) -> None:
        for op, arg in tree:
            after = self.state()
            self.one(op, arg, a, after, flags)
            a = after
        self.empty[a].append(b)

    def one(self, op, arg, a: int, b: int, flags: int) -> None:
        if op is c.LITERAL:
            self.moves[a].append((folded({arg}, flags), b))
        elif op is c.IN:
            self.moves[a].append((folded(members(arg), flags), b))
        elif op is c.SUBPATTERN:
            self.build(arg[3], a, b, (flags | arg[1]) & ~arg[2])
        elif op is c.BRANCH:
            for branch in arg[1]:
                self.build(branch, a, b, flags)
        elif op is c.MAX_REPEAT:
            least, most, tree = arg
            for _ in range(least):
                after = self.state()
                self.build(tree, a, after, flags)
                a = after
            if most is c.MAXREPEAT:
                loop = self.state()
                self.empty[a].append(loop)
                self.build(tree, loop, loop, flags)
                self.empty[loop].append(b)
            else:
                self.empty[a].append(b)
                for _ in range(most - least):
                    after = self.state()
                    self.build(tree, a, after, flags)
                    a = after
                    self.empty[a].append(b)
        else:
            raise ValueError(f"not a pattern of this engine: {op}")

    def closure(self, states: Iterable[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(s for s in seen if self.moves[s] or s == self.end)

    def step(self, states: Iterable[int], byte: int) -> frozenset[int]:
        return self.closure({t for s in states for chars, t in self.moves[s] if byte in chars})


def members(items: list) -> set[int]:
    out: set[int] = set()
    for op, arg in items:
        out |= {arg} if op is c.LITERAL else set(range(arg[0], arg[1] + 1))
    return out


def folded(chars: set[int], flags: int) -> frozenset[int]:
    if any(x > 127 or x == RESET for x in chars):
        raise ValueError("patterns are over ASCII without line ends")
    if flags & re.IGNORECASE:
        chars = chars | {ord(chr(x).swapcase()) for x in chars}
    return frozenset(chars)


class Rule:
    """One pattern as a machine that finds its leftmost, longest matches without overlap.

    A state is a list of thread sets by age: the threads of one start position, oldest first. When the oldest group
    accepts, younger ones go; when it dies after that, the match has ended and the same byte starts afresh.
    """

    def __init__(self, pattern: str) -> None:
        self.nfa = Nfa(pattern)
        self.first = self.nfa.closure({self.nfa.start})
        self.start: tuple = ((), False)

    def step(self, state: tuple, byte: int) -> tuple[tuple, bool]:
        """The next state, and whether a match ended before this byte."""
        groups, matched = state
        moved = [self.nfa.step(g, byte) for g in groups]
        if matched:
            if moved[0]:
                return ((moved[0],), True), False
            return self.step(self.start, byte)[0], True
        seen: set[frozenset[int]] = set()
        kept: list[frozenset[int]] = []
        for g in [*moved, self.nfa.step(self.first, byte)]:
            if g and g not in seen:  # a younger group with the same threads can never win
                seen.add(g)
                kept.append(g)
            if self.nfa.end in g:
                return ((g,), True), False
        return (tuple(kept), False), False

    def reversed_starts(self) -> tuple[list[dict[int, int]], list[bool]]:
        """Deterministic automaton of the reversed pattern: from a match's end back to its start."""
        back: dict[int, set[tuple[int, int]]] = {}
        nfa = self.nfa
        closures = [nfa.closure({s}) for s in range(len(nfa.moves))]
        for s, moves in enumerate(nfa.moves):
            for chars, t in moves:
                for u in closures[t]:
                    for byte in chars:
                        back.setdefault(u, set()).add((byte, s))
        states, table, ok = {frozenset({nfa.end}): 0}, [], []
        todo = [frozenset({nfa.end})]
        while todo:
            now = todo.pop(0)
            ok.append(bool(now & self.first))
            goes: dict[int, set[int]] = {}
            for u in now:
                for byte, s in back.get(u, ()):
                    goes.setdefault(byte, set()).add(s)
            row = {}
            for byte, group in goes.items():
                key = frozenset(group)
                if key not in states:
                    states[key] = len(states)
                    todo.append(key)
                row[byte] = states[key]
            table.append(row)
        return table, ok


class Automaton:
    """All rules as one machine: subset construction over the rules' joint states, then minimisation.

    ``classes`` maps a byte to its class; ``table[state * n_classes + class]`` is the next state. States are numbered
    so that those entered as some rule's match ends come last: from ``first_end`` on, ``ended[state - first_end]`` is
    the set of those rules, one bit each.
    """

    def __init__(self, patterns: list[str]) -> None:
        rules = [Rule(p) for p in patterns]
        used = [chars for r in rules for moves in r.nfa.moves for chars, _ in moves]
        kinds: dict[tuple, int] = {}
        self.classes = np.array([kinds.setdefault(tuple(b in u for u in used), len(kinds)) for b in range(256)], np.uint8)
        sample = [int(np.flatnonzero(self.classes == k)[0]) for k in range(len(kinds))]
        steps: dict[tuple, tuple] = {}
        start = (tuple(r.start for r in rules), 0)
        states, rows, todo = {start: 0}, [], [start]
        for joint, _ in todo:  # grows as states are met
            row = []
            for byte in sample:
                parts, ended = [], 0
                for i, (rule, s) in enumerate(zip(rules, joint, strict=True)):
                    if (i, s, byte) not in steps:
                        steps[i, s, byte] = rule.step(s, byte)
                    after, end = steps[i, s, byte]
                    parts.append(after)
                    ended |= end << i
                key = (tuple(parts), ended)
                if key not in states:
                    states[key] = len(states)
                    todo.append(key)
                row.append(states[key])
            rows.append(row)
        table, outputs = np.array(rows), np.array([out for _, out in todo])
        group = self.minimise(table, outputs)
        # One state for each group; groups that report an end come last, the start state's group keeps its own number.
        pick = np.array([int(np.flatnonzero(group == g)[0]) for g in range(group.max() + 1)])
        order = np.argsort(outputs[pick] > 0, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        self.table = rank[group[table[pick[order]]]].astype(np.int32).ravel()
        self.n_classes, self.start = len(kinds), int(rank[group[0]])
        self.first_end = int((outputs[pick] == 0).sum())
        self.ended = outputs[pick[order]][self.first_end :]
        self.back = [r.reversed_starts() for r in rules]
        idle = self.table.reshape(-1, self.n_classes)
        # A byte that takes every state to the start, but for what it reports, is where a text may be cut.
        home = {s for s in range(len(idle)) if (idle[s] == idle[self.start]).all()}
        self.resets = np.array([all(int(s) in home for s in np.unique(idle[:, k])) for k in range(self.n_classes)])[self.classes]

    @staticmethod
    def minimise(table: np.ndarray, outputs: np.ndarray) -> np.ndarray:
        """The group of each state: split by output, then by the groups that its moves lead to, until nothing splits."""
        group = np.unique(outputs, return_inverse=True)[1].ravel()
        while True:
            _, finer = np.unique(np.column_stack([group, group[table]]), axis=0, return_inverse=True)
            finer = finer.ravel()
            if finer.max() == group.max():
                return group
            group = finer

    def ends(self, data: np.ndarray, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """(position, rule bits) of every match end in bytes that close with a reset byte; one pass over the bytes.

        The bytes are cut after reset bytes, about every ``block`` bytes, and all stretches run side by side. The cut is
        exact: behind a reset byte the machine stands at its start, whatever came before.
        """
        cls = self.classes[data]
        at = np.flatnonzero(self.resets[data])
        at = at[np.concatenate([np.diff(at // block) > 0, [True]])]  # the last reset byte in each block
        starts, stops = np.concatenate([[0], at[:-1] + 1]), at + 1
        order = np.argsort(starts - stops, kind="stable")
        starts, lengths = starts[order], (stops - starts)[order]
        state = np.full(len(starts), self.start, np.int32)
        found_at, found = [], []
        live = len(starts)
        for i in range(int(lengths[0]) if live else 0):
            while live and lengths[live - 1] <= i:
                live -= 1
            state = state[:live]
            state = self.table[state * self.n_classes + cls[starts[:live] + i]]
            if state.max() >= self.first_end:
                hit = np.flatnonzero(state >= self.first_end)
                found_at.append(starts[hit] + i)
                found.append(self.ended[state[hit] - self.first_end])
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        where, what = np.concatenate(found_at), np.concatenate(found)
        order = np.argsort(where, kind="stable")
        return where[order], what[order]

    def start_of(self, rule: int, data: bytes, end: int, least: int) -> int:
        """The leftmost start, not before ``least``, of the rule's match that stops before ``end``."""
        table, ok = self.back[rule]
        state, best = 0, end
        for i in range(end - 1, least - 1, -1):
            state = table[state].get(data[i], -1)
            if state < 0:
                break
            if ok[state]:
                best = i
        return best
