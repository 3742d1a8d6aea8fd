"""Rule expressions compiled into one deterministic automaton over bytes.

Expressions are turned into a non-deterministic automaton, made deterministic by subset construction over classes of bytes that no
rule tells apart, and minimised by partition refinement. The result is a transition array: next state by state and byte.
"""
from __future__ import annotations

import re
from re import _constants as sre
from re import _parser
from typing import NamedTuple

import numpy as np


class Automaton(NamedTuple):
    """State 0 is dead, state ``start`` the first one; states from ``accepting`` on accept."""

    table: np.ndarray  # states x 256
    start: int
    accepting: int

    def longest(self, data: bytes, at: int, end: int) -> int:
        """The end of the longest match that begins at ``at``, or -1."""
        table, state, found = self.table, self.start, -1
        while at < end:
            state = table[state, data[at]]
            if state == 0:
                break
            at += 1
            if state >= self.accepting:
                found = at
        return found

    def first_bytes(self) -> np.ndarray:
        return self.table[self.start] != 0


class _Net:
    """A non-deterministic automaton under construction; state 0 is the entry."""

    def __init__(self) -> None:
        self.free: list[list[int]] = [[]]
        self.by_byte: list[list[tuple[frozenset[int], int]]] = [[]]

    def state(self) -> int:
        self.free.append([])
        self.by_byte.append([])
        return len(self.free) - 1

    def add(self, parsed, at: int, flags: int) -> int:
        """Append a parsed expression behind state ``at``; the state behind it."""
        for op, arg in parsed:
            at = self._one(op, arg, at, flags)
        return at

    def _one(self, op, arg, at: int, flags: int) -> int:
        if op in (sre.LITERAL, sre.IN):
            to = self.state()
            self.by_byte[at].append((_bytes(op, arg, flags), to))
            return to
        if op is sre.SUBPATTERN:
            _, on, off, inner = arg
            return self.add(inner, at, (flags | on) & ~off)
        if op is sre.BRANCH:
            to = self.state()
            for branch in arg[1]:
                entry = self.state()
                self.free[at].append(entry)
                self.free[self.add(branch, entry, flags)].append(to)
            return to
        if op is sre.MAX_REPEAT:
            least, most, inner = arg
            for _ in range(least):
                at = self.add(inner, at, flags)
            if most is sre.MAXREPEAT:
                entry = self.state()
                self.free[at].append(entry)
                self.free[self.add(inner, entry, flags)].append(entry)
                return entry
            to = self.state()
            for _ in range(most - least):
                self.free[at].append(to)
                at = self.add(inner, at, flags)
            self.free[at].append(to)
            return to
        raise ValueError(f"a rule may not use {op}")


def _bytes(op, arg, flags: int) -> frozenset[int]:
    found: set[int] = set()
    for kind, value in [(op, arg)] if op is sre.LITERAL else arg:
        if kind is sre.LITERAL:
            found.add(value)
        elif kind is sre.RANGE:
            found.update(range(value[0], value[1] + 1))
        else:
            raise ValueError(f"a rule may not use {kind} in a class")
    if flags & re.IGNORECASE:
        found |= {ord(chr(b).swapcase()) for b in found if chr(b).isalpha() and b < 128}
    return frozenset(found)


def compiled(patterns: list[str], anywhere: bool) -> Automaton:
    """One automaton that accepts where any of the patterns ends; with ``anywhere`` it begins anew at every byte."""
    net = _Net()
    ends = set()
    for pattern in patterns:
        entry = net.state()
        net.free[0].append(entry)
        ends.add(net.add(_parser.parse(pattern), entry, 0))

    def closed(states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for x in net.free[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(x for x in seen if net.by_byte[x] or x in ends)

    sets = sorted({s for moves in net.by_byte for s, _ in moves}, key=sorted)
    told = np.array([[b in s for s in sets] for b in range(256)])
    _, sample, classes = np.unique(told, axis=0, return_index=True, return_inverse=True)
    first = closed([0])
    number, todo, rows = {frozenset(): 0, first: 1}, [first], [[0] * len(sample)]
    if anywhere:
        rows[0] = None
    while todo:
        states = todo.pop(0)
        row = []
        for b in sample:
            after = closed([to for x in states for s, to in net.by_byte[x] if b in s])
            if anywhere:
                after |= first
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            row.append(number[after])
        rows.append(row)
    if anywhere:
        rows[0] = [0] * len(sample)
    moves = np.array(rows)
    accepts = np.zeros(len(moves), dtype=bool)
    for states, n in number.items():
        accepts[n] = bool(states & ends)
    return _minimal(moves, accepts, classes.reshape(-1))


def _minimal(moves: np.ndarray, accepts: np.ndarray, classes: np.ndarray) -> Automaton:
    """Merge states that no continuation tells apart; dead first, accepting last."""
    part = accepts.astype(np.int64)
    while True:
        _, finer = np.unique(np.column_stack([part, part[moves]]), axis=0, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == part.max():
            break
        part = finer
    n = part.max() + 1
    accepting = np.zeros(n, dtype=bool)
    accepting[part] = accepts
    dead = part[0]
    order = sorted(range(n), key=lambda p: (accepting[p], p != dead, p))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.arange(n)
    table = np.zeros((n, len(moves[0])), dtype=np.int64)
    table[rank[part]] = rank[part[moves]]
    return Automaton(table[:, classes].astype(np.int32), int(rank[part[1]]), int(n - accepting.sum()))
