"""A deterministic automaton over bytes for many regular expressions at once.

The patterns are parsed by Python's own ``re`` parser, joined into one nondeterministic automaton that may start
a match at any byte, made deterministic by subset construction and then minimised by partition refinement.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass
from re import _constants as C
from re import _parser as parser

import numpy as np


@dataclass(frozen=True)
class Automaton:
    """``step[state, byte]`` is the next state; states from ``first_hit`` on accept, ``hits[state]`` has a bit per rule.

    ``resets[byte]`` is true for bytes that lead every state to the start: a text may be cut after them.
    """

    step: np.ndarray
    hits: np.ndarray
    start: int
    first_hit: int
    resets: np.ndarray


class _Nfa:
    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def add(self, items, at: int, fold: bool) -> int:
        """Append a parsed pattern behind state ``at``; returns its last state."""
        for kind, value in items:
            if kind is C.SUBPATTERN:
                _, added, dropped, inner = value
                at = self.add(inner, at, (fold or bool(added & re.I)) and not dropped & re.I)
            elif kind is C.BRANCH:
                end = self.state()
                for choice in value[1]:
                    begin = self.state()
                    self.empty[at].append(begin)
                    self.empty[self.add(choice, begin, fold)].append(end)
                at = end
            elif kind is C.MAX_REPEAT:
                least, most, inner = value
                for _ in range(least):
                    at = self.add(inner, at, fold)
                if most is C.MAXREPEAT:
                    loop = self.state()
                    self.empty[at].append(loop)
                    self.empty[self.add(inner, loop, fold)].append(loop)
                    at = loop
                else:
                    end = self.state()
                    self.empty[at].append(end)
                    for _ in range(most - least):
                        at = self.add(inner, at, fold)
                        self.empty[at].append(end)
                    at = end
            else:
                after = self.state()
                self.moves[at].append((_bytes_of(kind, value, fold), after))
                at = after
        return at


def _bytes_of(kind, value, fold: bool) -> frozenset[int]:
    if kind is C.LITERAL:
        found = {value}
    elif kind is C.RANGE:
        found = set(range(value[0], value[1] + 1))
    elif kind is C.IN:
        parts = [(k, v) for k, v in value if k is not C.NEGATE]
        found = set().union(*(_bytes_of(k, v, fold) for k, v in parts))
        if len(parts) < len(value):
            found = set(range(256)) - found
    else:
        raise ValueError(f"unsupported in a rule: {kind}")
    if max(found) > 255:
        raise ValueError("rules are over ASCII")
    if fold:
        found |= {ord(c) for b in found if b < 128 for c in (chr(b).lower(), chr(b).upper())}
    return frozenset(found)


def _byte_classes(nfa: _Nfa) -> np.ndarray:
    """Bytes that no move tells apart share a class."""
    signs: dict[tuple[bool, ...], int] = {}
    sets = list({chars for moves in nfa.moves for chars, _ in moves})
    return np.array([signs.setdefault(tuple(b in chars for chars in sets), len(signs)) for b in range(256)])


def compile_rules(patterns: list[str]) -> Automaton:
    """The minimal automaton that, after each byte, tells which patterns have a match ending there."""
    nfa = _Nfa()
    root = nfa.state()
    ends = {}
    for rule, pattern in enumerate(patterns):
        begin = nfa.state()
        nfa.empty[root].append(begin)
        ends[nfa.add(parser.parse(pattern, re.A), begin, False)] = 1 << rule

    closures: dict[int, frozenset[int]] = {}

    def closure(state: int) -> frozenset[int]:
        if state not in closures:
            seen, todo = {state}, [state]
            while todo:
                for other in nfa.empty[todo.pop()]:
                    if other not in seen:
                        seen.add(other)
                        todo.append(other)
            closures[state] = frozenset(seen)
        return closures[state]

    classes = _byte_classes(nfa)
    count = int(classes.max()) + 1
    samples = [int(np.flatnonzero(classes == c)[0]) for c in range(count)]
    by_state = [defaultdict(set) for _ in nfa.moves]
    for state, moves in enumerate(nfa.moves):
        for chars, after in moves:
            for c, sample in enumerate(samples):
                if sample in chars:
                    by_state[state][c] |= closure(after)

    first = closure(root)
    numbers, sets, table = {first: 0}, [first], []
    for members in sets:  # grows while it is walked
        row = []
        for c in range(count):
            after = frozenset(first.union(*(by_state[s][c] for s in members if c in by_state[s])))
            if after not in numbers:
                numbers[after] = len(sets)
                sets.append(after)
            row.append(numbers[after])
        table.append(row)
    step = np.array(table)
    hits = np.array([sum(ends.get(s, 0) for s in members) for members in sets])

    part = np.unique(hits, return_inverse=True)[1]
    while True:  # states stay together while their moves lead to the same parts
        finer = np.unique(np.column_stack([part, part[step]]), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == part.max():
            break
        part = finer
    one_of = np.array([np.flatnonzero(part == p)[0] for p in range(part.max() + 1)])
    order = np.argsort(hits[one_of] > 0, kind="stable")
    place = np.argsort(order)
    step, hits = place[part[step[one_of]]][order], hits[one_of][order]
    start = int(place[part[0]])
    wide = step[:, classes].astype(np.uint16 if len(step) < 1 << 16 else np.int32)
    return Automaton(wide, hits, start, int((hits == 0).sum()), (wide == start).all(axis=0))


def scan(machine: Automaton, texts: list[bytes], stretch: int = 512) -> list[int]:
    """For each text, the bits of all rules that match somewhere in it.

    All texts are read once, byte by byte, in lockstep: they are cut after bytes that reset the automaton, about every
    ``stretch`` bytes, and one step moves every piece on by a byte. Nothing is lost at the cuts, as a piece begins in
    the very state that the text before it leads to; a text without resetting bytes is one piece.
    """
    found = np.zeros(len(texts), np.int64)
    if not machine.resets[10]:
        raise ValueError("no rule may match over a line break")
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    cuts = np.flatnonzero(machine.resets[data])
    marks = np.unique(cuts[np.minimum(np.searchsorted(cuts, np.arange(0, len(data), stretch)), len(cuts) - 1)]) + 1
    begins = np.r_[0, marks]
    lengths = np.diff(np.r_[begins, len(data)])
    order = np.argsort(-lengths, kind="stable")
    begins, lengths = begins[order], lengths[order]
    begins = begins[lengths > 0]
    lengths = lengths[lengths > 0]
    flat = machine.step.reshape(-1)
    state = np.full(len(begins), machine.start, np.int64)
    ahead = np.searchsorted(-lengths, -np.arange(int(lengths.max(initial=0))), side="left")
    for t, live in enumerate(ahead.tolist()):
        now = flat[(state[:live] << 8) + data[begins[:live] + t]]
        state[:live] = now
        if (hit := now >= machine.first_hit).any():
            lanes = np.flatnonzero(hit)
            np.bitwise_or.at(found, np.searchsorted(ends, begins[lanes] + t, side="right"), machine.hits[now[lanes]])
    return found.tolist()
