"""Rule regexes as one deterministic automaton over bytes.

``compile_rules`` parses each regex, makes a nondeterministic automaton of it, and joins all of them by
subset construction into one automaton, which is then minimised and kept as a transition array.  A
state says for every rule whether a match holds after this byte (``claimed``) and whether it is the
first byte at which it does (``fresh``), so one pass over the bytes gives the leftmost, longest,
non-overlapping matches of every rule.

Within a rule the threads of a state are kept in the order of their starts: a match ends all that
started later, as leftmost matching wants, and where it can go on no further the next one is looked for.
One pass suffices if a rule, once it matches, matches on until it cannot go on, and if no later start
matches while an earlier one is still open.  Both are checked for every state; other rules raise ValueError.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from re import _constants as K, _parser

import numpy as np

#: A buffer is cut into lanes of about this many bytes, which go through the automaton side by side.
LANE = 512
#: The last so many lanes go one after the other.
FEW = 12


@dataclass(frozen=True)
class Rule:
    """A kind of match: the regex (bytes), and the least length of the whole match, or of its part from
    the first byte at which it holds (``tail``)."""

    kind: str
    regex: bytes
    least: int = 1
    tail: bool = False


class Nfa:
    """States 0 (start) to ``end``; ``moves`` holds (state, mask of bytes, state), ``free`` moves without a byte."""

    def __init__(self, regex: bytes):
        self.moves: list[tuple[int, int, int]] = []
        self.free: list[tuple[int, int]] = []
        self.size = 1
        tree = _parser.parse(regex)
        self.end = self._chain(tree, 0, bool(tree.state.flags & re.IGNORECASE))

    def _new(self) -> int:
        self.size += 1
        return self.size - 1

    def _chain(self, items, at: int, fold: bool) -> int:
        for op, arg in items:
            at = self._item(op, arg, at, fold)
        return at

    def _item(self, op, arg, at: int, fold: bool) -> int:
        if op in (K.LITERAL, K.NOT_LITERAL, K.ANY, K.IN):
            to = self._new()
            self.moves.append((at, _mask(op, arg, fold), to))
            return to
        if op is K.SUBPATTERN:
            _, added, removed, inner = arg
            return self._chain(inner, at, (fold or bool(added & re.IGNORECASE)) and not removed & re.IGNORECASE)
        if op is K.BRANCH:
            to = self._new()
            for way in arg[1]:
                first = self._new()
                self.free.append((at, first))
                self.free.append((self._chain(way, first, fold), to))
            return to
        if op is K.MAX_REPEAT:
            least, most, inner = arg
            for _ in range(least):
                at = self._chain(inner, at, fold)
            if most is K.MAXREPEAT:
                first = self._new()
                self.free.append((at, first))
                self.free.append((self._chain(inner, first, fold), first))
                return first
            to = self._new()
            for _ in range(most - least):
                self.free.append((at, to))
                at = self._chain(inner, at, fold)
            self.free.append((at, to))
            return to
        raise ValueError(f"a rule cannot have {op}")

    def reversed(self) -> "Nfa":
        """The automaton of the reversed strings; its start is ``end``, its end 0."""
        out = object.__new__(Nfa)
        out.moves = [(b, m, a) for a, m, b in self.moves]
        out.free = [(b, a) for a, b in self.free]
        out.size, out.end = self.size, 0
        return out

    def closed(self, states) -> frozenset[int]:
        out, todo = set(states), list(states)
        while todo:
            s = todo.pop()
            for a, b in self.free:
                if a == s and b not in out:
                    out.add(b)
                    todo.append(b)
        return frozenset(out)

    def step(self, states: frozenset[int], byte: int) -> frozenset[int]:
        return self.closed({b for a, m, b in self.moves if a in states and m >> byte & 1})


def _mask(op, arg, fold: bool) -> int:
    """The bytes of a character class as bits of a number."""
    if op is K.ANY:
        return ~(1 << 10) & ((1 << 256) - 1)
    items = arg if op is K.IN else [(K.LITERAL, arg)]
    mask, negate = 0, op is K.NOT_LITERAL
    for kind, value in items:
        if kind is K.NEGATE:
            negate = True
        elif kind is K.LITERAL:
            mask |= 1 << value
        elif kind is K.RANGE:
            mask |= (1 << value[1] + 1) - (1 << value[0])
        else:
            raise ValueError(f"a rule cannot have {kind}")
    if fold:
        for low in range(97, 123):
            if mask >> low & 1 or mask >> low - 32 & 1:
                mask |= 1 << low | 1 << low - 32
    return ~mask & ((1 << 256) - 1) if negate else mask


class _RuleStates:
    """The states of one rule: (claimed, fresh, threads in the order of their starts)."""

    START = (False, False, ())

    def __init__(self, rule: Rule):
        self.rule, self.nfa = rule, Nfa(rule.regex)
        self.first = self.nfa.closed({0})
        if self.nfa.end in self.first:
            raise ValueError(f"rule {rule.kind} matches nothing at all")
        self.known: dict = {}

    def step(self, state, byte: int):
        """The state after ``byte``; ``byte`` stands for its class."""
        if (state, byte) not in self.known:
            self.known[state, byte] = self._step(state, byte)
        return self.known[state, byte]

    def _step(self, state, byte: int):
        claimed, _, threads = state
        if claimed:
            on = self.nfa.step(threads[0], byte)
            if on:
                if self.nfa.end not in on:
                    raise ValueError(f"rule {self.rule.kind} may go on without matching")
                return True, False, (on,)
            threads = ()
        after, seen = [], set()
        for t in (*threads, self.first):
            t = self.nfa.step(t, byte) - seen
            if t:
                after.append(frozenset(t))
                seen |= t
        at = next((i for i, t in enumerate(after) if self.nfa.end in t), None)
        if at is None:
            return False, False, tuple(after)
        if at > 0:
            raise ValueError(f"rule {self.rule.kind} matches from a later start while an earlier one is open")
        return True, True, (after[0],)


class Automaton:
    """The automaton of some rules.  ``table`` maps state * ``width`` + class of a byte to the next state
    * ``width``; states from ``first_claimed`` on hold a match of some rule."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = list(rules)
        parts = [_RuleStates(r) for r in self.rules]
        masks = sorted({m for p in parts for _, m, _ in p.nfa.moves})
        signs = {b: tuple(m >> b & 1 for m in masks) for b in range(256)}
        names = {s: i for i, s in enumerate(dict.fromkeys(signs.values()))}
        self.classes = np.array([names[signs[b]] for b in range(256)], np.uint8)
        self.width = len(names)
        members = [int(np.flatnonzero(self.classes == c)[0]) for c in range(self.width)]

        start = tuple(_RuleStates.START for _ in parts)
        number, rows, todo = {start: 0}, [], [start]
        for state in todo:  # grows while it is walked over
            row = []
            for b in members:
                to = tuple(p.step(s, b) for p, s in zip(parts, state))
                if to not in number:
                    number[to] = len(number)
                    todo.append(to)
                row.append(number[to])
            rows.append(row)
        claimed = np.array([sum(r[0] << i for i, r in enumerate(s)) for s in todo], np.int64)
        fresh = np.array([sum(r[1] << i for i, r in enumerate(s)) for s in todo], np.int64)
        self.states_before = len(todo)
        self._minimised(np.array(rows), claimed, fresh)
        self.backward = [_Backward(p.nfa) for p in parts]

    def _minimised(self, rows: np.ndarray, claimed: np.ndarray, fresh: np.ndarray) -> None:
        """Merge states that no string tells apart: parts by output, split by the parts of the successors."""
        part = np.unique(np.stack([claimed, fresh], 1), axis=0, return_inverse=True)[1].ravel()
        count = part.max() + 1
        while True:
            part = np.unique(np.column_stack([part, part[rows]]), axis=0, return_inverse=True)[1].ravel()
            if part.max() + 1 == count:
                break
            count = part.max() + 1
        _, member = np.unique(part, return_index=True)
        # The start is state 0, states with a match come last.
        order = np.lexsort([np.arange(count), np.arange(count) != part[0], claimed[member] != 0])
        place = np.empty(count, np.int64)
        place[order] = np.arange(count)
        member = member[order]
        self.claimed, self.fresh = claimed[member], fresh[member]
        table = place[part[rows[member]]]
        self.count = int(count)
        self.first_claimed = int((self.claimed == 0).sum()) * self.width
        self.table = (table * self.width).astype(np.int32).ravel()
        #: Classes of bytes after which the state is the same whatever it was before.
        self.resets = (table == table[0]).all(axis=0)

    def walk(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions at which some rule holds, in order, and the states there.  ``codes`` are the classes of
        the bytes of some texts, which begin at ``starts``."""
        n = len(codes)
        resets = np.flatnonzero(self.resets[codes])
        near = np.searchsorted(resets, np.arange(LANE, n, LANE))
        begin = np.union1d(resets[near[near < len(resets)]], starts[starts < n])
        size = np.diff(np.append(begin, n))
        order = np.argsort(-size, kind="stable")
        begin, size = begin[order], size[order]
        alive = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")
        state = np.zeros(len(begin), np.int32)
        at, states, t = [], [], 0
        for t, k in enumerate(alive.tolist()):
            if k <= FEW:
                break
            here = begin[:k] + t
            state = self.table[state[:k] + codes[here]]
            hit = np.flatnonzero(state >= self.first_claimed)
            if len(hit):
                at.append(here[hit])
                states.append(state[hit])
        else:
            t = len(alive)
        table = memoryview(self.table)
        for i in range(int(alive[t]) if t < len(alive) else 0):
            s, lane, lane_states = int(state[i]), [], []
            for p, c in enumerate(codes[begin[i] + t:begin[i] + size[i]].tobytes(), int(begin[i]) + t):
                s = table[s + c]
                if s >= self.first_claimed:
                    lane.append(p)
                    lane_states.append(s)
            at.append(np.array(lane, np.int64))
            states.append(np.array(lane_states, np.int64))
        if not at:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, states = np.concatenate(at), np.concatenate(states)
        order = np.argsort(at, kind="stable")
        return at[order], states[order] // self.width

    def matches(self, buf: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, rule, start, end) of every match, in bytes of the text; those under the rule's least length are
        left out, though their bytes are taken.  ``buf`` holds the texts, which begin at ``starts``."""
        at, states = self.walk(self.classes[buf], starts)
        out = []
        for r, rule in enumerate(self.rules):
            own = np.flatnonzero(self.claimed[states] >> r & 1)
            first = np.flatnonzero(self.fresh[states[own]] >> r & 1)
            if not len(first):
                continue
            opened = at[own[first]]
            ends = at[own[np.append(first[1:], len(own)) - 1]] + 1
            text = np.searchsorted(starts, opened, side="right") - 1
            floor, of = 0, -1
            for f, e, t in zip(opened.tolist(), ends.tolist(), text.tolist()):
                base = int(starts[t])
                floor = floor if t == of else base
                start = self.backward[r].start(buf, f, floor)
                floor, of = e, t
                if e - (f if rule.tail else start) >= rule.least:
                    out.append((t, r, start - base, e - base))
        return out


class _Backward:
    """Finds where a match starts from the byte at which it first holds: the longest reversed match."""

    def __init__(self, nfa: Nfa):
        self.nfa = nfa.reversed()
        self.first = self.nfa.closed({nfa.end})
        self.known: dict = {}

    def start(self, buf: np.ndarray, at: int, floor: int) -> int:
        states, best = self.first, at
        while at >= floor:
            key = states, int(buf[at])
            if key not in self.known:
                self.known[key] = self.nfa.step(*key)
            states = self.known[key]
            if not states:
                break
            if 0 in states:
                best = at
            at -= 1
        return best
