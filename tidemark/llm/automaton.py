"""Regular expressions as one deterministic automaton that reports leftmost, non-overlapping matches of every rule.

Each rule is parsed to an NFA over bytes and made deterministic by subset construction. A state keeps the attempts of
a search apart by where they began, oldest first, so that the automaton itself decides which match is leftmost. The
product of all rules is then minimised. Its transitions carry the few actions that happen on the way (an attempt's
start is fixed, the tail of a match begins, a match ends), so that a scan looks at each byte once.

Rules must end in a run (a repeated class or a fixed end), so that a match is over exactly where it cannot go on; a
rule for which that does not hold is refused when it is compiled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from re import _constants as ops
from re import _parser as parser

import numpy as np

START, TAIL, END = range(3)


@dataclass(frozen=True)
class Rule:
    """``pattern`` is ASCII; of its matches those stay that have ``min_length`` characters, and ``min_tail`` from
    where the match became complete (its last repeated class)."""

    kind: str
    pattern: str
    ignore_case: bool = False
    min_length: int = 0
    min_tail: int = 0


class _Nfa:
    def __init__(self, rule: Rule):
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[int, int]]] = []  # (set of bytes as a bit mask, next)
        self.ignore_case = rule.ignore_case
        first = self._state()
        self.accept = self._add(parser.parse(rule.pattern), first)
        self.start = self.closure({first})

    def _state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def _cased(self, mask: int) -> int:
        if self.ignore_case:
            for low in range(97, 123):
                if mask >> low & 1 or mask >> (low - 32) & 1:
                    mask |= 1 << low | 1 << (low - 32)
        return mask

    def _add(self, items, at: int) -> int:
        for op, arg in items:
            if op is ops.LITERAL:
                at = self._step(at, 1 << arg)
            elif op is ops.IN:
                at = self._step(at, _class_mask(arg))
            elif op is ops.SUBPATTERN:
                at = self._add(arg[3], at)
            elif op is ops.BRANCH:
                end = self._state()
                for branch in arg[1]:
                    self.empty[self._add(branch, at)].append(end)
                at = end
            elif op is ops.MAX_REPEAT:
                at = self._repeat(*arg, at)
            else:
                raise ValueError(f"{op} is not supported in a rule")
        return at

    def _step(self, at: int, mask: int) -> int:
        end = self._state()
        self.moves[at].append((self._cased(mask), end))
        return end

    def _repeat(self, least: int, most: int, items, at: int) -> int:
        for _ in range(least):
            at = self._add(items, at)
        if most == ops.MAXREPEAT:
            loop = self._state()
            self.empty[at].append(loop)
            self.empty[self._add(items, loop)].append(loop)
            return loop
        end = self._state()
        self.empty[at].append(end)
        for _ in range(most - least):
            at = self._add(items, at)
            self.empty[at].append(end)
        return end

    def closure(self, states: set[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(s for s in seen if self.moves[s] or s == self.accept)

    def move(self, states: frozenset[int], byte: int) -> frozenset[int]:
        return self.closure({t for s in states for mask, t in self.moves[s] if mask >> byte & 1})


def _class_mask(items) -> int:
    mask, negate = 0, False
    for op, arg in items:
        if op is ops.NEGATE:
            negate = True
        elif op is ops.LITERAL:
            mask |= 1 << arg
        elif op is ops.RANGE:
            mask |= sum(1 << c for c in range(arg[0], arg[1] + 1))
        else:
            raise ValueError(f"{op} is not supported in a class")
    return ((1 << 256) - 1) & ~mask if negate else mask


class _Search:
    """The deterministic search of one rule. A state is its attempts, oldest first, as sets of NFA states."""

    def __init__(self, rule: Rule, samples: list[int]):
        self.rule, self.nfa = rule, _Nfa(rule)
        self.index: dict[tuple, int] = {(): 0}
        self.states: list[tuple] = [()]
        # next state, which attempt each new attempt comes from (-1: begins here), whether a match ends before
        self.next: list[list[tuple[int, tuple[int, ...], bool]]] = []
        while len(self.next) < len(self.states):
            self.next.append([self._step(self.states[len(self.next)], byte) for byte in samples])
        self.done = [self._complete(s) for s in self.states]
        self.ages = self._ages()

    def _complete(self, state: tuple) -> bool:
        return bool(state) and self.nfa.accept in state[0]

    def _step(self, state: tuple, byte: int, ended: bool = False) -> tuple[int, tuple[int, ...], bool]:
        complete = self._complete(state)
        attempts = list(enumerate(state)) + ([] if complete else [(-1, self.nfa.start)])
        new, sources, seen = [], [], set()
        for source, states in attempts:
            moved = self.nfa.move(states, byte) - seen
            if moved:
                new.append(frozenset(moved))
                sources.append(source)
                seen |= moved
        if complete and not new:
            return self._step((), byte, True)
        matched = [i for i, states in enumerate(new) if self.nfa.accept in states]
        if matched and matched[0] > 0 or complete and not matched:
            raise ValueError(f"rule {self.rule.kind}: where a match ends must be known at its last byte")
        if matched:
            new, sources = new[:1], sources[:1]
        key = tuple(new)
        if key not in self.index:
            self.index[key] = len(self.states)
            self.states.append(key)
        return self.index[key], tuple(sources), ended

    def _ages(self) -> list[list[int | None]]:
        """Bytes since each attempt of a state began, None where that differs from way to way."""
        ages: list[list] = [[-1] * len(s) for s in self.states]
        changed = True
        while changed:
            changed = False
            for s, row in enumerate(self.next):
                if s and -1 in ages[s]:
                    continue
                for t, sources, _ in row:
                    for k, source in enumerate(sources):
                        before = 0 if source < 0 else ages[s][source]
                        age = None if before is None else before + 1
                        old = ages[t][k]
                        if old is not None and old != age:
                            # A loop makes it grow without end; two values are enough to know.
                            ages[t][k] = age if old == -1 else None
                            changed = True
        if any(age is None for state in ages for age in state[1:]):
            raise ValueError(f"rule {self.rule.kind}: two attempts of unknown length at once")
        return ages

    def actions(self, s: int, c: int) -> list[tuple[int, int]]:
        """What happens on a transition, in order, as (action, argument); START has the attempt's age before."""
        t, sources, ended = self.next[s][c]
        out = [(END, 0)] if ended else []
        if sources and self.ages[t][0] is None:
            before = 0 if sources[0] < 0 else self.ages[s][sources[0]]
            if before is not None:
                out.append((START, before))
        elif self.done[t] and (ended or not self.done[s]):
            out.append((START, self.ages[t][0] - 1))
        if self.done[t] and (ended or not self.done[s]):
            out.append((TAIL, 0))
        return out


class Automaton:
    """All rules in one automaton; ``scan`` reports their matches in one pass over the bytes."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = tuple(rules)
        classes = _byte_classes(self.rules)
        samples = [int(np.flatnonzero(classes == c)[0]) for c in range(classes.max() + 1)]
        searches = [_Search(r, samples) for r in self.rules]
        index = {(0,) * len(searches): 0}
        states, step, acts = list(index), [], []
        known: dict[tuple, int] = {(): 0}
        while len(step) < len(states):
            state = states[len(step)]
            row, row_acts = [], []
            for c in range(len(samples)):
                target = tuple(q.next[s][c][0] for q, s in zip(searches, state, strict=True))
                happens = tuple(
                    (r, *a) for r, (q, s) in enumerate(zip(searches, state, strict=True)) for a in q.actions(s, c)
                )
                if target not in index:
                    index[target] = len(states)
                    states.append(target)
                row.append(index[target])
                row_acts.append(known.setdefault(happens, len(known)))
            step.append(row)
            acts.append(row_acts)
        finals = [tuple(r for r, (q, s) in enumerate(zip(searches, x, strict=True)) if q.done[s]) for x in states]
        self._minimise(np.array(step), np.array(acts), finals, classes, list(known))

    def _minimise(self, step, acts, finals, classes, happens) -> None:
        """Merge states that no text tells apart, by refining a partition until it is stable."""
        block = np.unique(np.array([hash(f) for f in finals]), return_inverse=True)[1]
        count = 0
        while True:
            rows = np.concatenate([block[:, None], block[step], acts], axis=1)
            block = np.unique(rows, axis=0, return_inverse=True)[1].ravel()
            if block.max() + 1 == count:
                break
            count = block.max() + 1
        first = np.unique(block, return_index=True)[1]
        self.step = block[step[first]][:, classes].astype(np.int32)
        self.acts = acts[first][:, classes].astype(np.int32)
        self.finals = [finals[i] for i in first]
        self.happens = happens
        self.start = int(block[0])
        self._rows = None

    def _linked(self) -> list:
        """Rows that hold the next rows themselves; element 256 of a row has the actions of the way into it."""
        if self._rows is None:
            rows: dict[tuple[int, int], list] = {}
            pairs = {(self.start, 0)} | set(zip(self.step.ravel().tolist(), self.acts.ravel().tolist(), strict=True))
            for state, act in pairs:
                rows[state, act] = [None] * 256 + [self.happens[act] or None, self.finals[state]]
            for (state, _), row in rows.items():
                row[:256] = [rows[k] for k in zip(self.step[state].tolist(), self.acts[state].tolist(), strict=True)]
            self._rows = rows[self.start, 0]
        return self._rows

    def __getstate__(self):
        return self.__dict__ | {"_rows": None}

    def scan(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes of every match that is long enough, by start and then rule."""
        row = self._linked()
        start, tail = [0] * len(self.rules), [0] * len(self.rules)
        found: list[tuple[int, int, int]] = []

        def end(rule: int, at: int) -> None:
            r = self.rules[rule]
            if at - start[rule] >= r.min_length and at - tail[rule] >= r.min_tail:
                found.append((start[rule], rule, at))

        for i, byte in enumerate(data):
            row = row[byte]
            if row[256]:
                for rule, action, arg in row[256]:
                    if action == START:
                        start[rule] = i - arg
                    elif action == TAIL:
                        tail[rule] = i
                    else:
                        end(rule, i)
        for rule in row[257]:
            end(rule, len(data))
        found.sort()
        return found


def _byte_classes(rules: Sequence[Rule]) -> np.ndarray:
    """The class of each byte: bytes that no rule tells apart share one."""
    masks = {mask for r in rules for moves in _Nfa(r).moves for mask, _ in moves}
    columns = np.array([[mask >> b & 1 for mask in masks] for b in range(256)])
    return np.unique(columns, axis=0, return_inverse=True)[1].ravel()


def reference_matches(rules: Sequence[Rule], text: str) -> Iterator[tuple[int, int, int]]:
    """The same matches by Python's own engine, for tests."""
    for i, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text, re.I if rule.ignore_case else 0):
            tail = m.start(m.lastindex) if m.lastindex else m.start()
            if m.end() - m.start() >= rule.min_length and m.end() - tail >= rule.min_tail:
                yield m.start(), i, m.end()
