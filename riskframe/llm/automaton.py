"""Byte automata: regexes to one minimised deterministic automaton for all rules, and its scan.

Regexes know literals, escapes (``\\xHH``, ``\\d``, ``\\w``, ``\\s`` or a quoted sign), classes,
groups, ``|``, ``?``, ``*``, ``+`` and ``{m,n}``; a leading ``(?i)`` takes ASCII letters in either case.
"""

from __future__ import annotations

import re

import numpy as np

#: Byte between texts: it occurs in no UTF-8 text and leads every automaton back to its start.
GAP = 0xFF

_TOKEN = re.compile(rb"\\x[0-9A-Fa-f]{2}|\\.|\[\^?\]?(?:\\x[0-9A-Fa-f]{2}|\\.|[^\]\\])*\]|\{\d+(?:,\d*)?\}|\(\?:|.", re.S)
_SETS = {b"d": b"0123456789", b"s": b" \t\n\v\f\r", b"w": b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz"}


def _escape(t: bytes) -> frozenset[int]:
    if t[1:2] == b"x" and len(t) == 4:
        return frozenset([int(t[2:], 16)])
    return frozenset(_SETS.get(t[1:], t[1:]))


def _byte_class(t: bytes) -> frozenset[int]:
    inner = t[1:-1]
    negate = inner[:1] == b"^"
    parts = re.findall(rb"\\x[0-9A-Fa-f]{2}|\\.|.", inner[negate:], re.S)
    out: set[int] = set()
    k = 0
    while k < len(parts):
        one = _escape(parts[k]) if parts[k][:1] == b"\\" else frozenset(parts[k])
        if k + 2 < len(parts) and parts[k + 1] == b"-" and len(one) == 1:
            end = _escape(parts[k + 2]) if parts[k + 2][:1] == b"\\" else frozenset(parts[k + 2])
            out |= set(range(min(one), min(end) + 1))
            k += 3
        else:
            out |= one
            k += 1
    return frozenset(range(GAP)) - out if negate else frozenset(out)


class Nfa:
    """States with byte moves and empty moves; built from regexes, forwards or backwards."""

    def __init__(self) -> None:
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def add(self, regex: str, backwards: bool = False) -> tuple[int, int]:
        """Start and end state of ``regex``."""
        raw = regex.encode()
        either = raw.startswith(b"(?i)")
        tokens, at = _TOKEN.findall(raw[4:] if either else raw), 0

        def peek() -> bytes:
            return tokens[at] if at < len(tokens) else b""

        def choice():
            nonlocal at
            parts = [sequence()]
            while peek() == b"|":
                at += 1
                parts.append(sequence())
            return ("or", parts) if len(parts) > 1 else parts[0]

        def sequence():
            nonlocal at
            parts = []
            while peek() not in (b"", b"|", b")"):
                node = atom()
                while peek()[:1] in (b"?", b"*", b"+") or peek()[:1] == b"{" and len(peek()) > 1:
                    t = tokens[at]
                    at += 1
                    low, high = {b"?": (0, 1), b"*": (0, None), b"+": (1, None)}.get(t, (None, None))
                    if low is None:
                        low, _, top = t[1:-1].partition(b",")
                        low, high = int(low), int(top) if top else None if b"," in t else int(low)
                    node = ("repeat", node, low, high)
                parts.append(node)
            return ("and", parts)

        def atom():
            nonlocal at
            t = tokens[at]
            at += 1
            if t in (b"(", b"(?:"):
                node = choice()
                at += 1
                return node
            got = _byte_class(t) if t[:1] == b"[" and len(t) > 1 else _escape(t) if t[:1] == b"\\" else frozenset(range(GAP)) - {10} if t == b"." else frozenset(t)
            if either:
                got |= frozenset(c ^ 32 for c in got if 65 <= c <= 90 or 97 <= c <= 122)
            return ("bytes", got)

        def build(node, start: int) -> int:
            kind = node[0]
            if kind == "bytes":
                end = self.state()
                self.moves[start].append((node[1], end))
                return end
            if kind == "and":
                for x in node[1][::-1] if backwards else node[1]:
                    start = build(x, start)
                return start
            if kind == "or":
                end = self.state()
                for x in node[1]:
                    self.empty[build(x, self.fork(start))].append(end)
                return end
            _, inner, low, high = node
            for _ in range(low):
                start = build(inner, start)
            if high is None:
                loop = self.fork(start)
                self.empty[build(inner, loop)].append(loop)
                return loop
            end = self.state()
            for _ in range(high - low):
                self.empty[start].append(end)
                start = build(inner, start)
            self.empty[start].append(end)
            return end

        first = self.state()
        return first, build(choice(), first)

    def fork(self, start: int) -> int:
        s = self.state()
        self.empty[start].append(s)
        return s

    def closure(self, states: set[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for x in self.empty[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)


class Dfa:
    """Transition array ``table[state, byte]`` and ``accept[state]``, the set of rules found there.

    Accepting states come last, from ``first_accept`` on; state 0 is the start.
    """

    def __init__(self, table: np.ndarray, accept: list[frozenset[int]], first_accept: int):
        self.table, self.accept, self.first_accept = table, accept, first_accept


def compile_rules(regexes: list[str], backwards: bool = False, anywhere: bool = False) -> Dfa:
    """Subset construction over all rules, then minimisation by refining classes of states.

    ``backwards`` takes each regex reversed; ``anywhere`` lets matches begin at every byte.
    """
    nfa = Nfa()
    ends: dict[int, int] = {}
    start = nfa.state()
    for k, regex in enumerate(regexes):
        first, end = nfa.add(regex, backwards)
        nfa.empty[start].append(first)
        ends[end] = k
    # bytes that no move tells apart share a class
    masks: list[list[int]] = [[] for _ in range(256)]
    for m, got in enumerate({got for moves in nfa.moves for got, _ in moves}):
        for b in got:
            masks[b].append(m)
    kinds: dict[tuple, int] = {}
    kind_of = np.array([kinds.setdefault(tuple(m), len(kinds)) for m in masks])
    sample = {k: int(np.flatnonzero(kind_of == k)[0]) for k in range(len(kinds))}

    begin = nfa.closure({start})
    numbers, sets, rows = {begin: 0}, [begin], []
    for states in sets:
        row = []
        for k in range(len(kinds)):
            b = sample[k]
            to = {t for s in states for got, t in nfa.moves[s] if b in got}
            closed = nfa.closure(to | ({start} if anywhere else set()))
            if closed not in numbers:
                numbers[closed] = len(sets)
                sets.append(closed)
            row.append(numbers[closed])
        rows.append(row)
    accept = [frozenset(ends[s] for s in states if s in ends) for states in sets]
    table = np.array(rows)
    found: dict[frozenset[int], int] = {}
    classes = np.array([found.setdefault(a, len(found)) for a in accept])
    while True:
        new = np.unique(np.column_stack([classes, classes[table]]), axis=0, return_inverse=True)[1].ravel()
        if new.max() == classes.max():
            break
        classes = new
    n = int(classes.max()) + 1
    of = np.zeros(n, int)
    of[classes] = np.arange(len(classes))
    order = sorted(range(n), key=lambda c: (bool(accept[of[c]]), c != classes[0]))
    place = np.empty(n, int)
    place[order] = np.arange(n)
    small = place[classes[table[of[order]]]][:, kind_of]
    marks = [accept[of[c]] for c in order]
    if place[classes[0]] != 0:
        raise ValueError("a rule matches the empty text")
    small[:, GAP] = 0
    return Dfa(small.astype(np.int32), marks, next((i for i, m in enumerate(marks) if m), n))


def scan_backwards(dfa: Dfa, buffer: np.ndarray, lanes: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Byte places (ascending) at which the automaton accepts, read from the end, and its states there.

    The buffer is cut into lanes that are stepped together, each from the start state. A lane's true
    first state is the last state of the lane after it, so lanes are stepped again from there until
    they fall in with what was computed; automata that forget quickly need a few bytes of it.
    """
    n = len(buffer)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    lanes = max(1, min(lanes, n // 64 or 1))
    width = -(-n // lanes)
    cells = np.full(lanes * width, GAP, np.uint8)
    cells[:n] = buffer
    columns = np.ascontiguousarray(cells.reshape(lanes, width).T)
    table = (dfa.table * 256).ravel()
    states = np.empty((width, lanes), np.int32)
    state = np.zeros(lanes, np.int32)
    for i in range(width - 1, -1, -1):
        state = table[state + columns[i]]
        states[i] = state
    ends = states[0]
    first = np.concatenate([ends[1:], [0]]).astype(np.int32)  # state before each lane's last byte
    moved = np.flatnonzero(first != 0)
    while len(moved):
        live, state = moved, first[moved]
        old_ends = states[0].copy()
        for i in range(width - 1, -1, -1):
            state = table[state + columns[i, live]]
            differs = state != states[i, live]
            live, state = live[differs], state[differs]
            if not len(live):
                break
            states[i, live] = state
        changed = np.flatnonzero(states[0] != old_ends) - 1  # lanes that end elsewhere than before
        moved = changed[changed >= 0]
        first = np.concatenate([states[0][1:], [0]]).astype(np.int32)
    found = states >= dfa.first_accept * 256
    at, lane = np.nonzero(found)
    place = lane * width + at
    order = np.argsort(place, kind="stable")
    return place[order], states[at, lane][order] // 256


class Anchored:
    """Longest match from a given place, by an automaton of one rule."""

    def __init__(self, regex: str):
        dfa = compile_rules([regex])
        self.rows, self.first_accept = dfa.table.tolist(), dfa.first_accept
        self.dead = next((s for s, row in enumerate(self.rows) if not dfa.accept[s] and set(row[:GAP]) == {s}), -1)

    def end(self, raw: bytes, start: int) -> int:
        """End of the longest match from ``start``, or -1."""
        rows, state, end = self.rows, 0, -1
        for i in range(start, len(raw)):
            state = rows[state][raw[i]]
            if state == self.dead:
                break
            if state >= self.first_accept:
                end = i + 1
        return end
