"""A small automaton kit: rules as byte expressions, subset construction, minimisation, transition arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# An expression adds states to a list of (moves, empties) and returns its (first, last) state.


class Builder:
    def __init__(self):
        self.moves: list[list[tuple[frozenset, int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1


def one(chars: str):
    """One byte out of ``chars``."""
    wanted = frozenset(chars.encode())

    def add(b: Builder):
        first, last = b.state(), b.state()
        b.moves[first].append((wanted, last))
        return first, last

    return add


def seq(*parts):
    def add(b: Builder):
        ends = [p(b) for p in parts]
        for (_, x), (y, _) in zip(ends, ends[1:]):
            b.empty[x].append(y)
        return ends[0][0], ends[-1][1]

    return add


def alt(*parts):
    def add(b: Builder):
        first, last = b.state(), b.state()
        for p in parts:
            x, y = p(b)
            b.empty[first].append(x)
            b.empty[y].append(last)
        return first, last

    return add


def opt(part):
    def add(b: Builder):
        x, y = part(b)
        b.empty[x].append(y)
        return x, y

    return add


def many(part):
    """``part`` any number of times, also none."""

    def add(b: Builder):
        first, last = b.state(), b.state()
        x, y = part(b)
        b.empty[first] += [x, last]
        b.empty[y] += [x, last]
        return first, last

    return add


def some(part):
    return seq(part, many(part))


def at_least(part, n: int):
    return seq(*[part] * n, many(part))


def word(text: str, any_case: bool = False):
    return seq(*[one(c.lower() + c.upper() if any_case else c) for c in text])


@dataclass
class Automaton:
    """``table[state * classes + kind[byte]]`` is the next state times ``classes``. State 0 is dead, ``start`` begins."""

    table: np.ndarray
    classes: int
    kind: bytes
    start: int
    accepting: np.ndarray  # by state

    def rows(self) -> list[list[int]]:
        return (self.table.reshape(-1, self.classes) // self.classes).tolist()


def compile_rules(rules: list, anywhere: bool) -> Automaton:
    """One deterministic minimal automaton for all ``rules``.

    ``anywhere``: a match may begin at any byte and the accepting state is kept once reached, so the state after
    the last byte tells whether the text holds a match of any rule. Otherwise a match begins at the first byte.
    """
    b = Builder()
    ends = [r(b) for r in rules]
    finals, firsts = {y for _, y in ends}, [x for x, _ in ends]
    kind, sample = _byte_classes(b)
    n = len(sample)
    closed = _closure(b.empty)
    begin = closed(firsts)
    step = [[[y for s, y in b.moves[x] if byte in s] for byte in sample] for x in range(len(b.moves))]
    dead = frozenset()
    done = frozenset(["match"])
    ids, order, out = {dead: 0, begin: 1}, [dead, begin], []
    at = 0
    while at < len(order):
        here, line = order[at], []
        for c in range(n):
            if here == done:
                target = done
            else:
                target = closed([y for x in here for y in step[x][c]]) if here else dead
                if anywhere:
                    target = done if target & finals or here & finals else (target | begin if at else dead)
            if target not in ids:
                ids[target] = len(order)
                order.append(target)
            line.append(ids[target])
        out.append(line)
        at += 1
    table = np.array(out, dtype=np.int64)
    accepting = np.array([s == done or bool(s & finals) for s in order])
    label, first = _minimised(table, accepting.astype(np.int64))
    small = label[table[first]]
    return Automaton((small * n).astype(np.int32).reshape(-1), n, kind, int(label[1]), accepting[first])


def compile_starts(rules: list) -> tuple[Automaton, list[tuple[int, ...]]]:
    """One minimal automaton for reading a text backwards, and for each state the rules that have a match beginning there.

    The transitions of all rules are turned round, and a match may end at any byte.
    """
    b = Builder()
    ends = [r(b) for r in rules]
    kind, sample = _byte_classes(b)
    empty: list[list[int]] = [[] for _ in b.moves]
    back: list[list[tuple]] = [[] for _ in b.moves]
    for x, (moves, free) in enumerate(zip(b.moves, b.empty, strict=True)):
        for y in free:
            empty[y].append(x)
        for s, y in moves:
            back[y].append((s, x))
    closed = _closure(empty)
    begin = closed([y for _, y in ends])
    step = [[[y for s, y in back[x] if byte in s] for byte in sample] for x in range(len(back))]
    dead: frozenset = frozenset()
    ids, order, out = {dead: 0, begin: 1}, [dead, begin], []
    at = 0
    while at < len(order):
        line = []
        for c in range(len(sample)):
            target = closed([y for x in order[at] for y in step[x][c]]) | begin if at else dead
            if target not in ids:
                ids[target] = len(order)
                order.append(target)
            line.append(ids[target])
        out.append(line)
        at += 1
    table = np.array(out, dtype=np.int64)
    marks = [tuple(i for i, (x, _) in enumerate(ends) if x in s) for s in order]
    kinds = {m: i for i, m in enumerate(dict.fromkeys(marks))}
    label, first = _minimised(table, np.array([kinds[m] for m in marks]))
    small = label[table[first]]
    found = [marks[i] for i in first]
    auto = Automaton((small * len(sample)).astype(np.int32).reshape(-1), len(sample), kind, int(label[1]), np.array([bool(m) for m in found]))
    return auto, found


def _byte_classes(b: Builder) -> tuple[bytes, list[int]]:
    """The class of each byte, and one byte of each class; bytes that no rule tells apart share one."""
    ordered = sorted({s for moves in b.moves for s, _ in moves}, key=sorted)
    groups: dict[tuple, int] = {}
    kind, sample = bytearray(256), []
    for byte in range(256):
        mark = tuple(byte in s for s in ordered)
        if mark not in groups:
            groups[mark] = len(groups)
            sample.append(byte)
        kind[byte] = groups[mark]
    return bytes(kind), sample


def _closure(empty: list[list[int]]):
    def closed(states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for y in empty[todo.pop()]:
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
        return frozenset(seen)

    return closed


def _minimised(table: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of each state and a first state of each class, the dead state in class 0.

    Classes are refined by what their states accept, then by the classes that the successors lie in, until nothing splits.
    """
    while True:
        _, new = np.unique(np.column_stack([label, label[table]]), axis=0, return_inverse=True)
        new = new.reshape(-1)
        if new.max() == len(np.unique(label)) - 1:
            break
        label = new
    label = new
    number = np.full(label.max() + 1, -1)
    number[label[0]] = 0
    rest = [x for x in range(label.max() + 1) if x != label[0]]
    number[rest] = np.arange(1, len(rest) + 1)
    label = number[label]
    return label, np.unique(label, return_index=True)[1]


def matching_lanes(auto: Automaton, buffer: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each lane ``buffer[start : start + length]`` whether an ``anywhere`` automaton ends in a match.

    All lanes advance together, one byte a step, longest first; the few longest are finished one by one.
    """
    n = auto.classes
    codes = np.frombuffer(buffer.translate(auto.kind), dtype=np.uint8)
    order = np.argsort(-lengths, kind="stable")
    begin, size = starts[order], lengths[order]
    state = np.full(len(order), auto.start * n, dtype=np.int32)
    falling = -size
    step = 0
    while step < (size[0] if len(size) else 0):
        active = int(np.searchsorted(falling, -step, side="left"))
        if active < 24:
            rows = auto.rows()
            for i in range(active):
                s = int(state[i]) // n
                for c in codes[begin[i] + step : begin[i] + size[i]].tobytes():
                    s = rows[s][c]
                state[i] = s * n
            break
        state[:active] = auto.table[state[:active] + codes[begin[:active] + step]]
        step += 1
    out = np.empty(len(order), dtype=bool)
    out[order] = auto.accepting[state // n]
    return out


def longest(rows: list[list[int]], accepting: list[bool], codes: bytes, at: int, start: int) -> int:
    """End of the longest match that begins at ``at``; -1 without one."""
    s, end = start, -1
    for i in range(at, len(codes)):
        s = rows[s][codes[i]]
        if not s:
            break
        if accepting[s]:
            end = i + 1
    return end
