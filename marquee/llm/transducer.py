"""A minimal acyclic transducer: words to id sequences, suffixes shared, readable from a memory map.

States of a minimal acyclic automaton are numbered so that the words reachable
before each arc are counted on it: summing those counts along a word gives the
word's place in sorted order, and the place gives its ids. Words that end alike
share states although their ids differ.
"""

from __future__ import annotations

import mmap
import struct
from collections.abc import Iterable, Sequence

_HEADER = struct.Struct("<6Q")


def compile_words(entries: Iterable[tuple[bytes, Sequence[int]]]) -> bytes:
    """Bytes of the transducer. A word given twice keeps its first ids."""
    table: dict[bytes, Sequence[int]] = {}
    for word, ids in entries:
        table.setdefault(word, ids)
    words = sorted(table)
    root = _minimal(words)
    order, number = [], {}
    stack = [root]
    while stack:
        state = stack.pop()
        if id(state) not in number:
            number[id(state)] = len(order)
            order.append(state)
            stack.extend(state[1].values())
    counts = _counts(root)
    first, final, labels, targets, skips = [0], bytearray(), bytearray(), [], []
    for state in order:
        final.append(state[0])
        before = int(state[0])
        for label in sorted(state[1]):
            child = state[1][label]
            labels.append(label)
            targets.append(number[id(child)])
            skips.append(before)
            before += counts[id(child)]
        first.append(len(labels))
    starts, ids = [0], []
    for word in words:
        ids.extend(table[word])
        starts.append(len(ids))
    parts = [struct.pack(f"<{len(x)}I", *x) for x in (first, targets, skips, starts, ids)] + [bytes(final), bytes(labels)]
    return _HEADER.pack(len(order), len(labels), len(words), len(ids), 0, 0) + b"".join(parts)


def _minimal(words: list[bytes]) -> list:
    """Root of the minimal automaton; a state is [final, arcs]. Words come sorted, so a state that a later
    word cannot extend any more is replaced at once by an equal one if there is one."""
    root: list = [False, {}]
    register: dict[tuple, list] = {}
    path: list[tuple[list, int, list]] = []
    previous = b""

    def settle(depth: int) -> None:
        while len(path) > depth:
            parent, label, child = path.pop()
            key = (child[0], tuple((a, id(b)) for a, b in child[1].items()))
            parent[1][label] = register.setdefault(key, child)

    for word in words:
        common = 0
        while common < min(len(word), len(previous)) and word[common] == previous[common]:
            common += 1
        settle(common)
        state = path[-1][2] if path else root
        for label in word[common:]:
            child: list = [False, {}]
            state[1][label] = child
            path.append((state, label, child))
            state = child
        state[0] = True
        previous = word
    settle(0)
    return root


def _counts(root: list) -> dict[int, int]:
    """Words accepted from each state on."""
    counts: dict[int, int] = {}
    stack = [(root, False)]
    while stack:
        state, done = stack.pop()
        if done:
            counts[id(state)] = int(state[0]) + sum(counts[id(x)] for x in state[1].values())
        elif id(state) not in counts:
            stack.append((state, True))
            stack.extend((x, False) for x in state[1].values())
    return counts


class Transducer:
    """Look words up in a compiled transducer, usually a memory-mapped file."""

    def __init__(self, data: mmap.mmap | bytes) -> None:
        self._data = data
        states, arcs, words, ids, _, _ = _HEADER.unpack_from(data)
        view, at = memoryview(data), _HEADER.size
        columns = []
        for n in (states + 1, arcs, arcs, words + 1, ids):
            columns.append(view[at : at + 4 * n].cast("I"))
            at += 4 * n
        self._first, self._targets, self._skips, self._starts, self._ids = columns
        self._final = view[at : at + states]
        self._labels = at + states
        self.states, self.words = states, words

    @classmethod
    def open(cls, path: str) -> Transducer:
        with open(path, "rb") as file:
            return cls(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))

    def ids(self, word: bytes) -> list[int] | None:
        """Ids of a word; None for a word that is not compiled in."""
        state = place = 0
        labels, first, find = self._labels, self._first, self._data.find
        for i in range(len(word)):
            arc = find(word[i : i + 1], labels + first[state], labels + first[state + 1]) - labels
            if arc < 0:
                return None
            place += self._skips[arc]
            state = self._targets[arc]
        if not self._final[state]:
            return None
        return self._ids[self._starts[place] : self._starts[place + 1]].tolist()
