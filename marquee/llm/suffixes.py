"""Suffix order of a shard by induced sorting, with queues that go to disk.

Suffixes are taken from queues, one for each first symbol, in the order of the
symbols. A suffix taken from its queue tells the place of the suffix one symbol
longer, which joins the queue of its own first symbol; within a queue they come
in order, so the queues together are a priority queue of (symbol, order)
tuples. Everything moves in whole arrays, and queues that exceed a budget are
written to a temporary file. Ordering all suffixes needs the order of the few
that follow a descent; those are named by their own substrings, ordered the same
way, and the string of names is ordered by recursion, or by doubling once names
are too many for a queue each.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

# Places that the queues of a shard hold in memory, and the most symbols that are given a queue each.
QUEUE_PLACES, QUEUE_SYMBOLS = 1 << 24, 1 << 10


class Queues:
    """A queue of places for each symbol, first in first out; beyond a budget they wait on disk."""

    def __init__(self, symbols: int, budget: int = QUEUE_PLACES) -> None:
        self._waiting: list[list[np.ndarray]] = [[] for _ in range(symbols)]
        self._on_disk: dict[int, list[tuple[int, int]]] = {}
        self._file, self._held, self._budget = None, 0, budget

    def put(self, symbols: np.ndarray, places: np.ndarray) -> None:
        """Append places to the queues of their symbols, keeping their order."""
        if not len(places):
            return
        order = np.argsort(symbols, kind="stable")
        symbols, places = symbols[order], places[order]
        cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
        for symbol, part in zip(symbols[np.concatenate(([0], cuts))].tolist(), np.split(places, cuts)):
            self._waiting[symbol].append(part)
        self._held += len(places)
        if self._held > self._budget:
            self._write()

    def _write(self) -> None:
        if self._file is None:
            self._file = tempfile.TemporaryFile()
        self._file.seek(0, os.SEEK_END)
        for symbol, parts in enumerate(self._waiting):
            if parts:
                joined = np.concatenate(parts)
                self._on_disk.setdefault(symbol, []).append((self._file.tell(), len(joined)))
                self._file.write(joined.tobytes())
                parts.clear()
        self._held = 0

    def take(self, symbol: int) -> Iterator[np.ndarray]:
        """Places of a queue in order until it is empty, also those put while it is taken."""
        while self._on_disk.get(symbol) or self._waiting[symbol]:
            for at, n in self._on_disk.pop(symbol, []):
                self._file.seek(at)
                yield np.frombuffer(self._file.read(8 * n), dtype=np.int64)
            if self._waiting[symbol] and not self._on_disk.get(symbol):
                parts = self._waiting[symbol]
                self._waiting[symbol] = []
                self._held -= sum(map(len, parts))
                yield from parts

    def close(self) -> None:
        if self._file is not None:
            self._file.close()


def ascending(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last is, as nothing follows it but the end."""
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])
    out = np.ones(n, dtype=bool)
    if len(change):
        # A run of one symbol goes as its end does.
        rises = text[change] < text[change + 1]
        runs = np.diff(np.concatenate(([-1], change)))
        out[: change[-1] + 1] = np.repeat(rises, runs)
    out[change[-1] + 1 if len(change) else 0 :] = False
    out[n - 1] = True
    return out


def _induce(text: np.ndarray, rising: np.ndarray, seeds: np.ndarray, symbols: int, budget: int) -> np.ndarray:
    """All places ordered by suffix, from the ordered places after a descent (`seeds`, the end of the text first)."""
    falling: list[np.ndarray] = []
    end, seeds = seeds[:1], seeds[1:]
    starts = np.searchsorted(text[seeds], np.arange(symbols + 1))
    queues = Queues(symbols, budget)

    def before(places: np.ndarray, kind: bool) -> None:
        places = places[places > 0] - 1
        places = places[rising[places] == kind]
        queues.put(text[places], places)

    before(end, False)
    for symbol in range(symbols):
        found = []
        for places in queues.take(symbol):
            found.append(places)
            before(places, False)
        falling.append(np.concatenate(found) if found else np.zeros(0, dtype=np.int64))
        before(seeds[starts[symbol] : starts[symbol + 1]], False)
    queues.close()
    queues = Queues(symbols, budget)
    out: list[np.ndarray] = []
    for symbol in range(symbols - 1, -1, -1):
        found = []
        for places in queues.take(symbol):
            found.append(places)
            before(places, True)
        back = falling[symbol][::-1]
        before(back, True)
        out.extend([*found, back])
    # The end of the text is the least suffix of all; nothing induces it.
    out.append(end)
    queues.close()
    return np.concatenate(out)[::-1]


def suffix_order(text: np.ndarray, depth: int | None = None, budget: int = QUEUE_PLACES) -> np.ndarray:
    """Places of `text` ordered by their suffixes. Symbols count from 0; the last one must be 0 and may occur
    before. With a depth, suffixes that agree on that many symbols may stand in either order."""
    n = len(text)
    if n < 3:
        return np.arange(n - 1, -1, -1, dtype=np.int64)
    symbols = int(text.max()) + 1
    rising = ascending(text)
    seed = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    if not len(seed) or seed[-1] != n - 1:
        seed = np.append(seed, n - 1)
    first = seed[np.argsort(text[seed[:-1]], kind="stable")] if len(seed) > 1 else seed[:0]
    order = _induce(text, rising, np.concatenate((seed[-1:], first)), symbols, budget)
    is_seed = np.zeros(n, dtype=bool)
    is_seed[seed] = True
    sorted_seeds = order[is_seed[order]]
    names = _names(text, seed, sorted_seeds)
    if names.max() + 1 < len(names):
        most = None if depth is None else depth // 2 + 1
        if names.max() < QUEUE_SYMBOLS and len(names) < n and names[-1] == 0:
            inner = suffix_order(names, most, budget)
        else:
            inner = doubled(names, most)
        sorted_seeds = seed[inner]
    return _induce(text, rising, sorted_seeds, symbols, budget)


def _names(text: np.ndarray, seed: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Rank of the substring from each seed to the next, equal ones sharing a rank, in text order."""
    place = np.zeros(len(text), dtype=np.int64)
    place[seed] = np.arange(len(seed))
    index = place[ordered]
    lengths = np.append(np.diff(seed) + 1, 1)[index]
    same = np.concatenate(([False], lengths[1:] == lengths[:-1]))
    pending = np.flatnonzero(same)
    offset = 0
    while len(pending):
        equal = text[ordered[pending] + offset] == text[ordered[pending - 1] + offset]
        same[pending[~equal]] = False
        offset += 1
        pending = pending[equal & (lengths[pending] > offset)]
    names = np.empty(len(seed), dtype=np.int64)
    names[index] = np.cumsum(~same) - 1
    return names


def doubled(names: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Suffix order of a string of ranks by ordering pairs of ranks at twice the distance each time."""
    n, rank, step = len(names), names.astype(np.int64), 1
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[: n - step] = rank[step:] + 1 if step < n else 0
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        fresh = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = fresh
        step *= 2
        if fresh[-1] == n - 1 or step >= n or (depth is not None and step >= depth):
            return order


def equal_groups(data: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Number of the group of each of the ordered places: neighbours whose common prefix reaches `length` share one.

    Each place has at least `length` bytes after it; `data` has eight bytes to spare at its end."""
    same = np.ones(max(0, len(places) - 1), dtype=bool)
    words = np.ndarray(shape=(len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    for offset in [*range(0, length - 8, 8), length - 8]:
        word = words[places + offset]
        same &= word[1:] == word[:-1]
    return np.concatenate(([0], np.cumsum(~same))) if len(places) else np.zeros(0, dtype=np.int64)
