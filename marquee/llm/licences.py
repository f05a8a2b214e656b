"""Licence spans by matching statistics against a generalised suffix automaton of licence words.

The automaton holds every run of words that occurs in any template or phrase.
Reading a text word by word gives at each word the longest run that ends there
and occurs in a template. Long runs of one template that follow each other, in
the text and in the template, are chained; a chain that covers enough of its
template is a span. A phrase is found wherever the automaton stands in a state
that ends with it, so its places are exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame

from marquee.llm.common import per_text

# Phrases that alone name a licence.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Passages of well-known licences and of the notices they ask for.
TEMPLATES = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so",
    ),
    "apache": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "This is an open access article distributed under the terms of the Creative Commons Attribution License",
    ),
    "cc-by-nc": ("licensed under a Creative Commons Attribution NonCommercial 4.0 International License", "licensed under CC BY NC 4.0"),
    "cc-by-sa": ("licensed under a Creative Commons Attribution ShareAlike 4.0 International License", "licensed under CC BY SA 4.0"),
}

# Words a run must have to be chained, words that may lie between two runs, and the share of a template to be covered.
LONG_RUN = 4
GAP = 12
COVERED = 0.6

# Lower-case letters, digits and all bytes of other letters stay; A-Z become lower case; the rest separates words.
_KEEP = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_KEEP).split()


class Run(NamedTuple):
    start: int  # word in the text
    length: int
    state: int


class Automaton:
    """Generalised suffix automaton over sequences of words."""

    def __init__(self, sequences: Iterable[Sequence[bytes]]) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[dict[int, int]] = [{}]  # sequence: the first place where a run of this state ends in it
        for number, sequence in enumerate(sequences):
            last = 0
            for place, word in enumerate(sequence):
                last = self._extend(last, word)
                self.ends[last].setdefault(number, place + 1)
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            parent = self.link[state]
            if parent > 0:
                for number, place in self.ends[state].items():
                    known = self.ends[parent].get(number)
                    self.ends[parent][number] = place if known is None else min(known, place)

    def _state(self, length: int, link: int, arcs: dict[bytes, int]) -> int:
        self.next.append(arcs)
        self.link.append(link)
        self.length.append(length)
        self.ends.append({})
        return len(self.link) - 1

    def _split(self, parent: int, word: bytes) -> int:
        """State for the runs of `parent` followed by `word`, no longer ones."""
        state = self.next[parent][word]
        if self.length[state] == self.length[parent] + 1:
            return state
        copy = self._state(self.length[parent] + 1, self.link[state], dict(self.next[state]))
        self.link[state] = copy
        while parent >= 0 and self.next[parent].get(word) == state:
            self.next[parent][word] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new

    def step(self, state: int, length: int, word: bytes) -> tuple[int, int]:
        """State and length of the longest run that ends with this word."""
        while state and word not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        target = self.next[state].get(word)
        return (target, length + 1) if target is not None else (0, 0)


class Scanner:
    """Phrases and template spans of a text."""

    def __init__(self, phrases: Mapping[str, str], templates: Mapping[str, Sequence[str]]) -> None:
        self.phrases = [(tuple(words(p)), label) for p, label in phrases.items()]
        self.templates = [(tuple(words(t)), label) for label, texts in templates.items() for t in texts]
        sequences = [s for s, _ in [*self.phrases, *self.templates]]
        self.automaton = Automaton(sequences)
        self.vocabulary = {w: w for s in sequences for w in s}
        ends: dict[int, list[tuple[int, int]]] = {}
        for number, (phrase, _) in enumerate(self.phrases):
            state = 0
            for word in phrase:
                state = self.automaton.next[state][word]
            ends.setdefault(state, []).append((number, len(phrase)))
        #: Phrases that are suffixes of a state's longest run.
        self.phrase_ends: list[list[tuple[int, int]]] = []
        for state in range(len(self.automaton.link)):
            found, at = [], state
            while at > 0:
                found += ends.get(at, [])
                at = self.automaton.link[at]
            self.phrase_ends.append(found)

    def scan(self, found: list[bytes]) -> tuple[list[tuple[int, str]], list[tuple[str, int, int, float]]]:
        """Places of phrases as (first word, label); spans as (label, first word, end, covered share)."""
        places: list[tuple[int, str]] = []
        runs: list[Run] = []
        step, ends = self.automaton.step, self.phrase_ends
        state = length = 0
        before = -2
        for i, word in [(i, w) for i, w in enumerate(map(self.vocabulary.get, found)) if w is not None]:
            if i != before + 1:
                if length >= LONG_RUN:
                    runs.append(Run(before + 1 - length, length, state))
                state = length = 0
            was = (state, length)
            state, length = step(state, length, word)
            if was[1] >= LONG_RUN and length <= was[1]:
                runs.append(Run(i - was[1], was[1], was[0]))
            for number, size in ends[state]:
                if length >= size:
                    places.append((i + 1 - size, self.phrases[number][1]))
            before = i
        if length >= LONG_RUN:
            runs.append(Run(before + 1 - length, length, state))
        return places, self._spans(runs) if runs else []

    def _spans(self, runs: list[Run]) -> list[tuple[str, int, int, float]]:
        """Chains of runs, one open chain for each template, in one pass over the runs."""
        spans, first = [], len(self.phrases)
        chains: dict[int, list[int]] = {}  # template: first word, end, template place reached, words covered

        def close(number: int) -> None:
            start, end, _, covered = chains.pop(number)
            template, label = self.templates[number]
            if covered >= COVERED * len(template):
                spans.append((label, start, end, min(1.0, covered / len(template))))

        for run in runs:
            for sequence, place in self.automaton.ends[run.state].items():
                number = sequence - first
                if number < 0:
                    continue
                chain, end = chains.get(number), run.start + run.length
                if chain is not None:
                    # Words that the chain already holds, in the text or in the template, count once.
                    fresh = min(end - chain[1], place - chain[2], run.length)
                    if fresh > 0 and run.start <= chain[1] + GAP:
                        chains[number] = [chain[0], end, place, chain[3] + fresh]
                        continue
                    if run.start <= chain[1] + GAP and end <= chain[1]:
                        continue
                    close(number)
                chains[number] = [run.start, end, place, run.length]
        for number in list(chains):
            close(number)
        return sorted(spans, key=lambda s: (s[1], s[2], s[0]))


def scan_licences(
    docs: DataFrame, phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, Sequence[str]] = TEMPLATES
) -> DataFrame:
    """Licences named in or quoted by every whole text, a row for each row.

    Columns: doc_id, n_words, n_base (places of phrases), first_word and last_word (their smallest and largest
    start, null if none), base_labels, labels (both sorted, distinct, comma-joined), score (1 with a phrase,
    else the share of the best covered template, 0 without a span), spans (label, start, end, covered).
    A null or empty text has no words and no labels; repeated rows and null ids are scanned like any other;
    other columns are not looked at; an empty table gives an empty result.
    """
    scanner = Scanner(phrases, templates)

    def rows(ids: list, whole: list) -> dict:
        names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")
        out: dict = {"doc_id": ids} | {n: [] for n in names}
        for text in whole:
            found = words(text)
            places, spans = scanner.scan(found)
            base = {label for _, label in places}
            out["n_words"].append(len(found))
            out["n_base"].append(len(places))
            out["first_word"].append(min((p for p, _ in places), default=None))
            out["last_word"].append(max((p for p, _ in places), default=None))
            out["base_labels"].append(",".join(sorted(base)))
            out["labels"].append(",".join(sorted(base | {s[0] for s in spans})))
            out["score"].append(1.0 if base else max((s[3] for s in spans), default=0.0))
            out["spans"].append([dict(zip(("label", "start", "end", "covered"), s)) for s in spans])
        return out

    return per_text(
        docs,
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
        "labels string, score double, spans array<struct<label: string, start: bigint, end: bigint, covered: double>>",
        rows,
    )
