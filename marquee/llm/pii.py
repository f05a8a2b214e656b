"""Personal data by weak supervision.

Four patterns are certain and always reported. Beside them, wider patterns
propose candidates, and labelers vote on each candidate: patterns and checksums,
gazetteers, and the words around it. Expectation-maximisation over the vote
patterns of all documents estimates how reliable each labeler is for each kind,
without labels; its posteriors train a logistic classifier, which decides on the
candidates that the certain patterns left. Only counts of vote patterns, whose
number is bounded by the labelers, reach the driver.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import arrow_schema, per_text
from marquee.session import materialize

# Kinds in the order in which spans with the same start are listed.
KINDS = ("email", "ip", "card", "phone", "ssn", "iban", "name")
# Probability from which a candidate is reported, and characters around it that are read as context.
SURE, CONTEXT = 0.95, 48

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Wider patterns. They begin at a character that ordinary words do not contain, or at a capital.
_OBFUSCATED = re.compile(r" ?(?:\[at\]|\(at\)|\{at\}) ?")
_SPELLED = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?: ?(?:\[dot\]|\(dot\)|\{dot\}) ?|\.)[A-Za-z0-9-]{1,63})+")
_NATIONAL = re.compile(r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])")
_SSN = re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")
_IBAN = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])")
_NAME = re.compile(r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.? [A-Z][a-z]+(?: [A-Z][a-z]+)?")

# Gazetteers: fixed values.
_TOP_LEVEL = frozenset("com org net edu gov info io de fr es it uk us ca au jp eu ch at nl be se no pl".split())
_IBAN_LENGTH = {"DE": 22, "FR": 27, "ES": 24, "IT": 27, "GB": 22, "NL": 18, "CH": 21, "AT": 20, "BE": 16, "PL": 28}
_GIVEN = frozenset(
    "James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Richard Susan Joseph "
    "Jessica Thomas Sarah Charles Karen Anna Peter Paul Maria Hans Pierre Jean Marie Juan Carlos Ana".split()
)

# Words before a candidate that speak for its kind, and words that speak for a plain number.
_FOR = {
    "email": re.compile(r"\b(?:e-?mail|mail|contact|write|address|reach|correo|courriel)\b", re.I),
    "ip": re.compile(r"\b(?:ip|server|host|address|login|from|client|ping)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|mastercard|amex|credit|debit|payment|karte|tarjeta|carte)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|call|mobile|cell|fax|contact|telefon|tel[eé]fono|t[eé]l[eé]phone)\b", re.I),
    "ssn": re.compile(r"\b(?:ssn|social security|taxpayer|tax id)\b", re.I),
    "iban": re.compile(r"\b(?:iban|account|bank|transfer|konto|cuenta|compte)\b", re.I),
    "name": re.compile(r"\b(?:dear|by|author|contact|patient|signed|regards)\b", re.I),
}
_AGAINST = re.compile(r"\b(?:order|invoice|isbn|issn|serial|part|version|build|total|page|chapter|section|figure)\b", re.I)


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        n = ord(digit) - 48
        total += n if place % 2 == 0 else 2 * n - 9 * (n > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def small_parts(address: str) -> bool:
    """Every part of a dotted number is at most 255, however many zeros lead it."""
    parts = (p.lstrip("0") for p in address.split("."))
    return all(len(p) < 4 and int(p or "0") <= 255 for p in parts)


def base_matches(text: str) -> Iterator[tuple[Span, bool]]:
    """Leftmost matches of the four certain patterns, none overlapping another of its kind, and whether each passes its check."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield Span("email", start, m.end()), True
            end = m.end()
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        yield Span("ip", *m.span()), small_parts(m[0])
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            number = _digits(m[0])
            if len(number) >= 14:
                yield Span("card", *m.span()), len(number) <= 19 and luhn(number)
    for m in _PHONE.finditer(text):
        yield Span("phone", *m.span()), 10 <= len(_digits(m[0])) <= 15


def wider_matches(text: str) -> Iterator[Span]:
    """Candidates of the wider patterns."""
    for m in _OBFUSCATED.finditer(text):
        start = m.start()
        while start > max(0, m.start() - 64) and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start() and (right := _SPELLED.match(text, m.end())):
            yield Span("email", start, right.end())
    for kind, pattern in (("phone", _NATIONAL), ("ssn", _SSN), ("iban", _IBAN), ("name", _NAME)):
        for m in pattern.finditer(text):
            yield Span(kind, *m.span())


def _iban_holds(number: str) -> bool:
    """Remainder 97 of the rearranged number, letters counting from 10."""
    return int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1


def votes(text: str, span: Span) -> tuple[int, ...]:
    """Votes of the labelers, 1 for, -1 against, 0 abstaining: pattern, checksum, gazetteer, edges, words around.
    A gazetteer abstains on what it does not list."""
    kind, found = span.kind, text[span.start : span.end]
    before, digits = text[max(0, span.start - CONTEXT) : span.start], _digits(found)
    pattern = checksum = gazetteer = 0
    if kind == "email":
        spelled = re.sub(r" ?[\[({]dot[\])}] ?", ".", _OBFUSCATED.sub("@", found))
        name, _, domain = spelled.partition("@")
        pattern = 1 if name and _DOMAIN.fullmatch(domain) else -1
        gazetteer = 1 if domain.rpartition(".")[2].lower() in _TOP_LEVEL else 0
    elif kind == "ip":
        pattern, checksum = 1, 1 if small_parts(found) else -1
        gazetteer = -1 if found.startswith("0.") else 0
    elif kind == "card":
        pattern, checksum = (1 if 14 <= len(digits) <= 19 else -1), (1 if luhn(digits) else -1)
        gazetteer = 1 if digits[0] in "3456" else 0
    elif kind == "phone":
        pattern = 1 if found[0] == "+" else 0
        checksum = 1 if 10 <= len(digits) <= 15 else -1
        gazetteer = -1 if len(set(digits)) < 3 else 0
    elif kind == "ssn":
        pattern, checksum = 1, -1 if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" else 1
    elif kind == "iban":
        number = found.replace(" ", "")
        pattern = 1 if 15 <= len(number) <= 34 else -1
        listed = _IBAN_LENGTH.get(number[:2])
        checksum = 1 if pattern > 0 and listed in (None, len(number)) and _iban_holds(number) else -1
        gazetteer = 1 if listed == len(number) else 0
    else:
        words = found.split()
        pattern, gazetteer = (1 if len(words) > 2 else 0), (1 if words[1] in _GIVEN else 0)
    left, right = text[span.start - 1 : span.start], text[span.end : span.end + 1]
    edges = -1 if left.isalnum() or right.isalnum() or left in "-_/=#" and left or right in "-_/=@" and right else 1
    around = 1 if _FOR[kind].search(before) else -1 if _AGAINST.search(before) else 0
    return pattern, checksum, gazetteer, edges, around


def scan(text: str | None) -> tuple[list[Span], list[tuple[Span, str, bool]]]:
    """Certain spans, and all candidates with their kind and votes as text, and whether they may be added: not those
    that a certain pattern has decided on."""
    text = text or ""
    base, seen, candidates = [], set(), []
    for span, good in base_matches(text):
        if good:
            base.append(span)
        seen.add(span)
        candidates.append((span, pattern_of(text, span), False))
    for span in wider_matches(text):
        if span not in seen:
            seen.add(span)
            candidates.append((span, pattern_of(text, span), True))
    return base, candidates


def pattern_of(text: str, span: Span) -> str:
    return span.kind + "".join("-0+"[v + 1] for v in votes(text, span))


def ruled_out(pattern: str) -> bool:
    """A failed checksum, or words before it that speak for a plain number, which the classifier cannot outvote."""
    return pattern[CHECKSUM - LABELERS] == "-" or pattern[AROUND - LABELERS] == "-"


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def told(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


# --- the label model and the classifier, over counts of vote patterns ---


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[float, np.ndarray, np.ndarray]:
    """Expectation-maximisation for labelers that are independent given the truth.

    Returns the share of true candidates, the chance of each vote of each labeler (labeler, truth, vote), and
    the posterior of each pattern. It starts from labelers that are right nine times in ten. Pseudo-counts from
    that start, of which a labeler never loses the sense, keep the two classes from trading places."""
    labelers = patterns.shape[1]
    start = np.zeros((labelers, 2, 3))
    start[:, 1] = [0.05, 0.3, 0.65]
    start[:, 0] = [0.65, 0.3, 0.05]
    share, chance, posterior = 0.5, start.copy(), np.full(len(patterns), 0.5)
    places = patterns + 1
    for _ in range(rounds):
        logs = [math.log(p) + np.log(chance[np.arange(labelers), truth][np.arange(labelers), places]).sum(axis=1) for truth, p in ((0, 1 - share), (1, share))]
        fresh = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
        moved, posterior = np.abs(fresh - posterior).max(initial=0.0), fresh
        if moved < 1e-6:
            break
        true, weight = (posterior * counts).sum(), counts.sum()
        share = (true + 10) / (weight + 20)
        for truth, own in ((0, counts * (1 - posterior)), (1, counts * posterior)):
            for labeler in range(labelers):
                seen = np.bincount(places[:, labeler], weights=own, minlength=3)
                # As heavy as all that was seen: a labeler's sense is a stated belief that counts only refine.
                chance[labeler, truth] = (seen + start[labeler, truth] * (20 + seen.sum())) / (20 + 2 * seen.sum())
    return share, chance, posterior


def classifier(patterns: np.ndarray, counts: np.ndarray, posterior: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Logistic weights that follow the posteriors, by Newton steps with a small ridge; the last is the bias."""
    x = np.column_stack([patterns > 0, patterns < 0, np.ones(len(patterns))]).astype(float)
    weights, near = np.zeros(x.shape[1]), np.log1p(counts)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (near * (posterior - p)) - 0.05 * weights
        bend = (x * (near * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(x.shape[1])
        step = np.linalg.solve(bend, slope)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def trained(rows: list[tuple[str, int]]) -> dict[str, float]:
    """Probability of every vote pattern, kind by kind."""
    sure: dict[str, float] = {}
    for kind in KINDS:
        own = [(p, n) for p, n in rows if p[: -LABELERS] == kind]
        if own:
            x = np.array([["-0+".index(c) - 1 for c in p[-LABELERS:]] for p, _ in own])
            n = np.array([n for _, n in own], dtype=float)
            _, _, posterior = reliabilities(x, n)
            weights = classifier(x, n, posterior)
            features = np.column_stack([x > 0, x < 0, np.ones(len(x))]).astype(float)
            sure |= {p: float(v) for (p, _), v in zip(own, 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30))))}
    return sure


# Votes of a pattern, and the places of two of them.
LABELERS, CHECKSUM, AROUND = 5, 1, 4


def find_personal_data(docs: DataFrame, sure: float = SURE) -> DataFrame:
    """Spans of personal data in every whole text, a row for each row.

    Columns: doc_id, n_email, n_ip, n_card, n_phone (certain spans), base_sha256, spans, found (the spans as
    structs). A candidate of the wider patterns is added if the classifier is at least `sure`, it is not `ruled_out`,
    and it overlaps no certain span and no candidate that was added to its left. A null or empty text has no spans;
    repeated rows and null ids are scanned like any other; other columns are not looked at; an empty table gives an empty result.
    """
    span = "struct<kind: string, start: int, end: int>"

    def rows(ids: list, whole: list) -> dict:
        scanned = [scan(text) for text in whole]
        return {
            "doc_id": ids,
            "base": [[s._asdict() for s in in_order(base)] for base, _ in scanned],
            "candidates": [[{"span": s._asdict(), "pattern": p, "open": o} for s, p, o in found] for _, found in scanned],
        }

    schema = f"doc_id bigint, base array<{span}>, candidates array<struct<span: {span}, pattern: string, open: boolean>>"
    read = materialize(per_text(docs, schema, rows), "spans")
    patterns = read.select(F.explode("candidates.pattern").alias("pattern")).groupBy("pattern").agg(F.count("*").alias("n"))
    chance = trained(sorted((r["pattern"], r["n"]) for r in patterns.collect()))
    out = f"doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, found array<{span}>"
    kind = arrow_schema(docs.sparkSession, out)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: dict = {f.name: [] for f in kind}
            for row in batch.to_pylist():
                base = [Span(**s) for s in row["base"]]
                likely = [Span(**c["span"]) for c in row["candidates"] if c["open"] and chance[c["pattern"]] >= sure and not ruled_out(c["pattern"])]
                spans = added(base, likely)
                made["doc_id"].append(row["doc_id"])
                for name in KINDS[:4]:
                    made[f"n_{name}"].append(sum(s.kind == name for s in base))
                made["base_sha256"].append(hashlib.sha256(told(in_order(base)).encode()).hexdigest())
                made["spans"].append(told(spans))
                made["found"].append([s._asdict() for s in spans])
            yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in kind], schema=kind)

    return read.mapInArrow(decide, out)


def added(base: list[Span], likely: list[Span]) -> list[Span]:
    """Certain spans in order, and from left to right the likely ones that overlap no span so far."""
    if not likely:
        return in_order(base)
    likely = in_order(likely)
    starts = sorted((s.start, s.end) for s in base)
    tops = list(accumulate((end for _, end in starts), max))
    kept, end = [], 0
    for span in likely:
        place = bisect_left(starts, (span.end, 0)) - 1
        if span.start >= end and (place < 0 or tops[place] <= span.start):
            kept.append(span)
            end = span.end
    return in_order([*base, *kept])
