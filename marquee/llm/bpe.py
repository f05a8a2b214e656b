"""Byte-level BPE encoding and decoding with a compiled lexicon of frequent words.

One pass counts the stretches between spaces in all texts. The words of the most
frequent ones are encoded once on the driver and compiled into a minimal acyclic
transducer, which every executor fetches and memory-maps. The second pass encodes whole texts: a word
comes from the transducer, and a word that is not in it is merged by the
vocabulary's ranks. What the lexicon holds changes the speed, never the ids.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import per_text, publish, texts
from marquee.llm.transducer import Transducer, compile_words
from marquee.session import materialize

# The most stretches whose words are compiled, and how often one must occur to be thought of.
LEXICON_WORDS, FREQUENT = 65_536, 4
# Stretches and words whose ids an encoding worker remembers.
MEMO_PIECES, MEMO_WORDS = 600_000, 200_000

LONG_WORD = 128
_NONE, _ID = 1 << 62, (1 << 32) - 1

# Fixed value: how byte-level BPE of this kind splits a text into words.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# A space beside other white space: only there does a split at each space differ from WORDS.
UNEVEN = regex.compile(r" \s|\s ")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Merges, bytes and special tokens of a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letters, model = byte_letters(), content["model"]
        raw = {token: bytes(letters[c] for c in token) for token in model["vocab"]}
        known = {i: raw[token] for token, i in model["vocab"].items()}
        self.first = [0] * 256
        for token, i in model["vocab"].items():
            if len(raw[token]) == 1:
                self.first[raw[token][0]] = i
        # Rank and id of the merged pair in one number, so that the least number is the pair to merge.
        self.merges: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[model["vocab"][a], model["vocab"][b]] = rank << 32 | model["vocab"][a + b]
        self.special = {x["content"]: x["id"] for x in content["added_tokens"]}
        known |= {i: text.encode() for text, i in self.special.items()}
        self.bytes_of = [known.get(i, b"") for i in range(max(known) + 1)]
        self._cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def merge(self, word: bytes) -> list[int]:
        """Ids of a word: the adjacent pair of lowest rank is merged, leftmost first, until none is left."""
        ids = [self.first[b] for b in word]
        if len(ids) > LONG_WORD:
            return self._merge_long(ids)
        get = self.merges.get
        offers = [get(pair, _NONE) for pair in zip(ids, ids[1:])]
        while offers:
            best = min(offers)
            if best == _NONE:
                break
            i = offers.index(best)
            ids[i : i + 2] = [best & _ID]
            del offers[i]
            if i:
                offers[i - 1] = get((ids[i - 1], ids[i]), _NONE)
            if i < len(offers):
                offers[i] = get((ids[i], ids[i + 1]), _NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a queue of pairs, for words of any length."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[int, int, int, int]] = []  # pair, place, and the ids it was offered for

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (m := self.merges.get((ids[i], ids[j]))):
                heapq.heappush(queue, (m, i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i)
        while queue:
            pair, i, a, b = heapq.heappop(queue)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = pair & _ID, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]

    def parts(self, text: str) -> Iterator[str | int]:
        """Ordinary stretches of a text and the ids of special tokens between them."""
        at = 0
        for m in self._cut.finditer(text) if self._cut else ():
            if m.start() > at:
                yield text[at : m.start()]
            yield self.special[m[0]]
            at = m.end()
        if at < len(text):
            yield text[at:]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary a worker process."""
    return Vocabulary(path)


def pieces(text: str) -> list[str]:
    """Stretches of whole words: the text cut before each space, or at every word if its white space is uneven."""
    if UNEVEN.search(text):
        return WORDS.findall(text)
    cut = text.split(" ")
    return cut[:1] * bool(cut[0]) + [" " + x for x in cut[1:]]


def piece_counts(docs: DataFrame) -> DataFrame:
    """Stretches between spaces in all texts, with counts."""
    stretches = texts(docs).select(F.explode(F.split("text", " ")).alias("piece"))
    return stretches.filter("piece <> ''").groupBy("piece").agg(F.count("*").alias("n"))


def frequent_pieces(docs: DataFrame, most: int) -> list[str]:
    """At most `most` stretches, all those from some count on; the count comes from a histogram of fixed size."""
    counts = piece_counts(docs).filter((F.col("n") >= FREQUENT) & (F.length("piece") <= LONG_WORD))
    counts = materialize(counts.withColumn("size", F.floor(8 * F.log2("n"))), "pieces")
    left, least = most, None
    for row in counts.groupBy("size").agg(F.count("*").alias("n")).orderBy(F.desc("size")).collect():
        left -= row["n"]
        if left < 0:
            break
        least = row["size"]
    return [] if least is None else sorted(r["piece"] for r in counts.filter(F.col("size") >= least).select("piece").collect())


def compile_lexicon(docs: DataFrame, path: str, words: int = LEXICON_WORDS) -> str:
    """Publish the transducer of the words in the most frequent stretches, at most `words` of which reach the driver."""
    vocab = vocabulary(path)
    known = dict.fromkeys(w for piece in frequent_pieces(docs, words) for w in WORDS.findall(" " + piece))
    return publish(docs.sparkSession, "lexicon", compile_words((w, vocab.merge(w)) for w in map(str.encode, known)))


class _Recent(dict):
    """Remembers what `find` gives for about the last `size` to twice as many keys; keys longer than LONG_WORD never."""

    def __init__(self, find: Callable[[str], bytes], size: int) -> None:
        self.find, self.size, self.older = find, size, {}

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.find(key)
        if len(key) <= LONG_WORD:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[key] = found
        return found


class Encoder:
    """Packed ids of pieces, from memory, the transducer or the merges."""

    def __init__(self, vocab: Vocabulary, lexicon: Transducer) -> None:
        self.vocab, self.lexicon = vocab, lexicon
        self.words = _Recent(self._word, MEMO_WORDS)
        self.pieces = _Recent(self._piece, MEMO_PIECES)

    def _word(self, word: str) -> bytes:
        raw = word.encode()
        ids = self.lexicon.ids(raw)
        if ids is None:
            ids = self.vocab.merge(raw)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        if piece[0] == " ":
            if piece[1:].isalpha():  # a space and letters are one word
                return self._word(piece)
            if piece[-1] in ".," and piece[1:-1].isalpha():
                return self.pieces[piece[:-1]] + self.words[piece[-1]]
        return b"".join(map(self.words.__getitem__, WORDS.findall(piece)))

    def packed(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for part in self.vocab.parts(text):
            if isinstance(part, int):
                out.append(struct.pack("<I", part))
            else:
                out.extend(map(self.pieces.__getitem__, pieces(part)))
        return b"".join(out)


@lru_cache(maxsize=1)
def encoder(path: str, lexicon: str) -> Encoder:
    """A worker process serves many tasks; they share what it remembers."""
    return Encoder(vocabulary(path), Transducer.open(SparkFiles.get(lexicon)))


def encode(docs: DataFrame, path: str | None = None, keep_ids: bool = True) -> DataFrame:
    """Encode every whole text and decode the ids again, a row for each row.

    Columns: doc_id, ids array<int> (if kept), n_tokens, ids_sha256, decoded_sha256. A null text counts as
    empty and has no ids; rows with a null or repeated doc_id are encoded like any other; other columns
    are not looked at; an empty table gives an empty result.
    """
    path = path or default_tokenizer()
    lexicon = compile_lexicon(docs, path)

    def rows(ids: list, whole: list) -> dict:
        known = encoder(path, lexicon)
        out: dict = {"doc_id": ids, "ids": [], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for text in whole:
            packed = known.packed(text or "")
            numbers = memoryview(packed).cast("I").tolist()
            out["ids"].append(numbers if keep_ids else None)
            out["n_tokens"].append(len(numbers))
            out["ids_sha256"].append(hashlib.sha256(packed).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(known.vocab.decode(numbers).encode()).hexdigest())
        return out

    columns = "ids array<int>, " if keep_ids else ""
    return per_text(docs, f"doc_id bigint, {columns}n_tokens bigint, ids_sha256 string, decoded_sha256 string", rows)
