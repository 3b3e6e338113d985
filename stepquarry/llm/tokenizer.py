"""Encoding of a corpus with a public byte-level BPE tokenizer.

A word's BPE encoding has this property: the encoding of each of its prefixes
ends in exactly one token, and dropping that token leaves the encoding of the
shorter prefix. So one state, the last token, describes a prefix, and the state
of a longer prefix follows from those of its prefixes: it is the one token that
ends there and may stand after the state where it begins (two tokens may stand
side by side if encoding their joined bytes gives just these two).

The distinct words of a batch form a trie. It is walked depth first by taking the
words in order of their bytes: the path to the current node is a stack of states,
and what a word shares with the word before it is kept, so the state of every
shared prefix is computed once. Unlike merging by rank this takes time linear in
the length of a word, so long unbroken runs do no harm.

Encoding is per document and shuffles nothing. Null and empty texts have no ids.
Strings that look like special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Fixed value: how this tokenizer family cuts text into words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
FOLDER = "/opt/tokenizers"
BYTE_BPE_50K = "byte_bpe_50k.tiktoken"
#: Words and token pairs remembered by a worker; more only costs time.
REMEMBERED = 200_000


class ByteBPE:
    """A byte-level BPE vocabulary, given as ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        import regex

        self.ranks = ranks
        self.bytes = {i: b for b, i in ranks.items()}
        self.words = regex.compile(WORDS)
        self.longest = [0] * 256
        for b in ranks:
            self.longest[b[-1]] = max(self.longest[b[-1]], len(b))
        self._pairs: dict[tuple[int, int], bool] = {}
        self._known: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str) -> ByteBPE:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})

    def merged(self, piece: bytes) -> list[int]:
        """The encoding by its definition: again and again join the neighbours of the least rank, leftmost first."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[p] for p in parts]

    def may_follow(self, first: int, second: int) -> bool:
        key = (first, second)
        if key not in self._pairs:
            if len(self._pairs) > REMEMBERED:
                self._pairs.clear()
            self._pairs[key] = self.merged(self.bytes[first] + self.bytes[second]) == [first, second]
        return self._pairs[key]

    def _grow(self, word: bytes, states: list[int], sizes: list[int]) -> None:
        """Extend the states of a prefix of ``word`` to all of it; states[i] is the last token of the first i + 1 bytes."""
        for end in range(len(states) + 1, len(word) + 1):
            for n in range(min(end, self.longest[word[end - 1]]), 0, -1):
                t = self.ranks.get(word[end - n : end])
                if t is not None and (n == end or self.may_follow(states[end - n - 1], t)):
                    states.append(t)
                    sizes.append(n)
                    break

    def encode_words(self, words: list[bytes]) -> dict[bytes, list[int]]:
        """The encodings of distinct words by a depth-first walk of their trie."""
        out, states, sizes, before = {}, [], [], b""
        for word in sorted(words):
            shared = len(os.path.commonprefix((before, word)))
            del states[shared:], sizes[shared:]
            self._grow(word, states, sizes)
            ids, at = [], len(word)
            while at:
                ids.append(states[at - 1])
                at -= sizes[at - 1]
            ids.reverse()
            out[word] = ids
            before = word
        return out

    @staticmethod
    def ids(packed: bytes) -> list[int]:
        return np.frombuffer(packed, "<i4").tolist()

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as packed 32-bit integers."""
        cut = [self.words.findall(t) if t else [] for t in texts]
        fresh = {w for ws in cut for w in ws if w not in self._known}
        if len(self._known) + len(fresh) > REMEMBERED:
            self._known = {}
            fresh = {w for ws in cut for w in ws}
        raw = {w: w.encode("utf-8", "surrogatepass") for w in fresh}
        found = self.encode_words(list(raw.values()))
        known = self._known
        known.update((w, np.array(found[b], "<i4").tobytes()) for w, b in raw.items())
        return [b"".join(map(known.__getitem__, ws)) for ws in cut]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteBPE:
    """The vocabulary, loaded once a worker."""
    return ByteBPE.load(path)


def _chunks(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    t = tokenizer(path)
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            yield part, t.encode_batch(part.column(1).to_pylist())


def encoded(docs: DataFrame, key: str, text: str, *, path: str = f"{FOLDER}/{BYTE_BPE_50K}") -> DataFrame:
    """(key, ids array<int>) of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids in _chunks(batches, path):
            ends = np.cumsum([0, *[len(i) // 4 for i in ids]], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], names=[key, "ids"])

    rows = docs.select(key, text)
    return rows.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, ids array<int>")


def sizes(docs: DataFrame, key: str, text: str, *, path: str = f"{FOLDER}/{BYTE_BPE_50K}") -> DataFrame:
    """(key, n) with the number of ids of every row; the ids stay in the worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids in _chunks(batches, path):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(i) // 4 for i in ids], pa.int64())], names=[key, "n"])

    rows = docs.select(key, text)
    return rows.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, n long")
