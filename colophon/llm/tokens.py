"""Encoding of a corpus with a public byte-level BPE vocabulary (problem 7).

Texts are split by the vocabulary's pattern and each piece is merged with a segment tree over the ranks of adjacent pairs: the
root names the leftmost pair of lowest rank, a merge updates at most three leaves in logarithmic time, and encoding ends when
the root is empty.  A piece of n bytes therefore costs O(n log n), also where a text is one unbroken run of a million
characters.  Pieces recur, so each Python worker keeps the ids of pieces already merged; the store is bounded.

Encoding is a narrow step over the scan: nothing is shuffled.  The vocabulary file is read on the driver's disk and sent to the workers.  Defined results: null and empty texts give an empty list; lone
surrogates are replaced as the JVM replaces them; special-token strings in a text are ordinary text.
"""

from __future__ import annotations

import base64
import json
import os
import re
import sys
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colophon.session import ship_file, shipped

TOKENIZER_DIR = os.environ.get("COLOPHON_TOKENIZERS", "/opt/tokenizers")
STORE_LIMIT = 200_000
STORE_PIECE = 64
_NONE = 1 << 62

# Unicode White_Space, as the vocabulary's pattern means \s
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def _class(kind: str) -> str:
    """A character class with every code point whose general category starts with ``kind``."""
    ranges, start = [], None
    for c in range(sys.maxunicode + 2):
        inside = c <= sys.maxunicode and unicodedata.category(chr(c))[0] == kind
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            ranges.append(f"\\U{start:08x}-\\U{c - 1:08x}" if c - 1 > start else f"\\U{start:08x}")
            start = None
    return "".join(ranges)


def split_pattern() -> re.Pattern:
    letters, numbers = _class("L"), _class("N")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{_WS}{letters}{numbers}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: lines of base64 token and rank, or a tokenizer description in JSON."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
        return {bytes(shown[c] for c in token): rank for token, rank in vocab.items() if all(c in shown for c in token)}
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece, by a segment tree over the ranks of adjacent pairs."""
    n = len(piece)
    if n < 2:
        return [ranks[piece]] if n else []
    shift = n.bit_length()
    mask = (1 << shift) - 1
    parts: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    get = ranks.get
    size = 1 << (n - 2).bit_length()
    # a node holds rank and position in one number, so that the least is the leftmost of the lowest rank
    tree = [_NONE] * (2 * size)
    for i in range(n - 1):
        if (rank := get(piece[i : i + 2])) is not None:
            tree[size + i] = (rank << shift) | i
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    while (root := tree[1]) != _NONE:
        i = root & mask
        j = after[i]
        parts[i] += parts[j]
        parts[j] = None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
        changed = [(j, None), (i, None if k >= n else get(parts[i] + parts[k]))]
        if (h := before[i]) >= 0:
            changed.append((h, get(parts[h] + parts[i])))
        for leaf, rank in changed:
            at = size + leaf
            if at >= 2 * size:
                continue
            new = _NONE if rank is None else (rank << shift) | leaf
            if tree[at] == new:
                continue
            tree[at] = new
            at >>= 1
            while at:
                a, b = tree[2 * at], tree[2 * at + 1]
                least = a if a < b else b
                if tree[at] == least:
                    break
                tree[at] = least
                at >>= 1
    return [ranks[p] for p in parts if p is not None]


class _Store(dict):
    """Ids of what was met before, in two generations: when the young one is full the old one is dropped."""

    def __init__(self, compute: Callable[[str], tuple[int, ...]]) -> None:
        super().__init__()
        self.compute, self.old = compute, {}

    def __missing__(self, key: str) -> tuple[int, ...]:
        ids = self.old.get(key)
        if ids is None:
            ids = self.compute(key)
        if len(key) <= STORE_PIECE:
            if len(self) >= STORE_LIMIT:
                self.old = dict(self)
                self.clear()
            self[key] = ids
        return ids


class Encoder:
    """Splits and merges texts with one vocabulary.

    A space before a character that is no white space always begins a piece, so a text is first cut at such spaces into chunks;
    a chunk is split by the pattern only when it is new to this worker.
    """

    def __init__(self, path: str) -> None:
        self.ranks, self.pattern = load_ranks(path), split_pattern()
        self.uneven = re.compile(f" [{_WS}]| $")
        self.pieces = _Store(self._piece)
        self.chunks = _Store(lambda word: self._chunk(" " + word))

    def _piece(self, piece: str) -> tuple[int, ...]:
        return tuple(merge(piece.encode("utf-8", "replace"), self.ranks))

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(map(self.pieces.__getitem__, self.pattern.findall(chunk))))

    def parts(self, text: str) -> Iterator[tuple[int, ...]]:
        if self.uneven.search(text):
            return map(self.pieces.__getitem__, self.pattern.findall(text))
        first, *rest = text.split(" ")
        return chain((self._chunk(first),), map(self.chunks.__getitem__, rest))


_LOADED: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def _shipped_encoder(name: str) -> Encoder:
    """The encoder of a vocabulary that the driver sent."""
    return encoder(shipped(name))


def encode(text: str | None, path: str) -> list[int]:
    return list(chain.from_iterable(encoder(path).parts(text))) if text else []


def _encode_batches(it: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    parts = _shipped_encoder(name).parts
    for batch in it:
        ids, offsets = array("i"), [0]
        for text in batch.column(1).to_pylist():
            if text:
                ids.extend(chain.from_iterable(parts(text)))
            offsets.append(len(ids))
        values = pa.ListArray.from_arrays(pa.array(np.array(offsets, dtype=np.int32)), pa.array(np.frombuffer(ids, dtype=np.int32) if len(ids) else np.zeros(0, dtype=np.int32)))
        yield pa.RecordBatch.from_arrays([batch.column(0), values], names=[batch.schema.names[0], "ids"])


def _count_batches(it: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    parts = _shipped_encoder(name).parts
    for batch in it:
        counts = [sum(map(len, parts(text))) if text else 0 for text in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(counts, type=pa.int64())], names=[*batch.schema.names[:-1], "n_tokens"])


def vocabulary(name: str, folder: str | None = None) -> str:
    return os.path.join(folder or TOKENIZER_DIR, name)


def encode_corpus(docs: DataFrame, key: str = "doc_id", text: str = "text", vocab: str = "byte_bpe_50k.tiktoken", folder: str | None = None) -> DataFrame:
    """``key`` and ``ids`` of every row."""
    name = ship_file(docs.sparkSession, vocabulary(vocab, folder))
    return docs.select(F.col(key).cast("bigint").alias(key), text).mapInArrow(lambda it: _encode_batches(it, name), f"`{key}` bigint, ids array<int>")


def count_tokens(docs: DataFrame, keep: list[str], text: str = "text", vocab: str = "byte_bpe_50k.tiktoken", folder: str | None = None) -> DataFrame:
    """The columns ``keep`` and ``n_tokens`` of every row."""
    name = ship_file(docs.sparkSession, vocabulary(vocab, folder))
    picked = docs.select(*keep, text)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema[:-1])
    return picked.mapInArrow(lambda it: _count_batches(it, name), f"{ddl}, n_tokens bigint")
