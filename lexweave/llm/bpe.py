"""Byte-level BPE encoding with public vocabularies (problems 2 and 6).

Texts are cut into pre-tokens by the vocabulary's public pattern; each distinct pre-token is encoded once per worker and
remembered in a bounded table. A pre-token is merged with a hierarchical-bitmap rank queue: one bucket of linked-list
positions per merge rank, a three-level bitmap over the ranks, find-first-set to get the least rank, and a test on
taking a position out that skips entries made stale by other merges. A merge makes only pairs of greater rank than its
own, so a bucket is complete when it is opened and is worked off from left to right. The cost is n log n in the length
of the pre-token, also for a pre-token of a whole page.

Defined results: a null and an empty text give no ids; special tokens' strings are ordinary text; lone surrogates cannot
occur in Spark strings; every other text is encoded whole.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.partitioning import spread

#: Where vocabularies are looked for unless a path is given.
TOKENIZER_DIR = "/opt/tokenizers"

#: Pre-token pattern of the byte-level vocabularies (fixed value).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"

#: Distinct words and pre-tokens remembered by a worker before it starts anew.
MEMO_LIMIT = 400_000


class RankQueue:
    """Least-rank-first queue of linked-list positions: buckets by rank under a three-level bitmap."""

    __slots__ = ("buckets", "leaf", "mid", "top")

    def __init__(self) -> None:
        self.buckets: dict[int, list[int]] = {}
        self.top = 0
        self.mid: dict[int, int] = {}
        self.leaf: dict[int, int] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(position)
            return
        self.buckets[rank] = [position]
        a, b = rank >> 6, rank >> 12
        self.leaf[a] = self.leaf.get(a, 0) | 1 << (rank & 63)
        self.mid[b] = self.mid.get(b, 0) | 1 << (a & 63)
        self.top |= 1 << b

    def pop(self) -> tuple[int, list[int]] | None:
        """The least rank and its positions, in order; None if there are none."""
        if not self.top:
            return None
        b = (self.top & -self.top).bit_length() - 1
        m = self.mid[b]
        a = b << 6 | (m & -m).bit_length() - 1
        w = self.leaf[a]
        rank = a << 6 | (w & -w).bit_length() - 1
        if w := w & w - 1:
            self.leaf[a] = w
        else:
            del self.leaf[a]
            if m := m & m - 1:
                self.mid[b] = m
            else:
                del self.mid[b]
                self.top &= self.top - 1
        return rank, sorted(self.buckets.pop(rank))


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token."""
    n = len(piece)
    end = list(range(1, n + 1))  # end[i]: where the symbol that starts at i ends, 0 once it is merged into its left
    left = list(range(-1, n - 1))  # start of the symbol before the one at i
    queue = RankQueue()
    for i in range(n - 1):
        if (r := ranks.get(piece[i : i + 2])) is not None:
            queue.push(r, i)
    while (least := queue.pop()) is not None:
        rank, positions = least
        for i in positions:
            j = end[i]
            if not j or j >= n or ranks.get(piece[i : end[j]]) != rank:
                continue  # stale
            end[i] = k = end[j]
            end[j] = 0
            if k < n:
                left[k] = i
                if (r := ranks.get(piece[i : end[k]])) is not None:
                    queue.push(r, i)
            if (p := left[i]) >= 0 and (r := ranks.get(piece[p:k])) is not None:
                queue.push(r, p)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


class _Memo(dict):
    """A bounded dictionary that fills itself from a function; long keys are not kept."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> bytes:
        out = self.make(key)
        if len(key) <= 64:
            if len(self) >= MEMO_LIMIT:
                self.clear()
            self[key] = out
        return out


class Encoder:
    """Encodes texts; ids come as the bytes of int32 numbers, which join and turn into Arrow without Python integers.

    Between two spaces the pattern never joins what stands on both sides of a single space, so a text without double
    spaces and without a space at its end is looked up by its space-delimited words; any other is cut by the pattern.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.split = regex.compile(PATTERN).findall
        self.tokens = _Memo(self._token)
        self.words = _Memo(lambda word: self._cut(" " + word))

    def _token(self, token: str) -> bytes:
        raw = token.encode("utf-8")
        whole = self.ranks.get(raw)
        return np.array([whole] if whole is not None else merge(raw, self.ranks), np.int32).tobytes()

    def _cut(self, text: str) -> bytes:
        return b"".join(map(self.tokens.__getitem__, self.split(text)))

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as the bytes of int32 numbers."""
        if not text:
            return b""
        if "  " in text or text[-1] == " ":
            return self._cut(text)
        first, *rest = text.split(" ")
        return self._cut(first) + b"".join(map(self.words.__getitem__, rest))


@lru_cache(maxsize=4)
def ranks_of(path: str) -> dict[bytes, int]:
    """Merge ranks of a vocabulary file: a line has a token in base 64 and its rank."""
    with Path(path).open("rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file."""
    return Encoder(ranks_of(path))


def vocabulary(name: str = "byte_bpe_50k", directory: str = TOKENIZER_DIR) -> str:
    """Path of a public vocabulary in ``directory``."""
    return str(Path(directory) / f"{name}.tiktoken")


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids) of every row of ``df``, ids an array of integers; rows and repeated keys stay as they are."""
    kind = df.select(key).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            found = [enc.encode(t) for t in batch.column(1).to_pylist()]
            offsets = np.zeros(len(found) + 1, np.int32)
            np.cumsum([len(x) >> 2 for x in found], out=offsets[1:])
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[key, "ids"])

    return spread(df.select(key, text)).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def count_tokens(text: Column, path: str) -> Column:
    """Number of ids of a text, 0 for null and empty ones."""

    @F.arrow_udf("int")
    def counted(texts: pa.Array) -> pa.Array:
        enc = encoder(path)
        return pa.array([len(enc.encode(t)) >> 2 for t in texts.to_pylist()], pa.int32())

    return counted(text)
