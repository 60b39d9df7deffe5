"""Evaluation items that leak into documents (problem 7).

A run of ``FORMULA_WORDS`` words that stands in at least ``FORMULA_ITEMS`` different items is a formula and not an item's
own; runs are counted over all items. The own words are cut into windows of ``WINDOW`` words, one at every word, as are the
documents. A window is embedded by the CGK random walk: at each of ``3 * WINDOW`` steps the current word is written down
and a random bit of step and word says whether to move on, so windows at a small edit distance come to lie at a small
Hamming distance. Bit-sampling LSH reads ``BITS`` of the written words for each of ``SAMPLES`` keys of each of ``WALKS``
walks; an equal key makes a (document, item) pair a candidate. Windows of which more than ``EDITS`` words are in no item
cannot be within that edit distance of an item's window and are passed over. Windows are pieces of an item, not whole
items, because a leak may stand in two places; the larger place of a leak holds more than a window only if the item has
at least ``SHORT`` own words, so every document that holds a word of a shorter item is its candidate, exactly.

Every candidate is verified exactly. One that holds less than ``SHARE`` of the item's own words, words a small edit away
counted (:func:`close`), cannot be a leak. The others are aligned: the best place of the document, and the best other place
before or after it in both texts. A place is dense: an equal word gains ``MATCH``, a word of the item that is missing or
changed costs ``MISS`` and a word put in costs ``SKIP``, so about five of seven words of a place are equal, or nearly so, in
order; texts that share set phrases but differ in names and numbers are not dense. The pair is reported if the matched
words are at least ``SHARE`` of the item's own words.

Recall against brute force on made items with misspelt words is 0.99 or more for copies of 62 % of an item with up to 35 % of
their words misspelt, the noise this is built for, and 0.73 with half of them misspelt.

The items are the stated query set. They are read in blocks of at most ``BLOCK_CHARS`` characters, so what is sent to the
workers is bounded; every block is held against all documents, and results do not depend on the blocks. Alignment works on
tiles of ``TILE`` words.

Defined results: null, empty and blank texts and items leak nothing; an item whose words are all formula leaks nowhere;
identical items are each reported; repeated rows repeat results.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.partitioning import spread
from .folding import Words

WINDOW = 8
EDITS = 2
WALKS = 2
SAMPLES = 3
BITS = 6
SEED = 7_340_033
FORMULA_WORDS = 10
FORMULA_ITEMS = 3
SHARE = 0.55
MATCH, MISS, SKIP = 2, 5, 3
#: Own words of an item from which on the larger of two places must hold more than a window.
SHORT = math.ceil(2 * (WINDOW + 1) / SHARE)
BLOCK_CHARS = 4_000_000
TEXT_BLOCK = 600_000
TILE = 4096
#: Distinct document words whose near item words a worker remembers before it starts anew.
MEMO_LIMIT = 200_000
_STEPS = 3 * WINDOW
_PAD = np.uint64(0x5851F42D4C957F2D)

_rng = np.random.default_rng(SEED)
_COINS = _rng.integers(1 << 62, size=(WALKS, _STEPS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PICKS = [[np.sort(_rng.choice(_STEPS, BITS, replace=False)) for _ in range(SAMPLES)] for _ in range(WALKS)]
_MIX = np.uint64(0xD6E8FEB86659FD93)


def keys_of(windows: np.ndarray) -> np.ndarray:
    """LSH keys of windows (rows of WINDOW word hashes): a column for each walk and sampling."""
    n = len(windows)
    padded = np.empty((WINDOW + 1, n), np.uint64)
    padded[:WINDOW] = windows.T
    padded[WINDOW] = _PAD
    flat, column = padded.ravel(), np.arange(n)
    out = np.zeros((n, WALKS * SAMPLES), np.uint64)
    with np.errstate(over="ignore"):
        for walk in range(WALKS):
            at = column.copy()
            for step in range(_STEPS):
                word = flat[at]
                for s, picks in enumerate(_PICKS[walk]):
                    if step in picks:
                        k = out[:, walk * SAMPLES + s]
                        k *= _MIX
                        k += word
                coin = (word * _COINS[walk, step]) >> np.uint64(63)
                at += coin.astype(np.int64) * n
                np.minimum(at, column + WINDOW * n, out=at)
        out ^= out >> np.uint64(31)
        out *= _MIX
    return out


def _windows(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return h[starts[:, None] + np.arange(WINDOW)]


class Filter:
    """A bitmap over hashes: certainly absent, or perhaps present."""

    def __init__(self, hashes: np.ndarray, bits: int = 22) -> None:
        self.shift = np.uint64(64 - bits)
        self.map = np.zeros(1 << bits, bool)
        self.map[hashes >> self.shift] = True

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        return self.map[hashes >> self.shift]


class Items:
    """The own words of items, the index of their windows' keys, and the index of words that are nearly equal."""

    def __init__(self, ids: list[int], texts: list[str], formula: list[list[int]] | None = None) -> None:
        """``formula``: by item the places at which formula runs begin; counted over these items if not given."""
        words = Words(texts)
        places = [np.flatnonzero(words.doc == k) for k in range(len(texts))]
        starts = formula_starts([words.hash[p] for p in places]) if formula is None else formula
        self.ids, self.own = ids, []
        spelt: dict[int, str] = {}
        for place, begins in zip(places, starts, strict=True):
            keep = np.ones(len(place), bool)
            for i in begins:
                keep[i : i + FORMULA_WORDS] = False
            self.own.append(words.hash[place[keep]])
            for i in place[keep].tolist():
                spelt.setdefault(int(words.hash[i]), words.word(i))
        self.rows: list[dict[int, list[int]]] = []
        for own in self.own:
            at: dict[int, list[int]] = {}
            for i, h in enumerate(own.tolist()):
                at.setdefault(h, []).append(i)
            self.rows.append(at)
        self.empty = not spelt
        if self.empty:
            return
        self.known = Filter(np.array(list(spelt), np.uint64))
        self.near: dict[str, list[tuple[str, int]]] = defaultdict(list)
        for h, word in spelt.items():
            for sign in _signs(word):
                self.near[sign].append((word, h))
        self.memo: dict[int, tuple[int, ...]] = {}
        self.short_words: dict[int, list[int]] = defaultdict(list)
        for k, own in enumerate(self.own):
            if len(own) < SHORT:
                for h in dict.fromkeys(own.tolist()):
                    self.short_words[h].append(k)
        self.index = []
        long = [k for k, own in enumerate(self.own) if len(own) >= SHORT]
        if not long:
            return
        keys = keys_of(np.concatenate([_windows(self.own[k], np.arange(len(self.own[k]) - WINDOW + 1)) for k in long]))
        owner = np.repeat(long, [len(self.own[k]) - WINDOW + 1 for k in long])
        for c in range(keys.shape[1]):
            order = np.argsort(keys[:, c], kind="stable")
            self.index.append((Filter(keys[:, c]), keys[order, c], owner[order]))

    def candidates(self, words: Words) -> dict[tuple[int, int], list[int]]:
        """(document, item) -> places of document words at which candidate windows begin."""
        found: dict[tuple[int, int], list[int]] = defaultdict(list)
        h, doc = words.hash, words.doc
        if self.index and len(h) >= WINDOW:
            hits = np.append(0, np.cumsum(self.known(h)))
            whole = doc[: len(h) - WINDOW + 1] == doc[WINDOW - 1 :]
            starts = np.flatnonzero(whole & (hits[WINDOW:] - hits[:-WINDOW] >= WINDOW - EDITS))
            for k in range(0, len(starts), 200_000):
                part = starts[k : k + 200_000]
                keys = keys_of(_windows(h, part))
                for c, (maybe, sorted_keys, owner) in enumerate(self.index):
                    mine = keys[:, c]
                    hit = np.flatnonzero(maybe(mine))
                    low, high = np.searchsorted(sorted_keys, mine[hit], "left"), np.searchsorted(sorted_keys, mine[hit], "right")
                    some = np.flatnonzero(high > low)
                    for at, a, b in zip(part[hit[some]].tolist(), low[some].tolist(), high[some].tolist(), strict=True):
                        for item in owner[a:b].tolist():
                            found[doc[at], item].append(at)
        if self.short_words:
            for at in np.flatnonzero(np.isin(h, np.array(list(self.short_words), np.uint64))).tolist():
                for item in self.short_words[int(h[at])]:
                    found[doc[at], item].append(at)
        return found

    def like(self, words: Words, i: int) -> tuple[int, ...]:
        """Hashes of the item words that a document's word ``i`` equals nearly, itself left out."""
        h = int(words.hash[i])
        out = self.memo.get(h)
        if out is None:
            word = words.word(i)
            out = tuple({g for sign in _signs(word) for other, g in self.near.get(sign, ()) if g != h and close(word, other)})
            if len(self.memo) >= MEMO_LIMIT:
                self.memo.clear()
            self.memo[h] = out
        return out

    def enough(self, words: Words, bounds: tuple[int, int], items: list[int]) -> list[int]:
        """Of ``items`` those of whose own words the document's words ``bounds`` hold, in any order, at least the share."""
        h, first = np.unique(words.hash[bounds[0] : bounds[1]], return_index=True)
        near: list[int] = []
        for g, i in zip(h.tolist(), first.tolist(), strict=True):
            like = self.memo.get(g)
            if like is None:
                like = self.like(words, bounds[0] + i)
            if like:
                near += like
        held = np.unique(np.concatenate([h, np.array(near, np.uint64)]))
        own = np.concatenate([self.own[k] for k in items])
        there = held[np.minimum(np.searchsorted(held, own), len(held) - 1)] == own
        sizes = np.array([len(self.own[k]) for k in items])
        counts = np.add.reduceat(there.astype(np.int64), np.cumsum(sizes) - sizes)
        return [k for k, some in zip(items, (counts >= SHARE * sizes).tolist(), strict=True) if some]

    def verify(self, words: Words, bounds: tuple[int, int], item: int, places: list[int]) -> tuple[float, int]:
        """Share of the item's own words that the document's words ``bounds`` reproduce in order, and in how many places."""
        n = len(self.own[item])
        columns: list[int] = []
        end = -1
        for p in sorted(set(places)):
            a, b = max(bounds[0], p - 2 * n), min(bounds[1], p + 2 * n + WINDOW)
            if a > end and columns:
                columns.append(-1)
            columns.extend(range(max(a, end), b))
            end = max(end, b)
        at = np.array(columns)
        if len(at) > max(TILE, 4 * n):
            best = lambda low, high, j0, j1: self._tiled(words, item, at[j0:j1], low, high, j0)
            equal = None
        else:
            equal = self._equal(words, item, at, 0, n)
            if equal.any(axis=1).sum() < SHARE * n:
                return 0.0, 0
            best = lambda low, high, j0, j1: _shifted(_align(equal[low:high, j0:j1])[1], low, j0)
        first = best(0, n, 0, len(at))
        if not first:
            return 0.0, 0
        (i0, j0), (i1, j1) = first[0], first[-1]
        if equal is not None and len(first) + max(equal[:i0, :j0].any(axis=1).sum(), equal[i1 + 1 :, j1 + 1 :].any(axis=1).sum()) < SHARE * n:
            return 0.0, 0  # whatever the order of the others
        rest = max(best(0, i0, 0, j0), best(i1 + 1, n, j1 + 1, len(at)), key=len)
        rest = rest if len(rest) >= 3 else []
        return (len(first) + len(rest)) / n, 1 + bool(rest)

    def _equal(self, words: Words, item: int, at: np.ndarray, low: int, high: int) -> np.ndarray:
        """Which of the item's words low to high equal, or nearly equal, which of the document's words ``at``."""
        h = np.where(at >= 0, words.hash[np.maximum(at, 0)], np.uint64(0))
        equal = self.own[item][low:high, None] == h[None, :]
        equal[:, at < 0] = False
        rows = self.rows[item]
        for j in np.flatnonzero(~equal.any(axis=0) & (at >= 0)).tolist():
            for g in self.like(words, int(at[j])):
                for i in rows.get(g, ()):
                    if low <= i < high:
                        equal[i - low, j] = True
        return equal

    def _tiled(self, words: Words, item: int, at: np.ndarray, low: int, high: int, shift: int) -> list[tuple[int, int]]:
        """Matched (row, column) pairs of the best place of the item's words low to high among the document's words ``at``.

        A place spans fewer than twice as many columns as rows, so tiles that overlap by that hold every place whole.
        """
        n, best, gain = high - low, [], 0
        step = max(TILE, 4 * n)
        for begin in range(0, max(1, len(at) - 2 * n), step - 2 * n):
            score, pairs = _align(self._equal(words, item, at[begin : begin + step], low, high))
            if score > gain:
                best, gain = _shifted(pairs, low, shift + begin), score
        return best


def _shifted(pairs: list[tuple[int, int]], rows: int, columns: int) -> list[tuple[int, int]]:
    return [(i + rows, j + columns) for i, j in pairs]


def formula_starts(runs: list[np.ndarray]) -> list[list[int]]:
    """By item, given as word hashes, the places at which formula runs begin: the plain count, for items in one place."""
    seen: dict[int, set[bytes]] = defaultdict(set)
    keys = [run_keys(run).tolist() for run in runs]
    for run, own in zip(runs, keys, strict=True):
        for k in own:
            seen[k].add(run.tobytes())
    return [[i for i, k in enumerate(own) if len(seen[k]) >= FORMULA_ITEMS] for own in keys]


def run_keys(run: np.ndarray) -> np.ndarray:
    """A key of each run of FORMULA_WORDS words, the same on every machine."""
    n = len(run) - FORMULA_WORDS + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(FORMULA_WORDS):
            out = (out ^ (out >> np.uint64(31))) * _MIX + run[k : k + n]
    return out.view(np.int64)


def _signs(word: str) -> list[str]:
    """What is left of a word when up to two neighbouring letters are taken out, with their place: close words share one."""
    n = len(word)
    return [f"{word[:k]}\0{word[k + b :]}" for b in (0, 1, 2) for k in range(n - b + 1)] if n >= 2 else []


def close(a: str, b: str) -> bool:
    """Whether two words are one small edit apart (two neighbouring letters in words of seven letters or more)."""
    m = max(len(a), len(b))
    if m < 3 or abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    e = 0
    while e < min(len(a), len(b)) - k and a[-1 - e] == b[-1 - e]:
        e += 1
    return k + e >= m - (2 if m >= 7 else 1)


def _align(equal: np.ndarray) -> tuple[int, list[tuple[int, int]]]:
    """Score and matched (row, column) pairs of the best local alignment."""
    n, m = equal.shape
    if not n or not m:
        return 0, []
    score = np.zeros((n + 1, m + 1), np.int32)
    gain = np.where(equal, MATCH, -MISS).astype(np.int32)
    slope = np.arange(m, dtype=np.int32) * SKIP
    for i in range(n):
        t = np.maximum(score[i, :-1] + gain[i], score[i, 1:] - MISS)
        np.maximum(t, 0, out=t)
        score[i + 1, 1:] = np.maximum.accumulate(t + slope) - slope
    i, j = np.unravel_index(score.argmax(), score.shape)
    top, out = int(score[i, j]), []
    while i and j and score[i, j]:
        s = score[i, j]
        if s == score[i - 1, j - 1] + gain[i - 1, j - 1]:
            i, j = i - 1, j - 1
            if equal[i, j]:
                out.append((int(i), int(j)))
        elif s == score[i - 1, j] - MISS:
            i -= 1
        else:
            j -= 1
    return top, out[::-1]


def find(items: Items, texts: list[str]) -> list[tuple[int, int, float, int]]:
    """(text, item, share, places) of every leak in ``texts``."""
    words = Words(texts)
    out = []
    if items.empty or not len(words.hash):
        return out
    begins = np.searchsorted(words.doc, np.arange(len(texts) + 1))
    found = items.candidates(words)
    by_doc: dict[int, list[int]] = defaultdict(list)
    for doc, item in found:
        by_doc[int(doc)].append(item)
    for doc, some in by_doc.items():
        bounds = int(begins[doc]), int(begins[doc + 1])
        for item in items.enough(words, bounds, some):
            share, n = items.verify(words, bounds, item, found[doc, item])
            if share >= SHARE:
                out.append((doc, item, share, n))
    return out


def own_parts(items: DataFrame) -> DataFrame:
    """Items (item_id, text) with ``starts``, the places at which formula runs begin, counted over all items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch.column(1).to_pylist())
            keys = [run_keys(words.hash[words.doc == k]) for k in range(batch.num_rows)]
            offsets = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys)))], names=["item_id", "text", "runs"])

    with_runs = items.mapInArrow(run, "item_id bigint, text string, runs array<bigint>")
    each = with_runs.select("item_id", "text", F.xxhash64("text").alias("t"), F.posexplode("runs").alias("at", "run"))
    formula = each.select("run", "t").distinct().groupBy("run").count().where(F.col("count") >= FORMULA_ITEMS).select("run")
    starts = each.join(formula, "run").groupBy("item_id", "t").agg(F.sort_array(F.collect_set("at")).alias("starts"))
    keyed = items.withColumn("t", F.xxhash64("text")).join(starts, ["item_id", "t"], "left")
    return keyed.select("item_id", "text", F.coalesce("starts", F.array().cast("array<int>")).alias("starts"))


def leaks(documents: DataFrame, eval_items: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, share, places) of every document that reproduces an item."""
    ddl = "doc_id bigint, item_id bigint, share double, places int"
    items = own_parts(eval_items.where("trim(text) != ''").select(F.col("item_id").cast("bigint").alias("item_id"), "text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(1.3 * chars / block_chars)) if chars > block_chars else 1
    df = spread(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text is not null"))
    out = None
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b) if blocks > 1 else items
        found = _leaks(df, sorted(block.collect(), key=lambda r: (r.item_id is None, r.item_id, r.text)), ddl)
        out = found if out is None else out.unionByName(found)
    return out


def _leaks(df: DataFrame, rows: list, ddl: str) -> DataFrame:
    columns = [[r[k] for r in rows] for k in range(3)]
    shared = df.sparkSession.sparkContext.broadcast(columns)  # at most about BLOCK_CHARS characters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*shared.value)
        for batch in batches:
            if items.empty:
                continue
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows: list[tuple] = []
            k = 0
            while k < len(texts):
                size, n = 0, k
                while n < len(texts) and (n == k or size + len(texts[n]) <= TEXT_BLOCK):
                    size += len(texts[n])
                    n += 1
                rows += [(keys[k + d], items.ids[i], s, p) for d, i, s, p in find(items, texts[k:n])]
                k = n
            if rows:
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.int32()), strict=True)], names=["doc_id", "item_id", "share", "places"])

    return df.mapInArrow(run, ddl)
