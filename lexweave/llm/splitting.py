"""Oversized texts in pieces within a limit (problem 3).

Agglomerative merging: a text is cut into atomic segments, which are words with the white space after them; the boundary
between two neighbours has a strength, greatest between paragraphs, then lines, sentences, clauses and words. All
adjacent pairs lie in a heap, weakest boundary first (of equal ones the leftmost, so pieces are filled up), and are merged
while their size together with the overlap fits the limit. What cannot be merged any more are the pieces, so cuts stand at
the strongest boundaries that the limit allows. An atomic segment that is too long by itself is cut hard, never between a
character and its combining marks or joiners.

Each piece after the first begins with the last ``overlap`` characters of the one before, moved to the nearest word's
beginning: to the left if the piece stays within the limit and the overlap grows by less than half, else to the right if at
least half of it remains, else to the next place that parts no letter from its marks. Pieces without their overlap give back
the text, character for character.

Defined results: a text within the limit is one piece; null and empty texts have no pieces; the overlap is all of the piece
before where that has fewer characters; copies of an item delivered again give the same pieces once.
"""

from __future__ import annotations

import heapq
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


LIMIT = 1200
OVERLAP = 120

#: Atomic segments: leading space, or a run without space and the space that follows.
_ATOMS = regex.compile(r"^\s+|\S+\s*").finditer
_SENTENCE = regex.compile(r"[.!?…;][\"'»”’)\]]*$").search
_CLAUSE = regex.compile(r"[,:–—][\"'»”’)\]]*$").search


def strength(atom: str) -> int:
    """Strength of the boundary after an atomic segment: 5 paragraph, 4 line, 3 sentence, 2 clause, 1 word."""
    word = atom.rstrip()
    gap = atom[len(word) :]
    lines = gap.count("\n") + gap.replace("\r\n", "\n").count("\r") + gap.count("\u2028") + 2 * gap.count("\u2029")
    if lines:
        return 5 if lines > 1 else 4
    return 3 if _SENTENCE(word) else 2 if _CLAUSE(word) else 1


def _hard(text: str, begin: int, end: int, size: int) -> list[int]:
    """Ends of pieces of at most ``size`` between begin and end, not before a combining mark or joiner if that can be."""
    out = []
    while end - begin > size:
        cut = begin + size
        while cut > begin + 1 and _parted(text, cut):
            cut -= 1
        if cut == begin + 1 and size > 1:
            cut = begin + size
        out.append(cut)
        begin = cut
    return [*out, end]


def cuts(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[int]:
    """Ends of the pieces of a text, without overlap."""
    if overlap < 0 or overlap >= limit:
        raise ValueError("the overlap must be less than the limit")
    if len(text) <= limit:
        return [len(text)] if text else []
    room = limit - overlap
    ends: list[int] = []
    force: list[int] = []
    for m in _ATOMS(text):
        inner = _hard(text, m.start(), m.end(), room)
        ends += inner
        force += [0] * (len(inner) - 1) + [strength(m[0])]
    n = len(ends)
    begins = [0, *ends[:-1]]
    follows, before = list(range(1, n + 1)), list(range(-1, n - 1))
    stop, version = ends[:], [0] * n
    size = lambda i: stop[i] - begins[i]
    heap = [(force[i], i, ends[i + 1] - begins[i], 0, 0) for i in range(n - 1)]
    heapq.heapify(heap)
    while heap:
        _, i, total, vi, vj = heapq.heappop(heap)
        j = follows[i]
        if version[i] != vi or j >= n or version[j] != vj or version[i] < 0:
            continue
        if total > (limit if i == 0 else room):
            continue
        stop[i] = stop[j]
        force[i] = force[j]
        version[i] += 1
        version[j] = -1
        follows[i] = k = follows[j]
        if k < n:
            before[k] = i
            heapq.heappush(heap, (force[i], i, stop[k] - begins[i], version[i], version[k]))
        if (h := before[i]) >= 0:
            heapq.heappush(heap, (force[h], h, size(h) + size(i), version[h], version[i]))
    out, i = [], 0
    while i < n:
        out.append(stop[i])
        i = follows[i]
    return out


def _parted(text: str, at: int) -> bool:
    """Whether a cut at this place parts a letter from its marks or joiners."""
    return unicodedata.category(text[at])[0] == "M" or text[at] in "\u200d\u200c" or text[at - 1] == "\u200d"


def overlap_start(text: str, before: int, own: int, end: int, limit: int, overlap: int) -> int:
    """Where the piece own to end begins with its overlap; the piece before begins at ``before``."""
    at = max(before, own - overlap)
    if at in (before, own):
        return at
    starts = lambda k: text[k - 1].isspace() and not text[k].isspace() and not _parted(text, k)
    least = max(before, end - limit, at - overlap // 2)
    left = next((k for k in range(at, least - 1, -1) if k == before or starts(k)), None)
    if left is not None:
        return left
    right = next((k for k in range(at, own - overlap // 2) if starts(k)), None)
    if right is not None:
        return right
    return next((k for k in range(at, own) if not _parted(text, k)), own)


def split_text(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """(begin, own, end) of each piece: ``text[begin:own]`` is the overlap with the piece before."""
    out, own = [], 0
    for end in cuts(text, limit, overlap):
        out.append((overlap_start(text, out[-1][0], own, end, limit, overlap) if out else own, own, end))
        own = end
    return out


def pieces(items: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(item_kind, item_id, piece, begin, own, text) of every item longer than the limit; pieces are numbered from 1.

    ``own`` is the length of the overlap at the beginning of the piece's text, ``begin`` its place in the item.
    """
    ddl = "item_kind string, item_id string, piece int, begin int, own int, text string"
    types = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string())
    names = ["item_kind", "item_id", "piece", "begin", "own", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for kind, item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for k, (begin, own, end) in enumerate(split_text(text, limit, overlap), 1):
                    rows.append((kind, item, k, begin, own - begin, text[begin:end]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    long = items.select("item_kind", "item_id", "text").where(F.length("text") > limit)
    return long.mapInArrow(run, ddl)


def oversized(cut_pieces: DataFrame) -> DataFrame:
    """(item_kind, item_id) of the items that were cut."""
    return cut_pieces.where("piece = 2").select("item_kind", "item_id").distinct()
