"""Texts folded to words that are equal for every spelling form: vectorised over a batch of texts.

A word is a run of letters and digits after folding: case, accents, width and ligatures are undone, letters of other
scripts that look like Latin ones become those, format characters (zero-width, soft hyphen) and combining marks vanish.
Words come as 64-bit hashes with the places where they begin and end in the text.
"""

from __future__ import annotations

import unicodedata

import numpy as np

from .lookalikes import LETTERS

_TOP = 0x20000
_DROP = np.uint32(0xFFFFFFFF)
#: Characters that fold to several; undone before the table is used.
_MULTI = {"ß": "ss", "ẞ": "ss", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "æ": "ae", "Æ": "ae", "œ": "oe", "Œ": "oe"}
_OTHER = {"ł": "l", "ø": "o", "đ": "d", "ς": "σ", "ı": "i"}


def _table() -> np.ndarray:
    """By code point: the folded letter or digit, 0 for what parts words, ``_DROP`` for what vanishes."""
    out = np.zeros(_TOP, np.uint32)
    for code in range(_TOP):
        if 0x3400 <= code < 0xA000 or 0xAC00 <= code < 0xD7A4:
            out[code] = code
            continue
        if 0xD800 <= code < 0xF900:
            continue
        c = chr(code)
        kind = unicodedata.category(c)
        if kind in ("Mn", "Cf"):
            out[code] = _DROP
        elif kind[0] in "LN":
            c = LETTERS.get(c, c)
            base = unicodedata.normalize("NFKD", c)[:1].lower()
            base = LETTERS.get(base, base)
            out[code] = ord(_OTHER.get(base, base)[:1])
    return out


_FOLD = _table()
_POWER = np.uint64(0x9E3779B97F4A7C15)


def _weights(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, _POWER, np.uint64))


class Words:
    """Folded words of texts: ``hash``, ``doc``, and in ``text`` (the texts glued, offsets ``starts``) ``begin`` and ``end``."""

    def __init__(self, texts: list[str]) -> None:
        glued = "\n".join(texts)
        self.shifts: list[tuple[str, str]] = []
        if not glued.isascii():
            for a, b in _MULTI.items():
                if a in glued:
                    texts = [t.replace(a, b) for t in texts]
                    glued = glued.replace(a, b)
        self.texts = texts
        code = np.minimum(np.frombuffer(glued.encode("utf-32-le", "replace"), np.uint32), _TOP - 1)
        self.starts = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
        fold = _FOLD[code]
        place = np.flatnonzero(fold != _DROP)
        fold = fold[place]
        inside = fold != 0
        before = np.append(False, inside[:-1]) if len(inside) else inside
        begins = np.flatnonzero(inside & ~before)
        after = np.append(inside[1:], False) if len(inside) else inside
        ends = np.flatnonzero(inside & ~after)
        letters = np.flatnonzero(inside)
        self.begin, self.end = place[begins], place[ends] + 1
        self.doc = np.searchsorted(self.starts, self.begin, "right") - 1
        if not len(begins):
            self.hash = np.zeros(0, np.uint64)
            return
        length = ends - begins + 1
        first = np.cumsum(np.append(0, length[:-1]))
        within = np.arange(len(letters)) - np.repeat(first, length)
        weights = _weights(int(length.max()))
        with np.errstate(over="ignore"):
            h = np.add.reduceat((fold[letters].astype(np.uint64) + np.uint64(77)) * weights[within], first)
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(32)
        self.hash = h
        self.fold, self._first, self._length = fold[letters], first, length

    def word(self, i: int) -> str:
        """The folded letters of word ``i``."""
        return "".join(map(chr, self.fold[self._first[i] : self._first[i] + self._length[i]]))
