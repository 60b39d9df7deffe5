"""One consistent form for texts that look the same (problem 4).

A mapping from what is written to what it looks like is compiled into a longest-match transducer over grapheme clusters:
full-width and narrow forms become ordinary ones, a letter and its combining accents become the composed letter, spaces
of any kind become a space, format characters vanish, ligatures come apart, look-alike letters of other scripts become
Latin ones. The mapping is checked when it is compiled: every output must map to itself, so a second pass changes
nothing and no two rules contradict each other. Letter case, accents, digits and line breaks are kept, so texts that look
different stay different.

The transducer reads a text once, from left to right, and takes the longest of what fits: a fixed sequence, a letter with
its combining marks (whatever invisible characters stand between them), a sequence of Korean letters, or a run of single
characters. Clusters are composed, mapped and remembered; runs go through one table.

Defined results: null stays null and empty stays empty; a line ends in a line feed however it ended; a combining mark
without a letter before it is kept; repeated rows stay repeated.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.partitioning import cut

# Letters of other scripts that look like Latin ones, in natural order.
_CYRILLIC = ("АВЕЅІЈКМНОРСТУХҮԌԚԜЬаеѕіјорсухѵһԁԛԝӏ", "ABESIJKMHOPCTYXYGQWbaesijopcyxvhdqwl")
_GREEK = ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϳονιαρυ", "ABEZHIKMNOPTYXCjoviapu")
_ARMENIAN = ("ԼՍՏՕհոսցօ", "LUSOhnugo")
_CHEROKEE = ("ᎠᎡᎢᎩᎪᎫᎬᎳᎷᎻᎽᏀᏃᏔᏙᏚᏞᏟᏢᏦᏴ", "DRTYAJEWMHYGZWVSLCPKB")

#: Letter -> the Latin letter that it looks like.
LETTERS: dict[str, str] = {a: b for pair in (_CYRILLIC, _GREEK, _ARMENIAN, _CHEROKEE) for a, b in zip(*pair, strict=True)}

# Further single signs that look like common ones, and letters that show as a blank.
_SIGNS = {"‐": "-", "‑": "-", "﹣": "-", "⁃": "-", "ʼ": "’", "∶": ":", "․": ".", "⁄": "/", "∕": "/", "µ": "μ"}
_BLANKS = "\u2800\u3164\uffa0"
_LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "ſt", "ﬆ": "st", "ĳ": "ij", "Ĳ": "IJ", "ǆ": "dž", "ǉ": "lj", "ǌ": "nj"}
_IGNORED = regex.compile(r"[\p{Default_Ignorable_Code_Point}\p{Cf}--[\u0600-\u08ff]]", regex.VERSION1).fullmatch


#: Line ends, all of which become a line feed.
LINE_ENDS = {"\r\n": "\n", "\r": "\n"}
#: Clusters remembered by a worker before it starts anew.
MEMO_LIMIT = 100_000


class Conflict(ValueError):
    """Rules of a mapping contradict each other."""


def rules() -> dict[str, str]:
    """The mapping for single characters: what is written -> what it looks like."""
    out: dict[str, str] = dict(_SIGNS) | _LIGATURES | LETTERS | dict.fromkeys(_BLANKS, " ")
    for code in range(sys.maxunicode + 1):
        if 0x3400 <= code < 0xA000 or 0xAC00 <= code < 0xF900 or 0x20000 <= code < 0x2F800 or 0x30000 <= code < 0xE0000:
            continue
        c = chr(code)
        if c in out:
            continue
        kind = unicodedata.category(c)
        if kind == "Zs" or c == "\t":
            out[c] = " "
        elif kind[0] in "CLM" and _IGNORED(c):
            out[c] = ""
        elif c in "\x85\v\f\u2028\u2029":
            out[c] = "\n"
        elif 0xFF00 <= code < 0xFFEF or 0x2160 <= code < 0x2180 or unicodedata.decomposition(c).startswith(("<wide>", "<narrow>")):
            out[c] = unicodedata.normalize("NFKC", c)
        elif (apart := unicodedata.normalize("NFD", c)) != c or apart[0] in LETTERS:
            whole = unicodedata.normalize("NFC", LETTERS.get(apart[0], apart[0]) + apart[1:])
            if whole != c:
                out[c] = whole
    return out


def confusables(lines: Iterable[str]) -> dict[str, str]:
    """Further rules from a public table of look-alikes (``source ; target ; ...`` in hexadecimal, ``#`` begins a remark)."""
    out = {}
    for line in lines:
        parts = line.split("#")[0].split(";")
        if len(parts) >= 2:
            source, target = ("".join(chr(int(x, 16)) for x in p.split()) for p in parts[:2])
            out[source] = target
    return out


def _ranges(codes: Iterable[int]) -> str:
    """The inside of a character class that holds ``codes``."""
    out: list[list[int]] = []
    for code in sorted(codes):
        if out and code == out[-1][1] + 1:
            out[-1][1] = code
        else:
            out.append([code, code])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


class Transducer:
    """A conflict-checked mapping, compiled; call it with a text."""

    def __init__(self, mapping: dict[str, str]) -> None:
        single = {k: v for k, v in mapping.items() if len(k) == 1}
        closed: dict[str, str] = {}
        for k, v in single.items():  # an output may itself be mapped: a full-width letter may look like a Latin one
            seen = {k}
            while (w := unicodedata.normalize("NFC", "".join(single.get(c, c) for c in v))) != v:
                if v in seen:
                    raise Conflict(f"{k!r} maps round in a circle")
                seen.add(v)
                v = w
            closed[k] = v
        self.table = {ord(k): v for k, v in closed.items() if k != v}
        self.longer = {k: v for k, v in mapping.items() if len(k) > 1}
        self.composed: dict[str, str] = {}
        drop = _ranges(k for k, v in self.table.items() if not v)
        mark = rf"[\p{{M}}--[{drop}]]" if drop else r"\p{M}"
        own = _ranges(k for k in self.table if 32 <= k < 127)
        self.plain = not own and all(not k.isascii() or k in LINE_ENDS for k in self.longer)
        fixed = [regex.escape(k) for k in sorted(self.longer, key=len, reverse=True)]
        cluster = rf"[^\p{{M}}\s{drop}]{f'[{drop}]*' if drop else ''}{mark}[\p{{M}}{drop}]*"
        korean = r"[\u1100-\u11ff\uac00-\ud7a3]*[\u1161-\u11ff]+"
        run = rf"(?:[^\n -~\p{{M}}\r\u1161-\u11ff]{f'|[{own}]' if own else ''})+(?!{f'[{drop}]*' if drop else ''}{mark})|[\p{{M}}\r]"
        self.parts = regex.compile("|".join([*fixed, cluster, korean, f"(?P<run>{run})"]), regex.VERSION1)
        # texts in which nothing longer than a character can match need only the runs
        self.longer_there = regex.compile("|".join([*fixed, r"[\p{M}\u1161-\u11ff]"]), regex.VERSION1).search
        self.runs = regex.compile(r"[^\n -~]+" if not own else rf"(?:[^\n -~]|[{own}])+", regex.VERSION1)
        for k, v in [*closed.items(), *self.longer.items()]:  # nothing that is put out may be mapped again
            if self(v) != v:
                raise Conflict(f"{k!r} maps to {v!r}, which is mapped itself")
        for code in self.table:  # what is written apart must come out as what is written in one
            c = chr(code)
            if (apart := unicodedata.normalize("NFD", c)) != c and self(apart) != self(c):
                raise Conflict(f"{c!r} and its parts come out differently")

    def _whole(self, cluster: str) -> str:
        """A cluster composed as written, mapped, and composed with the letters it looks like."""
        out = unicodedata.normalize("NFC", "".join(c for c in cluster if self.table.get(ord(c), "?")))
        while (new := unicodedata.normalize("NFC", out.translate(self.table))) != out:
            out = new
        return out

    def _part(self, m: regex.Match) -> str:
        part = m[0]
        if m["run"] is not None:
            return part.translate(self.table)
        out = self.longer.get(part, self.composed.get(part))
        if out is None:
            if len(self.composed) >= MEMO_LIMIT:
                self.composed.clear()
            out = self.composed[part] = self._whole(part)
        return out

    def __call__(self, text: str) -> str:
        if self.plain and text.isascii() and not any(c in text for c in "\t\v\f\r"):
            return text
        if self.longer_there(text):
            out = self.parts.sub(self._part, text)
        else:
            out = self.runs.sub(lambda m: m[0].translate(self.table), text)
        return out if unicodedata.is_normalized("NFC", out) else unicodedata.normalize("NFC", out)  # half-width marks


@lru_cache(maxsize=1)
def transducer() -> Transducer:
    """The library's mapping, compiled once a worker."""
    return Transducer(rules() | LINE_ENDS)


def canonical_text(text: str | None) -> str | None:
    """The consistent form of one text."""
    return text if text is None else transducer()(text)


def canonical(text: Column) -> Column:
    """The consistent form of a text column.

    Printable ASCII and line feeds are their own form and stay in the JVM; everything else goes through the transducer
    in Arrow batches.
    """

    @F.arrow_udf("string")
    def mapped(texts: pa.Array) -> pa.Array:
        to = transducer()
        return pa.array([None if t is None else to(t) for t in texts.to_pylist()], pa.string())

    return mapped(text)


def needs_mapping(text: Column) -> Column:
    """Whether a text holds anything but printable ASCII and line feeds."""
    return text.rlike(r"[^\n -~]")


def forms(items: DataFrame) -> DataFrame:
    """(item_kind, item_id, form) of ``items`` (item_kind, item_id, text): the consistent form of each text."""
    odd = canonical(F.when(needs_mapping(F.col("text")), F.col("text")))
    return items.select("item_kind", "item_id", F.coalesce(odd, F.col("text")).alias("form"))


#: Items of one form that one task pairs with all others of it; more are spread over more tasks.
HOT = 2000


def _near(items: DataFrame) -> DataFrame:
    """(item_kind, fa, fb, item_id, ta, tb, n): items whose form other strings have too, each item and text once.

    Texts are mapped once and only their 128-bit hashes are kept, in a table written to the shared folder. Forms under
    which all texts are the same string are left out by a partially aggregated minimum and maximum, so copies, however
    many, never meet. ``n`` is how many rows the form has.
    """
    usable = items.where(F.col("text").isNotNull() & F.col("item_id").isNotNull())
    two = lambda c, name: [F.xxhash64(c).alias(f"{name}a"), F.xxhash64(F.lit(29), c).alias(f"{name}b")]
    odd = usable.select("item_kind", "item_id", *two(F.col("text"), "t"), canonical(F.when(needs_mapping(F.col("text")), F.col("text"))).alias("form"))
    own = [F.when(F.col("form").isNotNull(), h).otherwise(F.col(f"t{x}")).alias(f"f{x}") for h, x in zip(two(F.col("form"), ""), "ab", strict=True)]
    kept = cut(odd.select("item_kind", "item_id", "ta", "tb", *own))
    key = ["item_kind", "fa", "fb"]
    several = kept.groupBy(*key).agg(F.min(F.struct("ta", "tb")).alias("lo"), F.max(F.struct("ta", "tb")).alias("hi"), F.count("*").alias("n")).where("lo < hi").select(*key, "n")
    return kept.join(several, key).select(*key, "item_id", "ta", "tb", "n").distinct()


def look_classes(items: DataFrame) -> DataFrame:
    """(item_kind, class, item_id): the items of each look that more than one string has; a class is named by its form's hash.

    This is the whole result in a form that grows with the items and not with their pairs.
    """
    return _near(items).select("item_kind", F.concat(F.lower(F.lpad(F.hex("fa"), 16, "0")), F.lower(F.lpad(F.hex("fb"), 16, "0"))).alias("class"), "item_id").distinct()


def same_look(items: DataFrame, hot: int = HOT) -> DataFrame:
    """(item_kind, item_a, item_b): pairs of different items of a kind whose texts look the same but are not the same string.

    Items of one form are paired by a join on form and salt. A form of more than ``hot`` rows is hot: one side of it is
    spread over as many salts as it has times ``hot`` rows and the other repeated in each, so no form's items have to fit
    one task; all other forms have one salt and no row is repeated.

    Repeated deliveries count once; an item delivered with two texts is compared by both; null ids and texts have no pairs.
    """
    near = cut(_near(items))
    salts = F.ceil(F.col("n") / F.lit(hot)).cast("int")
    left = near.withColumn("salt", F.pmod(F.xxhash64("item_id", "ta"), salts).cast("int"))
    right = near.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    a, b = left.alias("x"), right.alias("y")
    on = F.col("x.salt") == F.col("y.salt")
    for c in ("item_kind", "fa", "fb"):
        on = on & (F.col(f"x.{c}") == F.col(f"y.{c}"))
    differ = (F.col("x.ta") != F.col("y.ta")) | (F.col("x.tb") != F.col("y.tb"))
    pairs = a.join(b, on & (F.col("x.item_id") < F.col("y.item_id")) & differ)
    return pairs.select(F.col("x.item_kind").alias("item_kind"), F.col("x.item_id").alias("item_a"), F.col("y.item_id").alias("item_b")).distinct()
