"""Lists that are marked in running text: which markers form a genuine sequence, and the text of each entry.

A text is taken apart at every marker, and a fold over the markers accepts those that continue the sequence; the text
after a marker that is not accepted, and that marker itself, belong to the entry before. No offsets and no Python are
needed: the parts of a split and the extracted markers interleave exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .textnorm import WS, category_heading, let, normalize_text, strip, subpoint_note

# Marker grammars. Group 1 is the label.
LETTER = rf"(?i)\(([a-z])\)[{WS}]*"
ROMAN = rf"(?i)\((i|ii|iii|iv|v|vi|vii|viii|ix|x|xi|xii)\)[{WS}]*"
NUMBER = rf"(?:\A|[{WS}])([0-9]+)\.[{WS}]+"
PAREN_NUMBER = rf"(?:\A|[{WS}])\(([0-9]+)\)[{WS}]+"
DASH = rf"(?:\A|[{WS}])([—–•·-])[{WS}]*"
ROMANS = ("i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x", "xi", "xii")
ROMAN_GOES_ON = r"(?i)\((?:ii|iii|iv|vi{1,3}|ix|xi{1,3})\)"
LOOK_AHEAD = 400
LEAST_NUMBERS = 3

ENTRY = "struct<label:string,text:string>"


def marked(text: Column, marker: str, accept: Callable[[Column, Column, Column], Column] | None) -> Column:
    """struct(intro, entries) of a text; ``accept(label, last, ahead)`` says whether a marker continues the sequence.

    ``last`` is how many entries were accepted, ``ahead`` is the text after the marker. Without ``accept`` every marker
    counts. The intro is the text before the first accepted marker; entries are struct(label, text), texts as they stand.
    """
    labels = F.regexp_extract_all(text, F.lit(marker), F.lit(1))

    def folded(part: Column, mark: Column, label: Column) -> Column:
        zero = F.struct(
            F.get(part, F.lit(0)).alias("intro"), F.array().cast(f"array<{ENTRY}>").alias("entries"),
            F.length(F.get(part, F.lit(0))).alias("at"),
        )

        def step(a: Column, i: Column) -> Column:
            piece, sign, name = F.get(part, i + 1), F.get(mark, i), F.lower(F.get(label, i))
            after = a["at"] + F.length(sign)
            ok = F.lit(True) if accept is None else accept(name, F.size(a["entries"]), F.substr(text, after + 1, F.lit(LOOK_AHEAD)))
            n = F.size(a["entries"])
            tail = F.element_at(a["entries"], -1)
            grown = F.concat(F.slice(a["entries"], 1, F.greatest(n - 1, F.lit(0))), F.array(F.struct(tail["label"].alias("label"), F.concat(tail["text"], sign, piece).alias("text"))))
            entries = F.when(ok, F.concat(a["entries"], F.array(F.struct(name.alias("label"), piece.alias("text"))))).when(n > 0, grown).otherwise(a["entries"])
            intro = F.when(ok | (n > 0), a["intro"]).otherwise(F.concat(a["intro"], sign, piece))
            return F.struct(intro.alias("intro"), entries.alias("entries"), (after + F.length(piece)).alias("at"))

        steps = F.when(F.size(mark) == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.size(mark) - 1))
        return F.aggregate(steps, zero, step, lambda a: F.struct(a["intro"].alias("intro"), a["entries"].alias("entries")))

    return let(F.split(text, marker, -1), lambda p: let(F.regexp_extract_all(text, F.lit(marker), F.lit(0)), lambda m: let(labels, lambda n: folded(p, m, n))))


def _letters(label: Column, last: Column, ahead: Column) -> Column:
    due = F.ascii(label) - F.ascii(F.lit("a")) == last
    return due & ((last == 0) | ~(label.isin("i", "v", "x") & ahead.rlike(ROMAN_GOES_ON)))


def _romans(label: Column, last: Column, ahead: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, ROMANS)), label) == last + 1


def _numbers(label: Column, last: Column, ahead: Column) -> Column:
    return F.try_to_number(label, F.lit("9" * 18)) == last + 1


def _kept(entries: Column) -> Column:
    """Entries with stripped texts, those without text left out."""
    return F.filter(F.transform(entries, lambda e: F.struct(e["label"].alias("label"), strip(e["text"]).alias("text"))), lambda e: e["text"] != "")


def lettered(text: Column) -> Column:
    """struct(intro, entries) of ``(a) ... (b) ...``."""
    return marked(text, LETTER, _letters)


def roman(text: Column) -> Column:
    """struct(intro, entries) of ``(i) ... (ii) ...``."""
    return marked(text, ROMAN, _romans)


def paren_numbers(text: Column) -> Column:
    """struct(intro, entries) of ``(1) ... (2) ... (3) ...``; no entries if they are fewer than three."""
    return let(marked(text, PAREN_NUMBER, _numbers), lambda m: F.when(F.size(m["entries"]) >= LEAST_NUMBERS, m).otherwise(F.struct(text.alias("intro"), F.array().cast(f"array<{ENTRY}>").alias("entries"))))


def numbers(text: Column) -> Column:
    """struct(intro, entries) of ``1. ... 2. ...``, in whatever order."""
    return marked(text, NUMBER, None)


def dashes(text: Column) -> Column:
    """Texts of a dash or bullet list, those without text left out."""
    return F.transform(_kept(marked(normalize_text(text), DASH, None)["entries"]), lambda e: e["text"])


# The following take texts that are normalised; parts of such texts only need to be stripped.


def _subpoints(t: Column) -> Column:
    some = lambda m: F.struct(strip(m["intro"]).alias("prefix"), _kept(m["entries"]).alias("subpoints"))
    bare = F.struct(t.alias("prefix"), F.array().cast(f"array<{ENTRY}>").alias("subpoints"))
    either = lambda a: F.when(F.size(a["subpoints"]) > 0, a).otherwise(let(let(roman(t), some), lambda r: F.when(F.size(r["subpoints"]) > 0, r).otherwise(bare)))
    return F.when(~t.contains("("), bare).otherwise(let(let(lettered(t), some), either))


def subpoints(text: Column) -> Column:
    """struct(prefix, subpoints): lettered entries of a text, or Roman ones if there are none."""
    return let(normalize_text(text), _subpoints)


def normal_points(t: Column) -> Column:
    """As ``points``, of a normalised text."""

    def point(e: Column) -> Column:
        return let(_subpoints(e["text"]), lambda s: F.struct(e["label"].alias("label"), F.when(F.size(s["subpoints"]) > 0, s["prefix"]).otherwise(e["text"]).alias("text"), s["subpoints"].alias("subpoints")))

    return let(lettered(t), lambda m: F.struct(strip(m["intro"]).alias("intro"), F.transform(_kept(m["entries"]), point).alias("points")))


def points(text: Column) -> Column:
    """struct(intro, points) of a paragraph; a point is struct(label, text, subpoints)."""
    return let(normalize_text(text), normal_points)


def nested_item(number: Column, t: Column) -> Column:
    """struct(number, category, intro, text, subpoints) of a numbered item's normalised text; subpoints are struct(label, text, note)."""
    titled = rf"\A([^:]{{1,150}}):[{WS}]*(.+)\z"

    def build(s: Column) -> Column:
        deep = F.size(s["subpoints"]) > 0
        notes = F.transform(s["subpoints"], lambda e: let(subpoint_note(e["text"]), lambda n: F.struct(e["label"].alias("label"), n["main"].alias("text"), n["note"].alias("note"))))

        def whole(category: Column, intro: Column, text: Column) -> Column:
            return F.struct(number.alias("number"), category.alias("category"), intro.alias("intro"), text.alias("text"), notes.alias("subpoints"))

        none = F.lit(None).cast("string")
        headed = let(category_heading(s["prefix"], normal=True), lambda h: whole(F.nullif(h["category"], F.lit("")), h["intro"], none))
        named = lambda c: F.when(c != "", whole(c, none, F.concat(c, F.lit(": "), strip(F.regexp_extract(t, titled, 2))))).otherwise(whole(none, none, t))
        return F.when(deep, headed).otherwise(let(strip(F.regexp_extract(t, titled, 1)), named))

    return let(_subpoints(t), build)


def normal_items(t: Column) -> Column:
    """As ``numbered_items``, of a normalised text."""
    return F.transform(_kept(numbers(t)["entries"]), lambda e: nested_item(e["label"], e["text"]))


def numbered_items(text: Column) -> Column:
    """Nested items of ``1. ... 2. ...``; items without text left out."""
    return let(normalize_text(text), normal_items)


def normal_paren_items(t: Column) -> Column:
    """As ``paren_items``, of a normalised text."""
    return let(paren_numbers(t), lambda m: F.struct(strip(m["intro"]).alias("intro"), F.transform(_kept(m["entries"]), lambda e: nested_item(e["label"], e["text"])).alias("items")))


def paren_items(text: Column) -> Column:
    """struct(intro, items) of a definitions list."""
    return let(normalize_text(text), normal_paren_items)
