"""Trees of articles and annexes from their lines, with references and cited acts, as plain Python.

Runs in Arrow batches: the JVM interprets nested folds node by node, which took several times as long. Grammars are
those of ``markers``, ``refs`` and ``textnorm``, read from there; results are the same as those of the Column functions.
"""

from __future__ import annotations

import datetime
import re
import sys
import unicodedata
from functools import lru_cache

from . import markers, refs, textnorm
from .textnorm import SPECIAL_SPACES, WS, WS_CHARS

_SPACES = re.escape(WS_CHARS)


@lru_cache(maxsize=1)
def _word() -> str:
    """The class of characters that a JVM's word boundary takes for part of a word."""
    ranges: list[list[int]] = []
    for n in range(sys.maxunicode + 1):
        c = chr(n)
        if c == "_" or unicodedata.category(c) in ("Lu", "Ll", "Lt", "Lm", "Lo", "Nd", "Mn"):
            if ranges and ranges[-1][1] == n - 1:
                ranges[-1][1] = n
            else:
                ranges.append([n, n])
    return f"(?-i:[{''.join(f'\\U{a:08x}-\\U{b:08x}' for a, b in ranges)}])"


def compiled(pattern: str) -> re.Pattern:
    r"""A pattern of the library for ``re``: white space, ASCII letters without case, ``\z``, the JVM's word boundary.

    A boundary is tested behind the words that follow it, so that no place is tested where these words aren't.
    """
    p = pattern.replace(WS, _SPACES).replace("\\z", "\\Z")
    behind = lambda w: f"{w}(?<!{_word()}{w})"
    p = re.sub(r"\\b\(([A-Za-z]+(?:\|[A-Za-z]+)+)\)", lambda m: f"({'|'.join(map(behind, m[1].split('|')))})", p)
    p = re.sub(r"\\b([A-Za-z]+)", lambda m: behind(m[1]), p)
    p = p.replace("\\b([0-9]", f"(?=[0-9])(?<!{_word()})([0-9]").replace("\\b)", f"(?!{_word()}))")
    assert "\\b" not in p, pattern
    return re.compile(p, re.ASCII)


_SPECIAL = re.compile(f"[{SPECIAL_SPACES}]")
_BULLET = re.compile(rf"(?:[-–—•·][{_SPACES}]+)+(?=\([a-zA-Z0-9]+\)[{_SPACES}])")
_RUN = re.compile(rf"[{re.escape(WS_CHARS.replace(' ', ''))}][{_SPACES}]*| [{_SPACES}]+")
_LETTER, _ROMAN, _NUMBER, _PAREN, _DASH = map(compiled, (markers.LETTER, markers.ROMAN, markers.NUMBER, markers.PAREN_NUMBER, markers.DASH))
_GOES_ON = compiled(markers.ROMAN_GOES_ON)
_ORDER = {label: n for n, label in enumerate(markers.ROMANS)}
_TITLED = compiled(rf"\A([^:]{{1,150}}):[{WS}]*(.+)\z")
_COMMA = compiled(rf"\A([^,]+),[{WS}]+.+\z")
_NOTE = compiled(textnorm.NOTE)
_HOWEVER = compiled(rf"(?i)(?:\A|[{WS}])However:[{WS}]*\z")
_HOWEVER_END = compiled(rf"(?i)[{WS}]*However:[{WS}]*\z")
_SECTION_CUT = compiled(rf"(?i)Section[{WS}]+[A-Z]\..*[^ \t\n\x0b\f\r]")
_SECTION_LINE = compiled(textnorm.SECTION_LINE)
_ARTICLE, _SECTION, _CHAPTER, _CITED = map(compiled, (refs.ARTICLE, refs.SECTION, refs.CHAPTER, refs.CITED))
_MONTHS = {m.lower(): n for n, m in enumerate(refs.MONTHS.split("|"), 1)}


def strip(t: str) -> str:
    return t.strip(WS_CHARS)


def normalize_text(t: str) -> str:
    return _RUN.sub(" ", _BULLET.sub("", _SPECIAL.sub(" ", t))).strip(" ")


def long_date(t: str) -> datetime.date | None:
    day, _, rest = t.partition(" ")
    month, _, year = rest.partition(" ")
    try:
        return datetime.date(int(year), _MONTHS[month.lower()], int(day))
    except (KeyError, ValueError):
        return None


# ---------------------------------------------------------------------------------------------------------- lists


def _marked(text: str, marker: re.Pattern, accept) -> tuple[str, list[tuple[str, str]]]:
    found = list(marker.finditer(text))
    if not found:
        return text, []
    ends = [m.start() for m in found[1:]] + [len(text)]
    begins: list[list] = []  # label, begin, end of each entry
    intro_end = found[0].start()
    for m, end in zip(found, ends, strict=True):
        label = m[1].lower()
        if accept is None or accept(label, len(begins), text, m.end()):
            begins.append([label, m.end(), end])
        elif begins:
            begins[-1][2] = end
        else:
            intro_end = end
    return text[:intro_end], [(label, text[a:b]) for label, a, b in begins]


def _letters(label: str, last: int, text: str, after: int) -> bool:
    return ord(label) - 97 == last and (last == 0 or label not in "ivx" or not _GOES_ON.search(text, after, after + markers.LOOK_AHEAD))


def _romans(label: str, last: int, text: str, after: int) -> bool:
    return _ORDER[label] == last


def _numbers(label: str, last: int, text: str, after: int) -> bool:
    return len(label) <= 18 and int(label) == last + 1


def _kept(entries: list[tuple[str, str]]) -> list[tuple[str, str]]:
    return [(label, s) for label, t in entries if (s := strip(t))]


def _subpoints(t: str) -> tuple[str, list[tuple[str, str]]]:
    if "(" in t:
        for marker, accept in ((_LETTER, _letters), (_ROMAN, _romans)):
            intro, entries = _marked(t, marker, accept)
            if kept := _kept(entries):
                return strip(intro), kept
    return t, []


def _note(text: str) -> tuple[str, str | None]:
    if (m := _NOTE.search(text)) and (main := strip(text[: m.start()])):
        return main, strip(text[m.end() :])
    return text, None


def _category(p: str) -> tuple[str, str | None]:
    bare = strip(p.rstrip(":"))
    head = strip(m[1]) if (m := _COMMA.search(bare)) else ""
    cut = head != "" and len(head.split(" ")) <= 12
    return ("" if p == "" else head if cut else bare), (p if p != "" and (cut or p.endswith(":")) else None)


def _item(number: str | None, category: str | None, intro: str | None, text: str | None, subpoints: list | None) -> dict:
    return {"number": number, "label": None, "category": category, "intro": intro, "text": text, "subpoints": subpoints, "references": None, "cited_act": None}


def nested_item(number: str, t: str) -> dict:
    prefix, subs = _subpoints(t)
    if subs:
        category, intro = _category(prefix)
        notes = [(label, *_note(s)) for label, s in subs]
        return _item(number, category or None, intro, None, [{"label": label, "text": main, "note": note, "references": None} for label, main, note in notes])
    if (m := _TITLED.search(t)) and (c := strip(m[1])):
        return _item(number, c, None, f"{c}: {strip(m[2])}", [])
    return _item(number, None, None, t, [])


def _indexed(nodes: list[dict]) -> list[dict]:
    return [{"index": n} | x for n, x in enumerate(nodes, 1)]


# ---------------------------------------------------------------------------------------------------------- trees


def _parsed(**fields) -> dict:
    return dict.fromkeys(("intro", "text", "references", "paragraphs", "items", "sections", "closing")) | fields


#: The tree of an annex that has no lines after its title.
NOTHING = _parsed()


def _paragraph(number: str | None, intro: str | None, text: str | None, points: list | None) -> dict:
    return {"number": number, "intro": intro, "text": text, "points": points}


def _closing(body: str, done_at: re.Pattern, signature: re.Pattern) -> tuple[str, dict | None]:
    m = done_at.search(body)
    if not m:
        return body, None
    day = long_date(m[2])
    names = [{"body": s[1], "role": "President", "name": normalize_text(s[2])} for s in signature.finditer(strip(body[m.end() :]))]
    return strip(body[: m.start()]), {"place": strip(m[1]), "date": day.isoformat() if day else strip(m[2]), "signatories": names}


def _numbered(label: str, t: str) -> dict:
    intro, entries = _marked(t, _LETTER, _letters)
    points = []
    for name, text in _kept(entries):
        prefix, subs = _subpoints(text)
        points.append({"label": name, "text": prefix if subs else text, "subpoints": [{"label": a, "text": b, "references": None} for a, b in subs], "references": None})
    return _paragraph(label, strip(intro) or None, None, points) if points else _paragraph(label, None, t, None)


def _unnumbered(body: str, after_list: re.Pattern, fix_last_point: bool) -> list[dict]:
    if body == "":
        return []
    intro, entries = _marked(body, _LETTER, _letters)
    if not entries:
        return _indexed([_paragraph(None, None, body, None)])
    points = [{"label": label, "text": strip(t), "subpoints": None, "references": None} for label, t in entries]
    trailing = points[-1]["text"]
    m = after_list.search(trailing)
    if trailing and not fix_last_point:
        points[-1]["text"] = f"{trailing} {trailing[: m.start()] + ';' if m else trailing}"
    before = strip(intro)
    however = _HOWEVER.search(before) is not None
    lead = strip(_HOWEVER_END.sub("", before)) if however else before
    head = [_paragraph(None, None, lead, None)] if lead else []
    rest = strip(trailing[m.end() :]) if m else ""
    tail = [_paragraph(None, None, rest, None)] if rest else []
    return _indexed([*head, _paragraph(None, "However:" if however else None, None, points), *tail])


def article(lines: list[str], grammar: tuple, fix_last_point: bool) -> dict:
    """Tree of an article's lines after its title."""
    done_at, signature, after_list = grammar
    text, closing = _closing(normalize_text(" ".join(lines)), done_at, signature)
    _, entries = _marked(text, _NUMBER, None)
    if entries:
        return _parsed(paragraphs=_indexed([_numbered(label, strip(t)) for label, t in entries]), closing=closing)
    intro, entries = _marked(text, _PAREN, _numbers)
    if len(entries) >= markers.LEAST_NUMBERS and (kept := _kept(entries)):
        return _parsed(intro=strip(intro), items=_indexed([nested_item(label, t) for label, t in kept]), closing=closing)
    return _parsed(paragraphs=_unnumbered(text, after_list, fix_last_point), closing=closing)


def annex(lines: list[str]) -> dict:
    """Tree of an annex's lines after its title."""
    at = [n for n, x in enumerate(lines) if _SECTION_CUT.match(x)]
    sections = []
    for a, b in zip(at, [*at[1:], len(lines)], strict=False):
        if m := _SECTION_LINE.search(lines[a]):
            text = normalize_text(" ".join(lines[a + 1 : b]) + " " * (b < len(lines)))
            items = [nested_item(label, t) for label, t in _kept(_marked(text, _NUMBER, None)[1])]
            sections.append({"label": m[1].upper(), "title": normalize_text(m[2]), "items": _indexed(items)})
    if sections:
        return _parsed(sections=sections)
    t = normalize_text(" ".join(lines))
    intro, entries = _marked(t, _NUMBER, None)
    if entries:
        return _parsed(intro=strip(intro) or None, items=_indexed([nested_item(label, x) for label, x in _kept(entries)]))
    intro, entries = _marked(t, _DASH, None)
    if entries:
        return _parsed(intro=strip(intro) or None, items=_indexed([_item(None, None, None, x, None) for _, x in _kept(entries)]))
    return _parsed(text=t or None)


# ----------------------------------------------------------------------------------------------------- references


def _reference(kind: str, target: str, paragraph: str | None = None, subparagraph: str | None = None, point: str | None = None, subpoint: str | None = None) -> dict:
    low = lambda x: x.lower() if x else None
    return {"type": kind, "target": target, "paragraph": paragraph or None, "subparagraph": low(subparagraph), "point": low(point), "subpoint": low(subpoint)}


def references(text: str | None) -> list[dict] | None:
    """References of a text, or None."""
    if not text:
        return None
    out = [_reference("section", f"{m[1].upper()}.{m[2]}") for m in _SECTION.finditer(text)]
    out += [_reference("article", *m.groups()) for m in _ARTICLE.finditer(text)]
    out += [_reference("chapter", m[1].upper()) for m in _CHAPTER.finditer(_SECTION.sub(" ", text) if out else text)]
    return out or None


def cited_act(text: str | None) -> dict | None:
    """The act that a text ends with, or None."""
    if text is None or not (m := _CITED.search(normalize_text(text))):
        return None
    title = m[4].strip(" ") if m[4] else None
    day = long_date(normalize_text(m[3])) if m[3] else None
    short = title if title is not None and len(title) <= refs.TITLE_LIMIT else None
    return {"kind": m[1].lower(), "identifier": m[2], "date": day, "short_title": short, "oj_reference": m[5].strip(" ") if m[5] else None}


def refer(tree: dict, in_annex: bool) -> dict:
    """Puts references and cited acts into a tree.

    None where there are none. A point's are those of its whole text, its subpoints included; items with subpoints leave
    theirs to these, and items of dash lists have none.
    """
    for paragraph in tree["paragraphs"] or ():
        for x in paragraph["points"] or ():
            subs = x["subpoints"] or ()
            x["references"] = references(x["text"] + "".join(f" ({s['label']}) {s['text']}" for s in subs))
            for s in subs:
                s["references"] = references(s["text"])
    for items in (tree["items"] or (), *(s["items"] for s in tree["sections"] or ())):
        for x in items:
            if x["subpoints"]:
                for s in x["subpoints"]:
                    s["references"] = references(s["text"] if s["note"] is None else f"{s['text']} {s['note']}")
            elif x["number"] is not None:
                x["references"], x["cited_act"] = references(x["text"]), cited_act(x["text"])
    if in_annex and tree["items"] is not None:
        tree["references"] = references(tree["intro"])
    return tree
