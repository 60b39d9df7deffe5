"""DuckDB SQL for text functions: an independent second reading of their rules, for the checks."""

from __future__ import annotations

from ..functions import textnorm
from ..functions.textnorm import BREAK

#: Inside of a character class of RE2's grammar: Unicode white space.
WS = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def q(text: str) -> str:
    """A SQL string literal; in patterns the white space class is put into RE2's grammar."""
    text = text.replace(textnorm.WS, WS)
    return "'" + text.replace("'", "''") + "'"


def sub(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(to)}, 'g')"


def strip(x: str, chars: str = WS) -> str:
    return sub(sub(x, rf"\A[{chars}]+"), rf"[{chars}]+\z")


def collapse(x: str) -> str:
    return f"trim({sub(x, rf'[{WS}]+', ' ')}, ' ')"


def lines_cheap(x: str) -> str:
    """As ``lines``, for texts whose breaks have been made LF."""
    return f"CASE WHEN {x} = '' THEN []::VARCHAR[] WHEN ends_with({x}, chr(10)) THEN string_split(left({x}, length({x}) - 1), chr(10)) ELSE string_split({x}, chr(10)) END"


def breaks_to_lf(x: str) -> str:
    return sub(x, BREAK, "\n")


def unicode_whitespace(x: str) -> str:
    return f"translate(replace({x}, chr(13) || chr(10), chr(10)), chr(13) || chr(160) || chr(8201) || chr(8202) || chr(8239), chr(10) || '    ')"


def line_whitespace(x: str) -> str:
    end = rf"[{WS}]+\z"
    return f"array_to_string(list_transform({lines_cheap(breaks_to_lf(x))}, lambda v: {sub('v', end)}), chr(10))"


def superscripts(x: str) -> str:
    return sub(x, rf"(?s)<sup>[{WS}]*(.*?)[{WS}]*</sup>", r"\1")


def empty_marker_lines(x: str) -> str:
    kept = f"list_filter({lines_cheap(breaks_to_lf(x))}, lambda v: {strip('v')} NOT IN ('**', '__', '*', '_'))"
    return f"array_to_string({kept}, chr(10))"


def blank_lines(x: str) -> str:
    return sub(x, r"\n{3,}", "\n\n")


def clean_line(x: str) -> str:
    x = sub(strip(x), rf"\A#{{1,6}}[{WS}]*")
    x = strip(f"replace(replace({x}, '**', ''), '__', '')")
    return strip(sub(sub(x, r"\A[_*]+"), r"[_*]+\z"))


def normalize_text(x: str) -> str:
    x = f"translate({x}, chr(160) || chr(8201) || chr(8202) || chr(8239), '    ')"
    return collapse(sub(x, rf"[-–—•·][{WS}]+(\([a-zA-Z0-9]+\)[{WS}])", r"\1"))


def slugify(x: str) -> str:
    return f"coalesce(nullif(trim({sub(f'lower({strip(x)})', r'[^a-z0-9]+', '-')}, '-'), ''), 'doc')"
