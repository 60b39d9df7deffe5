"""Text normalisation as Column expressions; all stay in the JVM.

White space means Unicode white space and the separators U+001C to U+001F. Null gives null, empty gives empty, unless a
function says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Inside of a character class: Unicode white space. One property is tested much faster than a list of ranges.
WS = r"\p{IsWhite_Space}\x1c-\x1f"
#: The characters of that class.
WS_CHARS = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: A line break.
BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
#: Fixed value: the special spaces that become plain ones.
SPECIAL_SPACES = "\u00a0\u2009\u200a\u202f"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def built_once(build: Callable[..., tuple[Column, ...]]) -> Callable[..., tuple[Column, ...]]:
    """Keeps what ``build`` makes, by its arguments, for as long as the JVM lives: large expressions take seconds to build."""

    @lru_cache(maxsize=8)
    def kept(gateway: int, *args: object) -> tuple[Column, ...]:
        return build(*args)

    return lambda *args: kept(id(SparkContext._gateway), *args)


def strip(c: Column, *, chars: str = WS_CHARS) -> Column:
    """Without white space (or other characters) at both ends."""
    return F.btrim(c, F.lit(chars))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(WS_CHARS))


def collapse(c: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return strip(F.regexp_replace(c, rf"[{WS}&&[^ ]][{WS}]*| [{WS}]+", " "), chars=" ")  # single spaces are no matches


def split_lines(c: Column) -> Column:
    """Lines of a text, without one empty line after a last break; an empty text has none."""
    return let(F.split(c, BREAK, -1), lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0)))).otherwise(p))


# ------------------------------------------------------------------------------------------------------- cleaning


def unicode_whitespace(c: Column) -> Column:
    """CR LF and CR become LF; the special spaces become plain ones."""
    c = F.replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.regexp_replace(c, f"[{SPECIAL_SPACES}]", " ")


def line_whitespace(c: Column) -> Column:
    """Every line without white space at its end, joined by LF."""
    return F.array_join(F.transform(split_lines(c), rstrip), "\n")


def superscripts(c: Column) -> Column:
    """``<sup> x </sup>`` becomes x."""
    return F.regexp_replace(c, rf"(?s)<sup>[{WS}]*(.*?)[{WS}]*</sup>", "$1")


def empty_marker_lines(c: Column) -> Column:
    """Without lines that hold nothing but an emphasis sign."""
    return F.array_join(F.filter(split_lines(c), lambda x: ~strip(x).isin("**", "__", "*", "_")), "\n")


def blank_lines(c: Column) -> Column:
    """Two or more blank lines in a row become one."""
    return F.regexp_replace(c, r"\n{3,}", "\n\n")


def clean_markdown(c: Column) -> Column:
    """The whole cleaning, in fixed order."""
    return strip(blank_lines(empty_marker_lines(superscripts(line_whitespace(unicode_whitespace(c))))))


# ---------------------------------------------------------------------------------------------------------- lines


def clean_line(c: Column) -> Column:
    """A line without heading signs, bold signs and emphasis signs at its ends."""
    c = F.regexp_replace(strip(c), rf"\A#{{1,6}}[{WS}]*", "")
    c = F.replace(F.replace(c, F.lit("**"), F.lit("")), F.lit("__"), F.lit(""))
    return strip(strip(strip(c), chars="_*"))


def normalize_text(c: Column) -> Column:
    """Special spaces plain, no bullet before a marker such as ``(a)``, white space collapsed."""
    c = F.regexp_replace(c, f"[{SPECIAL_SPACES}]", " ")
    c = F.regexp_replace(c, rf"(?:[-–—•·][{WS}]+)+(?=\([a-zA-Z0-9]+\)[{WS}])", "")
    return collapse(c)


def strip_markdown(c: Column) -> Column:
    """Inline emphasis removed; a space is put where bold text touched a word."""
    bold = r"(?s)\*\*(.+?)\*\*"

    def unbold(text: Column, parts: Column, runs: Column) -> Column:
        def joined(run: Column, i: Column) -> Column:
            before, after = F.get(parts, i), F.get(parts, i + 1)
            at_start = (before == "") & (i == 0)
            at_end = (after == "") & (i == F.size(runs) - 1)
            lead = F.when(at_start | before.rlike(rf"[{WS}(\[{{\"']\z"), "").otherwise(" ")
            tail = F.when(at_end | after.rlike(rf"\A[{WS}.,;:!?)\]}}\"']"), "").otherwise(" ")
            return F.concat(lead, run, tail, after)

        return F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(runs, joined), ""))

    def apart(text: Column) -> Column:
        runs = F.regexp_extract_all(text, F.lit(bold), F.lit(1))
        return F.when(~text.contains("**"), text).otherwise(let(F.split(text, bold, -1), lambda p: let(runs, lambda r: unbold(text, p, r))))

    c = let(F.regexp_replace(c, r"<[bB][rR]\s*/?>", " "), apart)
    c = F.replace(F.replace(c, F.lit("**"), F.lit("")), F.lit("__"), F.lit(""))
    c = F.regexp_replace(c, rf"[{WS}]+([.,;:!?])", "$1")
    return collapse(c)  # a no-break space is white space too


def is_bold(c: Column) -> Column:
    """Whether a cell is bold as a whole."""
    s = strip(c)
    return (F.length(s) > 4) & s.startswith("**") & s.endswith("**")


def slugify(c: Column) -> Column:
    """Lower-case letters and digits joined by hyphens; ``doc`` if nothing is left or the value is null."""
    s = F.regexp_replace(F.regexp_replace(F.lower(strip(c)), r"[^a-z0-9]+", "-"), r"\A-+|-+\z", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("doc"))


def remove_list_separator(c: Column) -> Column:
    """Without one dash or bullet, and the white space around it, at the start."""
    return strip(F.regexp_replace(c, rf"\A[{WS}]*[-–—•·][{WS}]*", ""))


def roman_to_int(c: Column) -> Column:
    """Value of a Roman numeral, summed from the right; unknown letters count 0, nothing is validated."""
    value = F.create_map(*[F.lit(x) for kv in (("I", 1), ("V", 5), ("X", 10), ("L", 50), ("C", 100), ("D", 500), ("M", 1000)) for x in kv])
    letters = F.reverse(F.regexp_extract_all(F.upper(c), F.lit("(.)"), F.lit(1)))
    zero = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("prev"))

    def step(a: Column, x: Column) -> Column:
        v = F.coalesce(F.try_element_at(value, x), F.lit(0))
        total = F.when(v < a["prev"], a["sum"] - v).otherwise(a["sum"] + v)
        return F.struct(total.alias("sum"), v.alias("prev"))

    return F.aggregate(letters, zero, step, lambda a: a["sum"])


# Content types and the suffixes that files of these types get.
CONTENT_TYPES = {
    "application/pdf": ".pdf",
    "text/html": ".html",
    "application/xhtml+xml": ".html",
    "text/plain": ".txt",
    "application/xml": ".xml",
    "text/xml": ".xml",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": ".docx",
}
SUFFIXES = (".pdf", ".html", ".htm", ".txt", ".docx", ".xml")


def _url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"\A(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def detect_extension(content_type: Column, url: Column) -> Column:
    """Suffix for a download: by content type, else by the address, else ``.html``."""
    known = F.create_map(*[F.lit(x) for kv in CONTENT_TYPES.items() for x in kv])
    kind = strip(F.get(F.split(F.coalesce(content_type, F.lit("")), ";"), F.lit(0)))
    suffix = F.lower(F.regexp_extract(_url_path(url), r"[^/.](\.[^./]*)\z", 1))
    by_url = F.when(suffix == ".htm", ".html").when(suffix.isin(*SUFFIXES), suffix)
    return F.coalesce(F.try_element_at(known, kind), by_url, F.lit(".html"))


def build_filename(url: Column, extension: Column) -> Column:
    """Last part of the address without suffix, or ``downloaded_document``, with the extension."""
    name = F.regexp_extract(F.regexp_replace(_url_path(url), r"/+\z", ""), r"([^/]*)\z", 1)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*\z", "")
    return F.concat(F.coalesce(F.nullif(stem, F.lit("")), F.lit("downloaded_document")), extension)


# Fixed value: marks of text read from pictures.
PICTURE_TEXT = rf"(?s)<!--[{WS}]*Start of picture text[{WS}]*-->.*?<!--[{WS}]*End of picture text[{WS}]*-->"


def without_picture_text(c: Column) -> Column:
    """Without the text that was read from pictures."""
    return F.regexp_replace(c, PICTURE_TEXT, "")


def picture_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(PICTURE_TEXT))


def instrument(*fields: str) -> Column:
    """JSON of the bibliographic fields, nulls left out."""
    return F.to_json(F.struct(*(fields or ("celex", "eli", "title", "language", "publication_date"))))


def category_heading(prefix: Column, normal: bool = False) -> Column:
    """(category, intro) of the text before a nested list: before its first comma if that is at most 12 words, else before a last colon.

    ``normal`` says that the text is normalised already.
    """

    def build(p: Column, bare: Column, head: Column) -> Column:
        cut = (head != "") & (F.size(F.split(head, " ")) <= 12)
        category = F.when(p == "", F.lit("")).when(cut, head).otherwise(bare)
        return F.struct(category.alias("category"), F.when((p != "") & (cut | p.endswith(":")), p).alias("intro"))

    comma = rf"\A([^,]+),[{WS}]+.+\z"
    text = prefix if normal else normalize_text(prefix)
    return let(text, lambda p: let(strip(F.rtrim(p, F.lit(":"))), lambda b: let(strip(F.regexp_extract(b, comma, 1)), lambda h: build(p, b, h))))


# Fixed value: the openers of notes.
NOTE = rf"(?i)[{WS}]+(?=(?:This[{WS}]+(?:shall|does)[{WS}]+not[{WS}]+(?:include|apply)|except[{WS}]+that|except[{WS}]+where|provided[{WS}]+that|unless)\b)"


def subpoint_note(text: Column) -> Column:
    """(main, note): the text cut at its first note opener, unless nothing would stand before it."""

    def build(parts: Column) -> Column:
        main = strip(F.get(parts, F.lit(0)))
        cut = (F.size(parts) == 2) & (main != "")
        return F.struct(F.when(cut, main).otherwise(text).alias("main"), F.when(cut, strip(F.get(parts, F.lit(1)))).alias("note"))

    return let(F.split(text, NOTE, 2), build)


def long_date(c: Column) -> Column:
    """``13 June 2024`` as an ISO date; null if it is none."""
    return F.try_to_date(F.initcap(F.lower(collapse(c))), "d MMMM yyyy").cast("string")


# ----------------------------------------------------------------------------------------------------- predicates

# Line grammars.
CHAPTER_LINE = rf"(?i)\ACHAPTER[{WS}]+([IVXLCDM]+)\z"
ARTICLE_LINE = rf"(?i)\AArticle[{WS}]+([0-9]+[A-Za-z]?)\z"
ANNEX_LINE = rf"(?i)\AANNEX[{WS}]+([IVXLCDM]+)\z"
SECTION_LINE = rf"(?i)\ASection[{WS}]+([A-Z])\.[{WS}]*(.+)\z"
HEADING_LINE = rf"\A(#{{1,6}})[{WS}]+(.*[^{WS}].*)\z"
ORDERED_LINE = rf"\A[0-9]+[.)][{WS}]+(.*[^{WS}].*)\z"
UNORDERED_LINE = rf"\A[-*•·][{WS}]+(.*[^{WS}].*)\z"


def line_kind(line: Column) -> Column:
    """Kind of a cleaned line in a legal document."""
    return (
        F.when(line.rlike(CHAPTER_LINE), "chapter").when(line.rlike(ARTICLE_LINE), "article").when(line.rlike(ANNEX_LINE), "annex")
        .when(line.rlike(SECTION_LINE), "section").when(line.startswith("|"), "table").otherwise("text")
    )


def markdown_kind(line: Column) -> Column:
    """Kind of a stripped line in a Markdown document."""
    return (
        F.when(line == "", "blank").when(line.rlike(HEADING_LINE), "heading").when(line.startswith("|"), "table")
        .when(line.rlike(ORDERED_LINE), "ordered").when(line.rlike(UNORDERED_LINE), "unordered").otherwise("text")
    )


def article_lines(text: Column) -> Column:
    """Number of article lines of a text."""
    return F.size(F.filter(split_lines(text), lambda x: clean_line(x).rlike(ARTICLE_LINE)))
