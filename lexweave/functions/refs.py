"""References to articles, sections and chapters, and cited acts, in running text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .textnorm import WS, let, normalize_text

# Grammars of references and cited acts.
ORDINALS = "first|second|third|fourth|fifth|sixth|seventh|eighth|ninth|tenth"
ARTICLE = (
    rf"(?i)\bArticle[{WS}]+([0-9]+[A-Za-z]?)(?:\(([0-9]+)\))?(?:[{WS}]*,?[{WS}]*({ORDINALS})[{WS}]+subparagraph)?"
    rf"(?:[{WS}]*,?[{WS}]*point[{WS}]*\(([a-z])\))?(?:[{WS}]*\(([ivxlcdm]+)\))?"
)
SECTION = rf"(?i)\bChapter[{WS}]+([IVXLCDM]+)[{WS}]+Section[{WS}]+([0-9]+)"
CHAPTER = rf"(?i)\bChapter[{WS}]+([IVXLCDM]+)"
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
CITED = (
    rf"(?i)\b(Directive|Regulation|Decision)[{WS}]+([0-9]{{4}}/[0-9]+/(?:EC|EU|EEC|EURATOM))"
    rf"(?:.*?\b([0-9]{{1,2}}[{WS}]+(?:{MONTHS})[{WS}]+[0-9]{{4}}))?(?:.*?\bon[{WS}]+([^;]+?))?(?:[{WS}]*\((OJ[{WS}]+[^)]+)\))?\z"
)
TITLE_LIMIT = 120

FIELDS = ("type", "target", "paragraph", "subparagraph", "point", "subpoint")


def _reference(kind: str, target: Column, *rest: Column) -> Column:
    parts = [F.nullif(c, F.lit("")) for c in rest] + [F.lit(None).cast("string")] * (4 - len(rest))
    return F.struct(F.lit(kind).alias("type"), target.alias("target"), *(p.alias(n) for p, n in zip(parts, FIELDS[2:], strict=True)))


REFERENCES = "array<struct<type:string,target:string,paragraph:string,subparagraph:string,point:string,subpoint:string>>"
ACT = "struct<kind:string,identifier:string,date:date,short_title:string,oj_reference:string>"

_CUT = "\x01"


def _groups(match: Column, pattern: str, n: int) -> Column:
    """The groups of a text that matches as a whole, by one more match; a group that took no part is empty."""
    return F.split(F.regexp_replace(match, rf"\A(?:{pattern})\z".replace("\\z)\\z", "\\z)"), _CUT.join(f"${k}" for k in range(1, n + 1))), _CUT, -1)


def _all_groups(text: Column, pattern: str, n: int) -> Column:
    """The groups of every match in a text; a group that took no part is empty."""
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: _groups(m, pattern, n))


def references(text: Column) -> Column:
    """All references of a text: those to sections, then those to articles, then those to chapters outside the section ones."""
    none = F.array().cast(REFERENCES)

    def article(g: Column) -> Column:
        return _reference("article", F.get(g, F.lit(0)), F.get(g, F.lit(1)), F.lower(F.get(g, F.lit(2))), F.lower(F.get(g, F.lit(3))), F.lower(F.get(g, F.lit(4))))

    sections = F.transform(_all_groups(text, SECTION, 2), lambda g: _reference("section", F.concat(F.upper(F.get(g, F.lit(0))), F.lit("."), F.get(g, F.lit(1)))))
    chapters = F.transform(F.regexp_extract_all(F.regexp_replace(text, SECTION, " "), F.lit(CHAPTER), F.lit(1)), lambda a: _reference("chapter", F.upper(a)))
    articles = F.transform(_all_groups(text, ARTICLE, 5), article)
    chaptered, with_article = text.rlike("(?i)chapter"), text.rlike("(?i)article")
    return F.concat(F.when(chaptered, sections).otherwise(none), F.when(with_article, articles).otherwise(none), F.when(chaptered, chapters).otherwise(none))


def cited_act(text: Column) -> Column:
    """struct(kind, identifier, date, short_title, oj_reference) of the act that a text ends with, or null."""

    def build(m: Column) -> Column:
        def act(g: Column) -> Column:
            part = lambda n: F.nullif(F.get(g, F.lit(n)), F.lit(""))
            title = F.trim(part(3))
            return F.struct(
                F.lower(part(0)).alias("kind"), part(1).alias("identifier"),
                F.try_to_date(F.initcap(F.lower(F.regexp_replace(part(2), rf"[{WS}]+", " "))), "d MMMM yyyy").alias("date"),
                F.when(F.length(title) <= TITLE_LIMIT, title).alias("short_title"), F.trim(part(4)).alias("oj_reference"),
            )

        return F.when(m != "", let(_groups(m, CITED, 5), act))

    return let(F.regexp_extract(normalize_text(text), CITED, 0), build)
