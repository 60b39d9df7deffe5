"""Legal documents as articles and annexes. One row a document in, one row an element out; nothing is shuffled."""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from ..functions import trees
from ..functions.refs import ACT, REFERENCES, references
from ..functions.textnorm import ANNEX_LINE, ARTICLE_LINE, CHAPTER_LINE, SECTION_LINE, WS, built_once, clean_line, let, long_date, normalize_text, roman_to_int, split_lines, strip
from .generic import with_ids
from .tables import BLOCK, make_block, parse_table

_SEP = "\x01"  # stands for the line breaks within a table, which is one line to the parser
_BOUNDARY = rf"(?dmi)(?=^(?:CHAPTER[{WS}&&[^\n]]+[IVXLCDM]+|Article[{WS}&&[^\n]]+[0-9]+[A-Za-z]?|ANNEX[{WS}&&[^\n]]+[IVXLCDM]+)$)"
_ITEM = (
    f"struct<index:int,number:string,label:string,category:string,intro:string,text:string,"
    f"subpoints:array<struct<label:string,text:string,note:string,references:{REFERENCES}>>,references:{REFERENCES},cited_act:{ACT}>"
)
_POINT = f"struct<label:string,text:string,subpoints:array<struct<label:string,text:string,references:{REFERENCES}>>,references:{REFERENCES}>"
_PARAGRAPH = f"struct<index:int,number:string,intro:string,text:string,points:array<{_POINT}>>"
_SECTION = f"struct<label:string,title:string,items:array<{_ITEM}>>"
_CLOSING = "struct<place:string,date:string,signatories:array<struct<body:string,role:string,name:string>>>"
PARSED = f"struct<intro:string,text:string,references:{REFERENCES},paragraphs:array<{_PARAGRAPH}>,items:array<{_ITEM}>,sections:array<{_SECTION}>,closing:{_CLOSING}>"

# The closing formula, signatures, and what begins a new paragraph after a list.
DONE_AT = rf"(?i)Done[{WS}]+at[{WS}]+(.+?),[{WS}]+([0-9]{{1,2}}[{WS}]+\w+[{WS}]+[0-9]{{4}})\."
SIGNATURE = rf"(?i)For[{WS}]+the[{WS}]+(European Parliament|Council)[{WS}]+The[{WS}]+President[{WS}]+([A-Z]\.[{WS}]*[A-ZÀ-ÖØ-Ý]+)"
AFTER_LIST = rf"(?i);[{WS}]*(?=(?:This Regulation|The Commission|The Member States|Member States)\b)"


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def cleaned_lines(text: Column) -> Column:
    """Cleaned lines that are not blank; the lines of a table are one line, led by a pipe."""
    flat = F.array_join(F.transform(split_lines(text), lambda x: F.when(strip(x).startswith("|"), strip(x)).otherwise(x)), "\n")
    tables_joined = F.regexp_replace(flat, r"(?dm)^(\|[^\n]*)\n(?=\|)", f"$1{_SEP}")
    return F.filter(F.transform(F.split(tables_joined, "\n", -1), lambda x: F.when(x.startswith("|"), x).otherwise(clean_line(x))), lambda x: x != "")


def parse_closing(body: Column) -> Column:
    """struct(remaining, closing) of an article's body."""

    def build(parts: Column) -> Column:
        place, day = F.regexp_extract(body, DONE_AT, 1), F.regexp_extract(body, DONE_AT, 2)
        after = strip(F.get(parts, F.lit(1)))
        names = F.zip_with(
            F.regexp_extract_all(after, F.lit(SIGNATURE), F.lit(1)), F.regexp_extract_all(after, F.lit(SIGNATURE), F.lit(2)),
            lambda b, n: F.struct(b.alias("body"), F.lit("President").alias("role"), normalize_text(n).alias("name")),
        )
        closing = F.struct(strip(place).alias("place"), F.coalesce(long_date(day), strip(day)).alias("date"), names.alias("signatories"))
        found = F.size(parts) == 2
        return F.struct(F.when(found, strip(F.get(parts, F.lit(0)))).otherwise(body).alias("remaining"), F.when(found, closing).alias("closing"))

    return let(F.split(body, DONE_AT, 2), build)


@lru_cache(maxsize=1)
def _grammar() -> tuple:
    return tuple(map(trees.compiled, (DONE_AT, SIGNATURE, AFTER_LIST)))


def _tree_batch(kind: pa.DataType, fix_last_point: bool, refer: bool, types: pa.Array, proses: pa.Array) -> pa.Array:
    out: list[dict | None] = []
    for what, lines in zip(types.to_pylist(), proses.to_pylist(), strict=True):
        if what not in ("article", "annex"):
            out.append(None)
            continue
        annex = what == "annex"
        tree = trees.article(lines[1:], _grammar(), fix_last_point) if not annex else trees.annex(lines[1:]) if len(lines) > 1 else trees.NOTHING
        out.append(trees.refer(tree, annex) if refer else tree)
    return pa.array(out, kind)


def parsed_tree(types: Column, prose: Column, fix_last_point: bool = False, refer: bool = True) -> Column:
    """Trees of articles and annexes from their type and their lines, the title first; null for other types.

    An article's are numbered paragraphs, else a definitions list, else unnumbered paragraphs, and the closing; an annex's
    are lettered sections, else numbered items, else a dash list, else text. The last point of a body without numbers ends it
    and, as results are fixed to, is given twice; ``fix_last_point`` gives it once. ``refer`` puts in references and cited
    acts. It says it isn't deterministic, so that a filter on what follows from it does not parse once more.
    """
    kind = to_arrow_type(StructType.fromDDL(PARSED.removeprefix("struct<")[:-1]))

    def run(t: pa.Array, p: pa.Array) -> pa.Array:
        return _tree_batch(kind, fix_last_point, refer, t, p)

    run.__annotations__ = {"t": pa.Array, "p": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, PARSED).asNondeterministic()(types, prose)


# --------------------------------------------------------------------------------------------------------- blocks


def _label(number: Column, label: Column) -> Column:
    return F.coalesce(F.concat(number, F.lit(".")), F.concat(F.lit("("), F.nullif(label, F.lit("")), F.lit(")")))


def _first(*texts: Column) -> Column:
    return F.coalesce(*(F.nullif(t, F.lit("")) for t in texts), F.lit(""))


def _rendered(label: Column, text: Column, note: Column) -> Column:
    noted = F.when(F.coalesce(note, F.lit("")) == "", text).when(text == "", note).otherwise(F.concat(text, F.lit(" ("), note, F.lit(")")))
    return F.when(label.isNull(), noted).otherwise(strip(F.concat(label, F.lit(" "), noted)))


def _sub_list(subs: Column, noted: bool) -> Column:
    """One list block of subpoints."""
    items = F.filter(F.transform(subs, lambda s: _rendered(_label(_null("string"), s["label"]), _first(s["text"]), s["note"] if noted else _null("string"))), lambda x: x != "")
    return F.when(F.size(items) > 0, F.array(make_block("list", ordered=F.lit(False), items=items))).otherwise(_none())


def _paragraph_block(text: Column) -> Column:
    return F.array(make_block("paragraph", text=text))


def _none() -> Column:
    return F.slice(F.array(make_block("paragraph")), 1, 0)


def _node_list(nodes: Column, label_of, text_of, noted: bool, numbered) -> Column:
    """Blocks of a list of points or items: one list, or a header and nested blocks for each."""
    deep = lambda n: F.size(F.coalesce(n["subpoints"], F.array())) > 0
    flat = F.filter(F.transform(nodes, lambda n: _rendered(label_of(n), text_of(n), _null("string"))), lambda x: x != "")
    one_list = F.when(F.size(flat) > 0, F.array(make_block("list", ordered=F.exists(nodes, numbered), items=flat))).otherwise(_none())

    def node(n: Column) -> Column:
        header = F.array_join(F.filter(F.array(label_of(n), text_of(n)), lambda x: F.coalesce(x, F.lit("")) != ""), " ")
        head = F.when(header != "", _paragraph_block(header)).otherwise(_none())
        leaf = let(_rendered(label_of(n), text_of(n), _null("string")), lambda t: F.when(strip(t) != "", _paragraph_block(t)).otherwise(_none()))
        return F.when(deep(n), F.concat(head, _sub_list(n["subpoints"], noted))).otherwise(leaf)

    return F.when(F.coalesce(F.size(nodes), F.lit(0)) <= 0, _none()).when(F.exists(nodes, deep), F.flatten(F.transform(nodes, node))).otherwise(one_list)


def _point_list(points: Column) -> Column:
    return _node_list(points, lambda n: _label(_null("string"), n["label"]), lambda n: _first(n["text"]), False, lambda n: F.lit(False))


def _item_list(items: Column) -> Column:
    return _node_list(items, lambda n: _label(n["number"], n["label"]), lambda n: _first(n["text"], n["category"], n["intro"]), True, lambda n: n["number"].isNotNull())


def closing_text(closing: Column) -> Column:
    """A closing formula as text."""
    done = F.concat(F.lit("Done at "), closing["place"], F.lit(", "), closing["date"])
    signed = F.transform(closing["signatories"], lambda s: F.concat_ws(", ", s["body"], s["role"], s["name"]))
    return F.array_join(F.concat(F.array(done), signed), " ")


def element_blocks(p: Column, tables: Column) -> Column:
    """Blocks, without ids, of a parsed element, its tables last."""
    text = lambda c: F.when(F.coalesce(c, F.lit("")) != "", _paragraph_block(c)).otherwise(_none())

    def paragraph(x: Column) -> Column:
        label = F.concat(F.nullif(x["number"], F.lit("")), F.lit("."))
        body = F.coalesce(F.nullif(x["text"], F.lit("")), F.nullif(x["intro"], F.lit("")))
        shown = F.when(label.isNull(), body).otherwise(strip(F.concat(label, F.lit(" "), body)))
        return F.concat(F.when(body.isNotNull(), _paragraph_block(shown)).otherwise(_none()), _point_list(x["points"]))

    def section(s: Column) -> Column:
        header = F.array_join(F.filter(F.array(_label(_null("string"), s["label"]), s["title"]), lambda x: F.coalesce(x, F.lit("")) != ""), " ")
        return F.concat(F.when(header != "", _paragraph_block(header)).otherwise(_none()), _item_list(s["items"]))

    many = lambda xs, f: F.coalesce(F.flatten(F.transform(xs, f)), _none())
    closing = F.when(p["closing"].isNotNull(), _paragraph_block(closing_text(p["closing"]))).otherwise(_none())
    boxed = F.transform(F.filter(F.transform(tables, lambda t: parse_table(F.split(t, _SEP))), lambda t: t.isNotNull()), lambda t: make_block("table", table=t))
    return F.concat(text(p["intro"]), text(p["text"]), many(p["paragraphs"], paragraph), _item_list(p["items"]), many(p["sections"], section), closing, boxed)


# ------------------------------------------------------------------------------------------------------- elements


def segments(docs: DataFrame) -> DataFrame:
    """(doc_id, seq, type, number, chapter, lines) of every article and annex of documents (doc_id, text).

    What stands before the first marker is left out. ``chapter`` is that of the last chapter line before an article, its
    title the line after it, whatever that is; it goes on over annexes. Lines are cleaned and still hold tables.
    """
    df = with_parts(docs.select("doc_id", cleaned_lines(F.col("text")).alias("lines")))
    out = df.select("doc_id", F.posexplode_outer("parts").alias("seq", "p")).where("p is not null")
    return out.select("doc_id", (F.col("seq") + 1).alias("seq"), "p.type", "p.number", "p.chapter", "p.lines")


def with_parts(df: DataFrame) -> DataFrame:
    """``df`` with ``parts``, the articles and annexes of its ``lines``, in place of these: struct(type, number, lines, chapter)."""
    parts = F.filter(F.split(F.array_join("lines", "\n"), _BOUNDARY, -1), lambda s: F.regexp_extract(s, r"\A[^\n]*", 0).rlike(rf"{CHAPTER_LINE}|{ARTICLE_LINE}|{ANNEX_LINE}"))

    def typed(s: Column) -> Column:
        first, lines = F.regexp_extract(s, r"\A[^\n]*", 0), F.filter(F.split(F.regexp_replace(s, r"\A[^\n]*\n?", ""), "\n", -1), lambda x: x != "")
        kind = F.when(first.rlike(CHAPTER_LINE), "chapter").when(first.rlike(ARTICLE_LINE), "article").otherwise("annex")
        number = F.when(kind == "chapter", F.upper(F.regexp_extract(first, CHAPTER_LINE, 1))).when(kind == "article", F.regexp_extract(first, ARTICLE_LINE, 1)).otherwise(F.upper(F.regexp_extract(first, ANNEX_LINE, 1)))
        return F.struct(kind.alias("type"), number.alias("number"), lines.alias("lines"))

    df = df.withColumn("parts", F.transform(parts, typed)).drop("lines")
    chapters = F.transform("parts", lambda p, i: F.when(p["type"] == "chapter", F.struct(i.alias("at"), p["number"].alias("number"), normalize_text(F.get(p["lines"], F.lit(0))).alias("title"))))
    df = df.withColumn("chapters", F.filter(chapters, lambda c: c.isNotNull()))
    # spans between chapters, each cut out whole: every part is touched once
    spans = F.transform("chapters", lambda c, k: F.struct(c.alias("c"), (F.coalesce(F.get("chapters", k + 1)["at"], F.size("parts")) - c["at"]).alias("n")))
    before = F.transform(F.slice("parts", 1, F.coalesce(F.get("chapters", F.lit(0))["at"], F.size("parts"))), lambda p: p.withField("chapter", _null("struct<number:string,title:string>")))

    def within(s: Column) -> Column:
        chapter = F.struct(s["c"]["number"].alias("number"), s["c"]["title"].alias("title"))
        return F.transform(F.slice("parts", s["c"]["at"] + 1, s["n"]), lambda p: p.withField("chapter", F.when(p["type"] == "article", chapter)))

    each = F.filter(F.concat(before, F.flatten(F.transform(spans, within))), lambda p: p["type"] != "chapter")
    return df.withColumn("parts", each).drop("chapters")


@built_once
def _blocks() -> tuple[Column, ...]:
    """The blocks, from parsed and tables."""
    return (let(F.col("parsed"), lambda p: element_blocks(p, F.col("tables"))),)


def elements(docs: DataFrame, fix_last_point: bool = False) -> DataFrame:
    """Articles and annexes of documents (doc_id, text) with id, title, chapter, parsed tree and blocks."""
    none = {"level": "int", "title": "string", "path": "array<string>", "blocks": f"array<{BLOCK}>"}
    return parsed_parts(segments(docs).withColumns({c: _null(t) for c, t in none.items()}), fix_last_point)


def parsed_parts(df: DataFrame, fix_last_point: bool = False, tree: bool = True) -> DataFrame:
    """Elements from parts (doc_id, seq, type, number, chapter, lines, level, title, path, blocks); other columns are kept.

    Articles and annexes are parsed from their lines; sections come with title, path and blocks and have no tree. Who needs
    only the blocks may leave out the ``tree``, whose column ``parsed`` has the references.
    """
    law = F.col("type") != "section"
    prose = F.filter("lines", lambda x: ~x.startswith("|"))
    tables = F.filter("lines", lambda x: x.startswith("|"))
    tail = F.when(F.col("type") == "article", F.concat(F.lit("art"), "number")).when(law, F.concat(F.lit("annex"), roman_to_int(F.col("number")).cast("string"))).otherwise(F.concat(F.lit("sec"), F.col("seq").cast("string")))
    df = df.withColumns({"id": F.concat("doc_id", F.lit(":"), tail), "prose": prose, "tables": tables}).drop("lines")
    title = F.when(law, normalize_text(F.get("prose", F.lit(0)))).otherwise(F.col("title"))
    df = df.withColumns({"title": title, "parsed": parsed_tree(F.col("type"), F.col("prose"), fix_last_point, tree)})
    df = df.withColumn("blocks", with_ids(F.when(law, _blocks()[0]).otherwise(F.col("blocks")), F.col("id")))
    return (df if tree else df.withColumn("parsed", F.lit(None).cast(PARSED))).drop("prose", "tables")


def element_references(df: DataFrame) -> DataFrame:
    """(doc_id, id, place, reference fields) of every reference in the texts of elements' blocks."""
    b = df.select("doc_id", "id", F.explode("blocks").alias("b")).select("doc_id", "id", F.col("b.id").alias("block_id"), F.coalesce("b.text", F.array_join("b.items", " ")).alias("text"))
    return b.select("doc_id", "id", "block_id", F.posexplode(references(F.col("text"))).alias("place", "r")).select("doc_id", "id", "block_id", (F.col("place") + 1).alias("place"), "r.*")
