"""Markdown documents as sections of blocks. One row a document in, one row a section out; nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.textnorm import built_once, let, markdown_kind, picture_count, split_lines, strip, strip_markdown, without_picture_text
from .tables import make_block, parse_table

_GAP = r"[\p{IsWhite_Space}\x1f&&[^\n]]"
_HEADING = rf"\A(#{{1,6}}){_GAP}+([^\n]*\S[^\n]*)"


def line_table(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, raw, line, kind) of every line, ``line`` stripped."""
    df = docs.select("doc_id", F.posexplode(split_lines(F.col("text"))).alias("line_no", "raw"))
    return df.withColumn("line", strip(F.col("raw"))).withColumn("kind", markdown_kind(F.col("line")))


def _groups(lines: Column) -> Column:
    """Blocks of a section as struct(kind, items, mode), by one fold over its stripped lines.

    A blank line ends a paragraph but not a list; text right after an item goes on with it; an item of the other kind
    begins a new list; table lines stay together while nothing stands between them.
    """
    zero = F.array().cast("array<struct<kind:string,items:array<string>,mode:string>>")

    def step(a: Column, line: Column) -> Column:
        def placed(kind: Column) -> Column:
            last = F.element_at(a, -1)
            n = F.size(a)
            any_yet = n > 0
            mode = F.when(any_yet, last["mode"]).otherwise("start")
            item = F.when(kind == "ordered", F.regexp_extract(line, r"(?s)\A[0-9]+[.)]\s+(.*)\z", 1)).when(kind == "unordered", F.regexp_extract(line, r"(?s)\A.\s+(.*)\z", 1)).otherwise(line)
            in_list = any_yet & last["kind"].isin("ordered", "unordered")
            goes_on = in_list & (mode == "item") & (kind == "text")
            joins = (kind.isin("ordered", "unordered") & any_yet & (last["kind"] == kind)) | (kind.isin("text", "table") & any_yet & (last["kind"] == kind) & (mode == kind))
            head = F.slice(a, 1, F.greatest(n - 1, F.lit(0)))
            new_mode = F.when(kind.isin("ordered", "unordered") | goes_on, "item").otherwise(kind)
            old = last["items"]
            extended = F.concat(F.slice(old, 1, F.greatest(F.size(old) - 1, F.lit(0))), F.array(F.concat(F.element_at(old, -1), F.lit(" "), line)))
            items = F.when(kind == "blank", old).when(goes_on, extended).otherwise(F.concat(old, F.array(item)))
            changed = F.concat(head, F.array(F.struct(last["kind"].alias("kind"), items.alias("items"), new_mode.alias("mode"))))
            fresh = F.concat(a, F.array(F.struct(kind.alias("kind"), F.array(item).alias("items"), new_mode.alias("mode"))))
            return F.when((kind == "blank") & ~any_yet, a).when((kind == "blank") | goes_on | joins, changed).otherwise(fresh)

        return let(markdown_kind(line), placed)

    return F.aggregate(lines, zero, step)


def blocks_of(lines: Column) -> Column:
    """Blocks, without ids, of the stripped lines of a section."""

    def block(g: Column) -> Column:
        items = F.transform(g["items"], strip_markdown)
        table = parse_table(g["items"])
        return (
            F.when(g["kind"] == "text", make_block("paragraph", text=strip_markdown(F.array_join(g["items"], " "))))
            .when(g["kind"] == "table", let(table, lambda t: F.when(t.isNotNull(), make_block("table", table=t))))
            .otherwise(make_block("list", ordered=g["kind"] == "ordered", items=items))
        )

    return F.filter(F.transform(_groups(lines), block), lambda b: b.isNotNull() & (F.coalesce(b["text"], F.lit("-")) != ""))


def with_ids(blocks: Column, element_id: Column) -> Column:
    """Blocks numbered within their element."""
    return F.transform(blocks, lambda b, i: b.withField("id", F.concat(element_id, F.lit(".b"), (i + 1).cast("string"))))


@built_once
def _expressions() -> tuple[Column, ...]:
    """The parts of a text at its headings, from text, and sections with their blocks, from heads."""
    flat = F.array_join(F.transform(split_lines(without_picture_text(F.col("text"))), lambda x: strip(x)), "\n")
    parts = F.filter(F.split(flat, rf"(?dm)(?=^#{{1,6}}{_GAP}+\S)", -1), lambda s: s != "")

    def head(s: Column) -> Column:
        level = F.length(F.regexp_extract(s, _HEADING, 1))
        body = F.when(level > 0, F.regexp_replace(s, r"\A[^\n]*\n?", "")).otherwise(s)
        return F.struct(level.alias("level"), F.when(level > 0, strip_markdown(F.regexp_extract(s, _HEADING, 2))).otherwise("").alias("title"), body.alias("body"))

    def push(stack: Column, h: Column) -> Column:
        up = F.filter(stack, lambda x: x["level"] < h["level"])
        return F.when(h["level"] > 0, F.concat(up, F.array(F.struct(h["level"].alias("level"), h["title"].alias("title"))))).otherwise(stack)

    empty = F.array().cast("array<struct<level:int,title:string>>")
    each = F.transform("heads", lambda h, i: F.struct(
        h["level"].alias("level"), h["title"].alias("title"),
        F.transform(F.aggregate(F.slice(F.col("heads"), 1, i + 1), empty, push), lambda x: x["title"]).alias("path"),
        blocks_of(F.split(h["body"], "\n", -1)).alias("blocks"),
    ))
    return F.transform(parts, head), F.filter(each, lambda s: F.size(s["blocks"]) > 0)


def sections(docs: DataFrame) -> DataFrame:
    """(doc_id, seq, id, type, level, title, path, blocks) of documents (doc_id, text); sections without blocks are left out.

    The path holds the titles of the nearest headings of each smaller level, also of those whose sections are left out.
    Null and empty texts have no sections.
    """
    heads, kept = _expressions()
    df = docs.select("doc_id", heads.alias("heads")).select("doc_id", kept.alias("s"))
    out = df.select("doc_id", F.posexplode("s").alias("seq", "s")).withColumn("seq", F.col("seq") + 1)
    ident = F.concat("doc_id", F.lit(":sec"), F.col("seq").cast("string"))
    return out.select(
        "doc_id", "seq", ident.alias("id"), F.lit("section").alias("type"), F.lit(None).cast("string").alias("number"), "s.level", "s.title", "s.path",
        F.lit(None).cast("struct<number:string,title:string>").alias("chapter"), with_ids(F.col("s.blocks"), ident).alias("blocks"),
    )


def with_sections(df: DataFrame) -> DataFrame:
    """``df`` with ``sections``, those with blocks, in place of its ``heads``: struct(level, title, path, blocks)."""
    return df.withColumn("sections", _expressions()[1]).drop("heads")


def heads() -> Column:
    """The parts of ``text`` at its headings."""
    return _expressions()[0]


def discarded_pictures(docs: DataFrame) -> DataFrame:
    """(doc_id, discarded): how many picture texts were left out."""
    return docs.select("doc_id", F.coalesce(picture_count(F.col("text")), F.lit(0)).alias("discarded"))
