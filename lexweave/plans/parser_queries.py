"""Queries over parsed documents.

Parsers of marked text are checked against truth: texts are made from columns of the order tables, the parser reads them,
and the SQL gives the expected rows from the same columns without parsing anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import markers as K
from ..functions import refs, textnorm
from ..operators import chunks as C
from ..operators import generic, legal, pipeline, tables
from ..operators.current import current_metadata
from ..operators.partitioning import spread

QUERIES = {}
ORACLES = {}


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spread(spark.read.parquet(f"{d}/documents.parquet").select(F.col("doc_id").cast("string").alias("doc_id"), "text"))


# ------------------------------------------------------------------------------------------------ truth from columns

_LINES = """WITH l AS (SELECT l_orderkey, l_partkey, CAST(l_quantity AS BIGINT) AS q,
row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS n FROM lineitem)"""


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """(l_orderkey, ls): the lines of every order, numbered, as an array of struct(n, q, p)."""
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    s = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.col("l_quantity").cast("bigint").alias("q"))
    grouped = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(s)).alias("s"))
    return grouped.select("l_orderkey", F.transform("s", lambda x, i: F.struct((i + 1).cast("bigint").alias("n"), x["q"].alias("q"), x["l_partkey"].alias("p"))).alias("ls"))


def _letter(n: Column) -> Column:
    return F.substr(F.lit("abcdefghijklmnopqrstuvwxyz"), n.cast("int"), F.lit(1))


def points_split(spark: SparkSession, d: str) -> DataFrame:
    """Points of ``(a) ...; (b) ...`` in texts made from orders, with a marker out of sequence in each."""
    body = F.array_join(F.transform("ls", lambda x: F.concat(F.lit("("), _letter(x["n"]), F.lit(") lot (z) of "), x["q"].cast("string"), F.lit(";"))), " ")
    df = _lines(spark, d).select("l_orderkey", F.concat(F.lit("Goods (q) are: "), body).alias("t"))
    m = df.select("l_orderkey", K.lettered(F.col("t")).alias("m")).select("l_orderkey", F.col("m.intro").alias("intro"), F.explode("m.entries").alias("e"))
    return m.select("l_orderkey", textnorm.strip(F.col("intro")).alias("intro"), "e.label", textnorm.strip(F.col("e.text")).alias("text"))


QUERIES["points_split"] = points_split
ORACLES["points_split"] = f"{_LINES} SELECT l_orderkey, 'Goods (q) are:' AS intro, chr(CAST(96 + n AS INTEGER)) AS label, 'lot (z) of ' || q || ';' AS text FROM l"


def roman_subpoints(spark: SparkSession, d: str) -> DataFrame:
    """Roman subpoints nested in a lettered point."""
    roman = F.array(*map(F.lit, K.ROMANS))
    body = F.array_join(F.transform("ls", lambda x: F.concat(F.lit("("), F.get(roman, (x["n"] - 1).cast("int")), F.lit(") box "), x["q"].cast("string"))), "; ")
    df = _lines(spark, d).where(F.size("ls") >= 2).select("l_orderkey", F.concat(F.lit("one: (a) first: "), body, F.lit("; (b) last")).alias("t"))
    p = df.select("l_orderkey", F.explode(K.points(F.col("t"))["points"]).alias("p")).select("l_orderkey", "p.label", F.col("p.text").alias("head"), F.explode("p.subpoints").alias("s"))
    return p.select("l_orderkey", "label", "head", F.col("s.label").alias("sublabel"), F.regexp_extract("s.text", r"\Abox ([0-9]+)", 1).alias("q"))


QUERIES["roman_subpoints"] = roman_subpoints
ORACLES["roman_subpoints"] = f"""{_LINES}, s AS (SELECT l_orderkey, max(n) AS most FROM l GROUP BY 1)
SELECT l_orderkey, 'a' AS label, 'first:' AS head, (['i', 'ii', 'iii', 'iv', 'v', 'vi', 'vii', 'viii', 'ix', 'x', 'xi', 'xii'])[n] AS sublabel, CAST(q AS VARCHAR) AS q
FROM l JOIN s USING (l_orderkey) WHERE most >= 2 AND n <= 12"""


def paren_items(spark: SparkSession, d: str) -> DataFrame:
    """Definitions ``(1) ... (2) ... (3) ...``; fewer than three are no list."""
    body = F.array_join(F.transform("ls", lambda x: F.concat(F.lit("("), x["n"].cast("string"), F.lit(") part "), x["p"].cast("string"), F.lit(" means "), x["q"].cast("string"))), "; ")
    df = _lines(spark, d).select("l_orderkey", F.concat(F.lit("terms: "), body).alias("t"))
    return df.select("l_orderkey", F.explode(K.paren_items(F.col("t"))["items"]).alias("i")).select("l_orderkey", "i.number", F.regexp_replace("i.text", r";\z", "").alias("text"))


QUERIES["paren_items"] = paren_items
ORACLES["paren_items"] = f"""{_LINES}, s AS (SELECT l_orderkey, max(n) AS most FROM l GROUP BY 1)
SELECT l_orderkey, CAST(n AS VARCHAR) AS number, 'part ' || l_partkey || ' means ' || q AS text FROM l JOIN s USING (l_orderkey) WHERE most >= 3"""


def numbered_items(spark: SparkSession, d: str) -> DataFrame:
    """Items ``1. Category: text`` in whatever order, with their categories."""
    body = F.array_join(F.transform("ls", lambda x: F.concat(x["n"].cast("string"), F.lit(". Part "), x["p"].cast("string"), F.lit(": weight "), x["q"].cast("string"))), " ")
    df = _lines(spark, d).select("l_orderkey", body.alias("t"))
    return df.select("l_orderkey", F.explode(K.numbered_items(F.col("t"))).alias("i")).select("l_orderkey", "i.number", "i.category", "i.text")


QUERIES["numbered_items"] = numbered_items
ORACLES["numbered_items"] = f"{_LINES} SELECT l_orderkey, CAST(n AS VARCHAR) AS number, 'Part ' || l_partkey AS category, 'Part ' || l_partkey || ': weight ' || q AS text FROM l"


def dash_items(spark: SparkSession, d: str) -> DataFrame:
    """Entries of a dash list."""
    body = F.array_join(F.transform("ls", lambda x: F.concat(F.lit("— crate "), x["p"].cast("string"), F.lit(" of "), x["q"].cast("string"))), " ")
    df = _lines(spark, d).select("l_orderkey", F.posexplode(K.dashes(body)).alias("n", "text"))
    return df.select("l_orderkey", (F.col("n") + 1).cast("bigint").alias("n"), "text")


QUERIES["dash_items"] = dash_items
ORACLES["dash_items"] = f"{_LINES} SELECT l_orderkey, n, 'crate ' || l_partkey || ' of ' || q AS text FROM l"


def article_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Numbered paragraphs of articles made from orders; text before the first number is lost."""
    body = F.array_join(F.transform("ls", lambda x: F.concat(x["n"].cast("string"), F.lit(". Deliver "), x["q"].cast("string"), F.lit(" of part "), x["p"].cast("string"), F.lit(":\n(a) whole; (b) sound"))), "\n")
    text = F.concat(F.lit("preamble\nArticle "), F.col("l_orderkey").cast("string"), F.lit("\n**Duties**\nlost\n"), body)
    docs = _lines(spark, d).select(F.col("l_orderkey").cast("string").alias("doc_id"), text.alias("text"))
    p = legal.elements(docs).select("doc_id", "id", "title", F.explode("parsed.paragraphs").alias("p"))
    labels = F.array_join(F.transform("p.points", lambda x: F.concat_ws("=", x["label"], x["text"])), "|")
    return p.select("doc_id", "id", "title", F.col("p.index").cast("bigint").alias("index"), F.col("p.number").alias("number"), F.col("p.intro").alias("intro"), labels.alias("points"))


QUERIES["article_paragraphs"] = article_paragraphs
ORACLES["article_paragraphs"] = f"""{_LINES} SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, l_orderkey || ':art' || l_orderkey AS id, 'Duties' AS title, n AS index, CAST(n AS VARCHAR) AS number,
'Deliver ' || q || ' of part ' || l_partkey || ':' AS intro, 'a=whole;|b=sound' AS points FROM l"""


def legal_references(spark: SparkSession, d: str) -> DataFrame:
    """References in texts made from order lines, in the order in which they are given."""
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    n, q = F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("bigint").cast("string")
    text = F.concat(F.lit("see Article "), q, F.lit("("), n, F.lit("), second subparagraph, point (b), Chapter IV Section "), n, F.lit(" and Chapter X, or Article "), q, F.lit("a"))
    r = li.select("l_orderkey", "l_linenumber", "l_partkey", F.posexplode(refs.references(text)).alias("place", "r"))
    return r.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", F.col("place").cast("bigint").alias("place"), "r.*")


QUERIES["legal_references"] = legal_references
ORACLES["legal_references"] = """WITH l AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, CAST(l_linenumber AS VARCHAR) AS n, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS q FROM lineitem),
none AS (SELECT CAST(NULL AS VARCHAR) AS x)
SELECT l_orderkey, l_linenumber, l_partkey, 0::BIGINT AS place, 'section' AS type, 'IV.' || n AS target, x AS paragraph, x AS subparagraph, x AS point, x AS subpoint FROM l, none
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 1, 'article', q, n, 'second', 'b', x FROM l, none
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 2, 'article', q || 'a', x, x, x, x FROM l, none
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 3, 'chapter', 'X', x, x, x, x FROM l, none"""


def cited_acts(spark: SparkSession, d: str) -> DataFrame:
    """Acts cited at the end of texts made from orders; a text that goes on after the act cites none."""
    o = spark.read.parquet(f"{d}/orders.parquet")
    text = F.concat(
        F.lit("as in "), F.element_at(F.array(*map(F.lit, ["Directive", "Regulation", "DECISION"])), (F.pmod("o_custkey", F.lit(3)) + 1).cast("int")), F.lit(" "), F.date_format("o_orderdate", "yyyy"), F.lit("/"), F.col("o_orderkey").cast("string"), F.when(F.col("o_custkey") % 2 == 0, F.lit("/EC of ")).otherwise(F.lit("/EEC of ")), F.date_format("o_orderdate", "d MMMM yyyy"),
        F.lit(" on "), F.regexp_replace(F.lower("o_orderpriority"), r"\A[0-9]-", ""), F.when(F.col("o_orderkey") % 3 == 0, F.lit(" (OJ L 7, p. 9)")).when(F.col("o_orderkey") % 3 == 1, F.lit("")).otherwise(F.lit("; and more")),
    )
    a = o.select("o_orderkey", refs.cited_act(text).alias("a")).where("a is not null")
    return a.select("o_orderkey", "a.kind", "a.identifier", F.col("a.date").cast("string").alias("date"), "a.short_title", "a.oj_reference")


QUERIES["cited_acts"] = cited_acts
ORACLES["cited_acts"] = """SELECT o_orderkey, (['directive', 'regulation', 'decision'])[CAST(o_custkey % 3 + 1 AS INTEGER)] AS kind, year(o_orderdate) || '/' || o_orderkey || CASE WHEN o_custkey % 2 = 0 THEN '/EC' ELSE '/EEC' END AS identifier, strftime(o_orderdate, '%Y-%m-%d') AS date,
regexp_replace(lower(o_orderpriority), '^[0-9]-', '') AS short_title, CASE WHEN o_orderkey % 3 = 0 THEN 'OJ L 7, p. 9' END AS oj_reference FROM orders WHERE o_orderkey % 3 <> 2"""


def closing_block(spark: SparkSession, d: str) -> DataFrame:
    """Closing formulas of texts made from orders, a tenth of them with a month that does not exist."""
    o = spark.read.parquet(f"{d}/orders.parquet")
    day = F.when(F.col("o_orderkey") % 10 == 0, F.lit("7 Smarch 1999")).otherwise(F.date_format("o_orderdate", "d MMMM yyyy"))
    text = F.concat(F.lit("Text "), F.col("o_orderkey").cast("string"), F.lit(". Done at Town"), F.col("o_custkey").cast("string"), F.lit(", "), day, F.lit(". For the European Parliament The President A. BEE For the Council The President C. DEE"))
    c = o.select("o_orderkey", legal.parse_closing(text).alias("c"))
    names = F.array_join(F.transform("c.closing.signatories", lambda s: F.concat_ws("/", s["body"], s["role"], s["name"])), "|")
    return c.select("o_orderkey", "c.remaining", "c.closing.place", "c.closing.date", names.alias("signatories"), legal.closing_text(F.col("c.closing")).alias("shown"))


QUERIES["closing_block"] = closing_block
ORACLES["closing_block"] = """WITH o AS (SELECT *, CASE WHEN o_orderkey % 10 = 0 THEN '7 Smarch 1999' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders)
SELECT o_orderkey, 'Text ' || o_orderkey || '.' AS remaining, 'Town' || o_custkey AS place, day AS date, 'European Parliament/President/A. BEE|Council/President/C. DEE' AS signatories,
'Done at Town' || o_custkey || ', ' || day || ' European Parliament, President, A. BEE Council, President, C. DEE' AS shown FROM o"""


def subpoint_notes(spark: SparkSession, d: str) -> DataFrame:
    """Notes split from texts made from orders."""
    o = spark.read.parquet(f"{d}/orders.parquet")
    openers = F.array(*map(F.lit, ["unless stated", "This shall not apply here", "except that x", "provided that y", "without note"]))
    text = F.concat(F.lit("main "), F.col("o_orderkey").cast("string"), F.lit(" "), F.get(openers, F.pmod("o_orderkey", F.lit(5)).cast("int")))
    n = o.select("o_orderkey", textnorm.subpoint_note(text).alias("n"))
    return n.select("o_orderkey", "n.main", "n.note")


QUERIES["subpoint_notes"] = subpoint_notes
ORACLES["subpoint_notes"] = """WITH o AS (SELECT o_orderkey, (['unless stated', 'This shall not apply here', 'except that x', 'provided that y', 'without note'])[CAST(o_orderkey % 5 + 1 AS INTEGER)] AS v FROM orders)
SELECT o_orderkey, 'main ' || o_orderkey || CASE WHEN o_orderkey % 5 = 4 THEN ' without note' ELSE '' END AS main, CASE WHEN o_orderkey % 5 <> 4 THEN v END AS note FROM o"""


def category_heading(spark: SparkSession, d: str) -> DataFrame:
    """Categories of headings made from part names."""
    p = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", "p_name")
    text = F.when(F.col("p_partkey") % 3 == 0, F.concat("p_name", F.lit(":"))).when(F.col("p_partkey") % 3 == 1, F.concat("p_name", F.lit(", in so far as allowed:"))).otherwise(F.col("p_name"))
    return p.select("p_partkey", textnorm.category_heading(text).alias("c")).select("p_partkey", "c.category", "c.intro")


QUERIES["category_heading"] = category_heading
ORACLES["category_heading"] = """SELECT p_partkey, p_name AS category, CASE WHEN p_partkey % 3 = 0 THEN p_name || ':' WHEN p_partkey % 3 = 1 THEN p_name || ', in so far as allowed:' END AS intro FROM part"""


def roman_to_int(spark: SparkSession, d: str) -> DataFrame:
    """Values of the Roman numerals of all order line numbers and quantities up to 89."""
    li = spark.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_quantity").cast("int").alias("n")).distinct().where("n between 1 and 89")
    tens = F.array(*map(F.lit, ["", "X", "XX", "XXX", "XL", "L", "LX", "LXX", "LXXX"]))
    ones = F.array(*map(F.lit, ["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"]))
    numeral = F.concat(F.get(tens, F.floor(F.col("n") / 10).cast("int")), F.get(ones, F.pmod("n", F.lit(10)).cast("int")))
    return li.select(numeral.alias("numeral"), textnorm.roman_to_int(F.lower(numeral)).cast("bigint").alias("value"))


QUERIES["roman_to_int"] = roman_to_int
ORACLES["roman_to_int"] = """WITH v AS (SELECT DISTINCT CAST(l_quantity AS BIGINT) AS n FROM lineitem WHERE l_quantity BETWEEN 1 AND 89)
SELECT (['', 'X', 'XX', 'XXX', 'XL', 'L', 'LX', 'LXX', 'LXXX'])[n // 10 + 1] || (['', 'I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX'])[n % 10 + 1] AS numeral, n AS value FROM v"""


def strip_markdown(spark: SparkSession, d: str) -> DataFrame:
    """Emphasis removed from texts made from part names, with bold text at words, brackets and stops."""
    p = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", F.col("p_brand").alias("b"))
    text = F.concat(F.lit("**start**shows**"), "b", F.lit("**and (**x**)<br/>__y__ cup —**max**. **a****b** end **last**"))
    return p.select("p_partkey", textnorm.strip_markdown(text).alias("text"), textnorm.is_bold(F.concat(F.lit(" **"), "b", F.lit("** "))).alias("bold"))


QUERIES["strip_markdown"] = strip_markdown
ORACLES["strip_markdown"] = "SELECT p_partkey, 'start shows ' || p_brand || ' and (x) y cup — max. a b end last' AS text, true AS bold FROM part"


def picture_text(spark: SparkSession, d: str) -> DataFrame:
    """Texts read from pictures taken out and counted, in texts made from parts."""
    p = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", F.col("p_name").alias("n"), F.pmod("p_partkey", F.lit(4)).cast("int").alias("k"))
    text = F.concat("n", F.repeat(F.lit("<!-- Start of picture text -->a\nb<!--End of picture text -->"), F.col("k")), F.lit("."))
    return p.select("p_partkey", textnorm.without_picture_text(text).alias("text"), textnorm.picture_count(text).cast("bigint").alias("n"))


QUERIES["picture_text"] = picture_text
ORACLES["picture_text"] = "SELECT p_partkey, p_name || '.' AS text, CAST(p_partkey % 4 AS BIGINT) AS n FROM part"


def chapter_asof(spark: SparkSession, d: str) -> DataFrame:
    """The chapter of each article in a document made from each supplier: its nation is the chapter; an annex stands between its two articles."""
    n, s = spark.read.parquet(f"{d}/nation.parquet"), spark.read.parquet(f"{d}/supplier.parquet")
    roman = F.array(*map(F.lit, ["I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X", "XI", "XII", "XIII", "XIV", "XV", "XVI", "XVII", "XVIII", "XIX", "XX", "XXI", "XXII", "XXIII", "XXIV", "XXV"]))
    key = F.col("s_suppkey").cast("string")
    chapter = F.concat(F.lit("CHAPTER "), F.get(roman, F.col("n_nationkey")), F.lit("\n"), "n_name")
    text = F.concat(F.lit("lead\nArticle 0\nTitle\nbody\nCHAPTER L\nFirst\nArticle 1\nTitle\nbody\n"), chapter, F.lit("\nArticle "), key, F.lit("a\nTitle\nbody\nANNEX I\nA\nb\nArticle "), key, F.lit("b\nTitle\nbody"))
    segs = legal.segments(s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(key.alias("doc_id"), text.alias("text"))).where("type = 'article'")
    return segs.select("doc_id", "number", F.col("chapter.number").alias("chapter_number"), F.col("chapter.title").alias("chapter_title"))


QUERIES["chapter_asof"] = chapter_asof
ORACLES["chapter_asof"] = """WITH s AS (SELECT CAST(s_suppkey AS VARCHAR) AS k, n_nationkey, n_name FROM nation JOIN supplier ON s_nationkey = n_nationkey),
a AS (SELECT k, unnest([{'n': '0', 'own': 0}, {'n': '1', 'own': 1}, {'n': k || 'a', 'own': 2}, {'n': k || 'b', 'own': 2}]) AS r, n_nationkey, n_name FROM s)
SELECT k AS doc_id, r.n AS number, CASE r.own WHEN 1 THEN 'L' WHEN 2 THEN
(['I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX', 'X', 'XI', 'XII', 'XIII', 'XIV', 'XV', 'XVI', 'XVII', 'XVIII', 'XIX', 'XX', 'XXI', 'XXII', 'XXIII', 'XXIV', 'XXV'])[n_nationkey + 1] END AS chapter_number,
CASE r.own WHEN 1 THEN 'First' WHEN 2 THEN n_name END AS chapter_title FROM a"""


def annex_items(spark: SparkSession, d: str) -> DataFrame:
    """Numbered items of annexes made from orders, with the references of each and of the annex's intro."""
    body = F.array_join(F.transform("ls", lambda x: F.concat(x["n"].cast("string"), F.lit(". Part "), x["p"].cast("string"), F.lit(": see Article "), x["q"].cast("string"), F.lit("(2)"))), "\n")
    key = F.col("l_orderkey").cast("string")
    text = F.concat(F.lit("ANNEX IV\nGoods\nUnder Article "), key, F.lit("(1), point (b):\n"), body)
    e = legal.elements(_lines(spark, d).select(key.alias("doc_id"), text.alias("text"))).select("doc_id", "id", "parsed.intro", "parsed.references", F.explode("parsed.items").alias("i"))
    ref = F.get("i.references", F.lit(0))
    return e.select("doc_id", "id", "intro", F.get("references", F.lit(0))["target"].alias("intro_target"), F.get("references", F.lit(0))["point"].alias("intro_point"), F.col("i.index").cast("bigint").alias("index"), "i.number", "i.category", "i.text", ref["target"].alias("target"), ref["paragraph"].alias("paragraph"))


QUERIES["annex_items"] = annex_items
ORACLES["annex_items"] = f"""{_LINES} SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, l_orderkey || ':annex4' AS id, 'Under Article ' || l_orderkey || '(1), point (b):' AS intro, CAST(l_orderkey AS VARCHAR) AS intro_target, 'b' AS intro_point,
n AS index, CAST(n AS VARCHAR) AS number, 'Part ' || l_partkey AS category, 'Part ' || l_partkey || ': see Article ' || q || '(2)' AS text, CAST(q AS VARCHAR) AS target, '2' AS paragraph FROM l"""


def nested_item(spark: SparkSession, d: str) -> DataFrame:
    """Items with lettered subpoints and notes, in texts made from orders."""
    body = F.array_join(F.transform("ls", lambda x: F.concat(x["n"].cast("string"), F.lit(". Kind "), x["p"].cast("string"), F.lit(": (a) box "), x["q"].cast("string"), F.lit(" unless dry; (b) bag"))), " ")
    i = _lines(spark, d).select("l_orderkey", F.explode(K.numbered_items(body)).alias("i")).select("l_orderkey", "i.number", "i.category", "i.intro", F.explode("i.subpoints").alias("s"))
    return i.select("l_orderkey", "number", "category", "intro", F.col("s.label").alias("label"), F.col("s.text").alias("text"), F.col("s.note").alias("note"))


QUERIES["nested_item"] = nested_item
ORACLES["nested_item"] = f"""{_LINES}, i AS (SELECT l_orderkey, CAST(n AS VARCHAR) AS number, 'Kind ' || l_partkey AS category, 'Kind ' || l_partkey || ':' AS intro, q FROM l)
SELECT l_orderkey, number, category, intro, 'a' AS label, 'box ' || q AS text, 'unless dry;' AS note FROM i UNION ALL SELECT l_orderkey, number, category, intro, 'b', 'bag', NULL FROM i"""


def unnumbered_article(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs and points of articles without numbers, made from orders; the last point's text is given twice."""
    body = F.array_join(F.transform("ls", lambda x: F.concat(F.lit("("), _letter(x["n"]), F.lit(") lot "), x["q"].cast("string"), F.lit(";"))), "\n")
    key = F.col("l_orderkey").cast("string")
    docs = _lines(spark, d).select(key.alias("doc_id"), F.concat(F.lit("Article 3\nT\nGoods are:\n"), body).alias("text"))
    p = legal.elements(docs).select("doc_id", F.explode("parsed.paragraphs").alias("p")).select("doc_id", F.col("p.index").cast("bigint").alias("index"), "p.text", F.explode_outer("p.points").alias("x"))
    return p.select("doc_id", "index", "text", F.col("x.label").alias("label"), F.col("x.text").alias("point"))


QUERIES["unnumbered_article"] = unnumbered_article
ORACLES["unnumbered_article"] = f"""{_LINES}, m AS (SELECT l_orderkey, max(n) AS most FROM l GROUP BY 1)
SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, 1::BIGINT AS index, 'Goods are:' AS text, NULL AS label, NULL AS point FROM m
UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 2, NULL, chr(CAST(96 + n AS INTEGER)), CASE WHEN n = most THEN 'lot ' || q || '; lot ' || q || ';' ELSE 'lot ' || q || ';' END FROM l JOIN m USING (l_orderkey)"""


def sidecar_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of a text made for every sidecar, parsed as its declared type says and under its title."""
    meta = current_metadata(spark.read.parquet(f"{d}/metadata.parquet"))
    docs = meta.select("doc_id", F.concat(F.lit("Article 1\nT\nbody of "), "doc_id").alias("text")).where("doc_id is not null")
    c = pipeline.document_chunks(docs, meta)
    return c.select("doc_id", "doc_title", "element_id", "element_type", "chunk_id", "text")


QUERIES["sidecar_chunks"] = sidecar_chunks
ORACLES["sidecar_chunks"] = """WITH m AS (SELECT * FROM metadata WHERE doc_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY revision DESC NULLS LAST, loaded_at DESC NULLS LAST) = 1),
t AS (SELECT *, CASE WHEN extra['structure_type'] IN ('legal', 'generic') THEN extra['structure_type'] = 'legal' ELSE coalesce(lower(source_type) IN ('regulation', 'directive', 'decision', 'legal', 'law', 'act'), false) END AS law FROM m)
SELECT doc_id, title AS doc_title, doc_id || CASE WHEN law THEN ':art1' ELSE ':sec1' END AS element_id, CASE WHEN law THEN 'article' ELSE 'section' END AS element_type,
doc_id || CASE WHEN law THEN ':art1#1' ELSE ':sec1#1' END AS chunk_id, CASE WHEN law THEN 'body of ' || doc_id ELSE 'Article 1 T body of ' || doc_id END AS text FROM t"""


def section_paths(spark: SparkSession, d: str) -> DataFrame:
    """Headings over a section in documents made from regions and nations."""
    n, r = spark.read.parquet(f"{d}/nation.parquet"), spark.read.parquet(f"{d}/region.parquet")
    per = n.groupBy("n_regionkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list("n_name")), lambda x: F.concat(F.lit("### "), x, F.lit("\n- one\n- two\n\n1. three"))), "\n").alias("b"))
    docs = r.join(per, r["r_regionkey"] == per["n_regionkey"]).select(F.col("r_regionkey").cast("string").alias("doc_id"), F.concat(F.lit("lead\n# "), "r_name", F.lit("\n"), "b").alias("text"))
    s = generic.sections(docs)
    return s.select("doc_id", "title", F.col("level").cast("bigint").alias("level"), F.array_join("path", ">").alias("path"), F.size("blocks").cast("bigint").alias("blocks"), F.array_join(F.transform("blocks", lambda b: F.concat_ws(":", b["type"], F.array_join(b["items"], ","))), "|").alias("shape"))


QUERIES["section_paths"] = section_paths
ORACLES["section_paths"] = """SELECT CAST(r_regionkey AS VARCHAR) AS doc_id, '' AS title, 0::BIGINT AS level, '' AS path, 1::BIGINT AS blocks, 'paragraph' AS shape FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation)
UNION ALL SELECT CAST(n_regionkey AS VARCHAR), n_name, 3, r_name || '>' || n_name, 2, 'list:one,two|list:three' FROM nation JOIN region ON r_regionkey = n_regionkey"""


def _table_query(name: str, lines, sql: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        n = spark.read.parquet(f"{d}/nation.parquet")
        t = n.select("n_nationkey", tables.parse_table(lines()).alias("t"))
        rows = t.select("n_nationkey", F.col("t.kind").alias("kind"), F.posexplode("t.rows").alias("row", "r"))
        return rows.select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), "kind", (F.col("row") + 1).cast("bigint").alias("row"), tables.row_text(F.col("r")).alias("text"))

    QUERIES[name], ORACLES[name] = run, sql


_key = lambda: F.col("n_nationkey").cast("string")
_table_query("table_parse_header", lambda: F.array(F.lit("|N||N|"), F.lit("|---|:---:|---|"), F.concat(F.lit("|"), "n_name", F.lit("|"), _key(), F.lit("|")), F.lit("||x|y|")),
             "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, 'table' AS kind, 1::BIGINT AS row, 'N: ' || n_name || '; col2: ' || n_nationkey AS text FROM nation UNION ALL SELECT n_nationkey, 'table', 2, 'N: x; col2: y' FROM nation")
_table_query("table_parse_kv", lambda: F.array(F.concat(F.lit("|**K1**|"), "n_name", F.lit("|")), F.lit("|---|---|"), F.concat(F.lit("|**K2**|"), _key(), F.lit("|")), F.lit("|**K3**||")),
             "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, 'key_value' AS kind, 1::BIGINT AS row, 'K1: ' || n_name AS text FROM nation UNION ALL SELECT n_nationkey, 'key_value', 2, 'K2: ' || n_nationkey FROM nation UNION ALL SELECT n_nationkey, 'key_value', 3, 'K3: ' FROM nation")
_table_query("table_parse_paired", lambda: F.array(F.lit("|**A**|**B**|"), F.lit("|---|---|"), F.concat(F.lit("|"), "n_name", F.lit("|"), _key(), F.lit("|"))),
             "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, 'key_value' AS kind, 1::BIGINT AS row, 'A: ' || n_name AS text FROM nation UNION ALL SELECT n_nationkey, 'key_value', 2, 'B: ' || n_nationkey FROM nation")


def chunks_packed(spark: SparkSession, d: str) -> DataFrame:
    """The lines of documents that are not blank packed as blocks within 1,200 characters."""
    lines = F.filter(F.transform(textnorm.split_lines(F.col("text")), lambda x: textnorm.strip(x)), lambda x: x != "")
    blocks = F.transform(lines, lambda x, i: tables.make_block("paragraph", text=x).withField("id", F.concat(F.col("doc_id"), F.lit(".b"), (i + 1).cast("string"))))
    c = _docs(spark, d).select("doc_id", blocks.alias("blocks")).select("doc_id", F.explode(C.packed(F.col("doc_id"), F.col("blocks"))).alias("c"))
    return c.select("doc_id", "c.chunk_id", F.size("c.block_ids").cast("bigint").alias("blocks"), F.length("c.text").cast("bigint").alias("chars"), F.md5("c.text").alias("digest"))


def _chunk_oracle() -> str:
    from . import sqltext as S

    return f"""
WITH RECURSIVE lf AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, {S.breaks_to_lf("text")} AS t FROM documents WHERE text IS NOT NULL),
parts AS (SELECT doc_id, list_filter(list_transform(string_split(t, chr(10)), lambda v: {S.strip("v")}), lambda v: v <> '') AS p FROM lf),
lines AS (SELECT doc_id, unnest(p) AS line, unnest(range(len(p))) + 1 AS n FROM parts),
walk AS (SELECT doc_id, n, line, 1 AS k, length(line) AS size FROM lines WHERE n = 1
UNION ALL SELECT l.doc_id, l.n, l.line, CASE WHEN w.size + length(l.line) > 1200 THEN w.k + 1 ELSE w.k END, CASE WHEN w.size + length(l.line) > 1200 THEN length(l.line) ELSE w.size + length(l.line) END
FROM walk w JOIN lines l ON l.doc_id = w.doc_id AND l.n = w.n + 1),
c AS (SELECT doc_id, k, count(*) AS blocks, string_agg(line, chr(10) || chr(10) ORDER BY n) AS text FROM walk GROUP BY ALL)
SELECT doc_id, doc_id || '#' || k AS chunk_id, blocks, CAST(length(text) AS BIGINT) AS chars, md5(text) AS digest FROM c"""


QUERIES["chunks_packed"] = chunks_packed
ORACLES["chunks_packed"] = _chunk_oracle()


# --------------------------------------------------------------------------------------- whole documents, rows only


def _elements(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.elements(pipeline.cleaned(_docs(spark, d)), tree=False)


def legal_elements(spark: SparkSession, d: str) -> DataFrame:
    """Articles and annexes of the legal documents."""
    df = pipeline.routed(pipeline.cleaned(_docs(spark, d))).where("structure_type = 'legal'")
    return legal.elements(df).select("doc_id", "seq", "id", "type", "number", "title", F.to_json("chapter").alias("chapter"), F.to_json("parsed").alias("parsed"))


def generic_sections(spark: SparkSession, d: str) -> DataFrame:
    """Sections of all documents, read as Markdown."""
    s = generic.sections(pipeline.cleaned(_docs(spark, d)))
    return s.select("doc_id", "seq", "id", "level", "title", F.array_join("path", " > ").alias("path"), F.size("blocks").alias("blocks"))


def document_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Blocks of all documents, each by the parser that fits it."""
    b = pipeline.blocks(_elements(spark, d))
    return b.select("doc_id", "element_id", "block_no", "id", "type", "text", "ordered", F.to_json("items").alias("items"), "kind", F.to_json("rows").alias("rows"))


def document_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of all documents."""
    c = C.chunks(_elements(spark, d))
    return c.select("doc_id", "element_id", "element_type", "element_number", "element_title", "chunk_id", F.array_join("block_ids", ",").alias("block_ids"), "text")


def chunk_stats(spark: SparkSession, d: str) -> DataFrame:
    """Chunks and characters of every document."""
    return C.chunks(_elements(spark, d)).groupBy("doc_id").agg(F.count("*").alias("chunks"), F.sum(F.length("text")).alias("chars"), F.max(F.length("text")).alias("longest"))


def document_totals(spark: SparkSession, d: str) -> DataFrame:
    """Elements and blocks of articles made from orders: one document an order, an article and a block or more for each line."""
    part = F.array_join(F.transform("ls", lambda x: F.concat(F.lit("Article "), x["n"].cast("string"), F.lit("\nT\n1. Lot "), x["q"].cast("string"), F.lit("\n2. Part "), x["p"].cast("string"))), "\n")
    docs = _lines(spark, d).where(F.size("ls") >= 3).select(F.col("l_orderkey").cast("string").alias("doc_id"), part.alias("text"))
    return pipeline.document_totals(pipeline.elements(docs, tree=False))


QUERIES["document_totals"] = document_totals
ORACLES["document_totals"] = f"{_LINES} SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, count(*) AS elements, 2 * count(*) AS blocks FROM l GROUP BY l_orderkey HAVING count(*) >= 3"


def document_references(spark: SparkSession, d: str) -> DataFrame:
    """References in the blocks of all documents."""
    return legal.element_references(_elements(spark, d))


def reference_counts(spark: SparkSession, d: str) -> DataFrame:
    """How often each target is referred to, by type, in chunk texts; a redelivered chunk counts once."""
    chunks = spark.read.parquet(f"{d}/chunks.parquet").select("chunk_id", "text").where("text is not null").distinct()
    r = chunks.select(F.explode(refs.references(F.col("text"))).alias("r"))
    return r.groupBy("r.type", "r.target", "r.paragraph").agg(F.count("*").alias("n"))


QUERIES |= {
    "legal_elements": legal_elements, "generic_sections": generic_sections, "document_blocks": document_blocks, "document_chunks": document_chunks,
    "chunk_stats": chunk_stats, "document_references": document_references, "reference_counts": reference_counts,
}
ORACLES["reference_counts"] = r"""WITH c AS (SELECT DISTINCT chunk_id, text FROM chunks WHERE text IS NOT NULL),
a AS (SELECT unnest(regexp_extract_all(text, '(?i)\bArticle[\s\x{a0}\x{2002}-\x{200a}\x{202f}\x{3000}]+([0-9]+[A-Za-z]?)(?:\(([0-9]+)\))?', ['target', 'paragraph'])) AS r FROM c),
s AS (SELECT 'article' AS type, r.target AS target, nullif(r.paragraph, '') AS paragraph FROM a)
SELECT type, target, paragraph, count(*) AS n FROM s GROUP BY ALL"""
