"""Fixture documents through the parsers; expectations follow from the rules."""

import pytest
from pyspark.sql import functions as F

from lexweave.functions import markers, refs, textnorm
from lexweave.operators import chunks, generic, legal, metadata, pipeline, tables


def one(spark, expression, text, kind="string"):
    return spark.createDataFrame([(text,)], f"t {kind}").select(expression(F.col("t")).alias("v")).first().v


@pytest.mark.parametrize(
    ("function", "text", "expected"),
    [
        (textnorm.clean_markdown, "a b  \n**\nx<sup> 8 </sup>\n\n\n\ny\n", "a b\nx8\n\ny"),
        (textnorm.clean_markdown, "", ""),
        (textnorm.clean_markdown, None, None),
        (textnorm.line_whitespace, "a  b\t\r\nc\n", "a\nb\nc"),
        (textnorm.blank_lines, "a\n\n\n\n\nb", "a\n\nb"),
        (textnorm.slugify, " Regulation (EU) 2024/1689 ", "regulation-eu-2024-1689"),
        (textnorm.slugify, "***", "doc"),
        (textnorm.strip_markdown, "shows**E0**and will, cup —**maximum** .", "shows E0 and will, cup — maximum."),
        (textnorm.strip_markdown, None, None),
        (textnorm.clean_line, "  ## **Title** _", "Title"),
        (textnorm.normalize_text, "a - (b) c  d", "a (b) c d"),
        (textnorm.long_date, "3 june 2024", "2024-06-03"),
        (textnorm.long_date, "3 Smarch 2024", None),
        (textnorm.roman_to_int, "xiv", 14),
        (textnorm.roman_to_int, "IIII", 4),
    ],
)
def test_text(spark, function, text, expected):
    assert one(spark, function, text) == expected


def test_extension(spark):
    rows = [("text/html; charset=utf-8", "/x"), ("?", "https://a.b/c/d.HTM"), ("?", "https://a.b/c"), ("application/pdf", "u"), (None, "https://a/b.docx?x=.pdf")]
    df = spark.createDataFrame(rows, "k string, u string").select(textnorm.detect_extension(F.col("k"), F.col("u")).alias("e"))
    assert [r.e for r in df.collect()] == [".html", ".html", ".html", ".pdf", ".docx"]


def test_notes_and_categories(spark):
    assert tuple(one(spark, textnorm.subpoint_note, "systems for X, unless used for Y")) == ("systems for X,", "unless used for Y")
    assert tuple(one(spark, textnorm.subpoint_note, "plain")) == ("plain", None)
    assert tuple(one(spark, textnorm.category_heading, "Biometrics, in so far as allowed:")) == ("Biometrics", "Biometrics, in so far as allowed:")
    assert tuple(one(spark, textnorm.category_heading, "")) == ("", None)


def test_markers(spark):
    m = one(spark, markers.lettered, "intro (a) one (c) skip (b) two: (i) x; (ii) y")
    assert m.intro == "intro " and [(e.label, e.text.strip()) for e in m.entries] == [("a", "one (c) skip"), ("b", "two: (i) x; (ii) y")]
    assert one(spark, markers.lettered, "no list").entries == []
    assert one(spark, markers.paren_numbers, "(1) a (2) b").entries == []


def test_references(spark):
    r = one(spark, refs.references, "Chapter III Section 4, Article 6(1), point (a) and Chapter V")
    assert [(x.type, x.target, x.paragraph, x.point) for x in r] == [("section", "III.4", None, None), ("article", "6", "1", "a"), ("chapter", "V", None, None)]
    assert one(spark, refs.references, "Article 6(1)(c)")[0].subpoint == "c"
    a = one(spark, refs.cited_act, "Directive 2006/42/EC of 17 May 2006 on machinery (OJ L 157, 9.6.2006, p. 24)")
    assert (a.kind, a.identifier, str(a.date), a.short_title, a.oj_reference) == ("directive", "2006/42/EC", "2006-05-17", "machinery", "OJ L 157, 9.6.2006, p. 24")
    assert one(spark, refs.cited_act, "Regulation (EU) 2024/1689") is None


SECTIONS = {
    "F4": "pre\n# A\nt1\n### B\n## C\nt2", "F5": "- a\n\n- b\ncont\n\npara", "F6": "- a\n1. b\n2) c",
    "F7": "|N||N|\n|---|---|---|\n|1|2|3|", "F8": "|**K1**|v1|\n|---|---|\n|**K2**|v2|\n|**K3**|v3|", "F9": "|**A**|**B**|\n|---|---|\n|x|y|", "none": None, "empty": "",
}


def test_sections(spark):
    rows = generic.sections(spark.createDataFrame(list(SECTIONS.items()), "doc_id string, text string")).collect()
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
    assert [(r.id, r.level, r.path) for r in got["F4"]] == [("F4:sec1", 0, []), ("F4:sec2", 1, ["A"]), ("F4:sec3", 2, ["A", "C"])]
    assert [(b.type, b.ordered, b["items"], b.text) for b in got["F5"][0].blocks] == [("list", False, ["a", "b cont"], None), ("paragraph", None, None, "para")]
    assert [(b.ordered, b["items"]) for b in got["F6"][0].blocks] == [(False, ["a"]), (True, ["b", "c"])]
    t = got["F7"][0].blocks[0]
    assert (t.kind, t.columns, [tuple(c) for c in t.rows[0]]) == ("table", ["N", "col2", "N_3"], [("N", "1"), ("col2", "2"), ("N_3", "3")])
    assert [[c.val for c in r] for r in got["F8"][0].blocks[0].rows] == [["K1", "v1"], ["K2", "v2"], ["K3", "v3"]]
    assert [[c.val for c in r] for r in got["F9"][0].blocks[0].rows] == [["A", "x"], ["B", "y"]]
    assert "none" not in got and "empty" not in got


LEGAL = {
    "F10": "Article 1\nT\nIntro text: (a) one; (b) two", "F11": "Article 1\nTitle\nlost 1. First. 2. Second: (a) x; (b) y",
    "F12": "Article 5\nt\n1. h: (a) p; (b) q: (i) r; (ii) s; (c) t", "F13": "Article 3\nD\ndefs: (1) a means x; (2) b means y; (3) c means z",
    "F14": "lost\nCHAPTER I\nGENERAL\nArticle 1\nT1\nb1\nANNEX II\nAT\ntext\nArticle 2\nT2\nb2",
    "F15": "ANNEX I\nT\nIntro (Article 5(1), first subparagraph):\n— one — two", "F18": "Article 9\nEnd\nText. Done at Brussels, 13 June 2024. For the European Parliament The President R. METSOLA",
    "sections": "ANNEX IV\nT\nSection A. First\n1. one\n2. two\nSection B. Second\nnothing", "table": "Article 7\nX\nbody\n|a|b|\n|---|---|\n|1|2|\nmore", "none": None, "empty": "",
    "refs": "Article 1\nT\n1. head: (a) as in Article 3(2): (i) by Article 4; (ii) by Chapter V; (b) none\nANNEX II\nT\n1. see Chapter III Section 4\n2. Directive 2006/42/EC of 17 May 2006 on machinery\n3. Kind: (a) main unless Article 9 applies; (b) more",
}


@pytest.fixture(scope="module")
def parsed(spark):
    return {(r.doc_id, r.seq): r for r in legal.elements(spark.createDataFrame(list(LEGAL.items()), "doc_id string, text string")).collect()}


def test_articles(parsed):
    p = parsed["F10", 1].parsed.paragraphs
    assert p[0].text == "Intro text:" and [(x.label, x.text) for x in p[1].points] == [("a", "one;"), ("b", "two two")]
    p = parsed["F11", 1].parsed.paragraphs
    assert [(x.number, x.intro, x.text) for x in p] == [("1", None, "First."), ("2", "Second:", None)] and "lost" not in str(parsed["F11", 1])
    points = parsed["F12", 1].parsed.paragraphs[0].points
    assert [x.label for x in points] == ["a", "b", "c"] and [(s.label, s.text) for s in points[1].subpoints] == [("i", "r;"), ("ii", "s;")]
    assert parsed["F13", 1].parsed.intro == "defs:" and [i.number for i in parsed["F13", 1].parsed["items"]] == ["1", "2", "3"]
    assert (parsed["F18", 1].parsed.closing.place, parsed["F18", 1].parsed.closing.date) == ("Brussels", "2024-06-13")
    assert [b.type for b in parsed["table", 1].blocks] == ["paragraph", "table"] and parsed["table", 1].blocks[0].text == "body more"
    assert not [k for k in parsed if k[0] in ("none", "empty")]


def test_chapters_and_annexes(parsed):
    assert [(parsed["F14", n].id, parsed["F14", n].chapter and tuple(parsed["F14", n].chapter)) for n in (1, 2, 3)] == [("F14:art1", ("I", "GENERAL")), ("F14:annex2", None), ("F14:art2", ("I", "GENERAL"))]
    assert parsed["F14", 2].parsed.text == "text"
    assert parsed["F15", 1].parsed.intro.startswith("Intro") and [i.text for i in parsed["F15", 1].parsed["items"]] == ["one", "two"]
    assert [(r.type, r.target, r.paragraph, r.subparagraph) for r in parsed["F15", 1].parsed.references] == [("article", "5", "1", "first")]
    assert [(s.label, len(s["items"])) for s in parsed["sections", 1].parsed.sections] == [("A", 2), ("B", 0)]
    assert [i["index"] for i in parsed["sections", 1].parsed.sections[0]["items"]] == [1, 2] and parsed["sections", 1].parsed.references is None


def test_references_and_acts_in_the_tree(parsed):
    refs = lambda x: [(r.type, r.target, r.paragraph) for r in x.references or []]
    p = parsed["refs", 1].parsed.paragraphs[0].points
    assert [refs(x) for x in p] == [[("article", "3", "2"), ("article", "4", None), ("chapter", "V", None)], []] and [refs(s) for s in p[0].subpoints] == [[("article", "4", None)], [("chapter", "V", None)]]
    a, b, c = parsed["refs", 2].parsed["items"]
    assert refs(a) == [("section", "III.4", None)] and a.cited_act is None
    assert (b.cited_act.identifier, str(b.cited_act.date), b.cited_act.short_title) == ("2006/42/EC", "2006-05-17", "machinery") and b.references is None
    assert c.references is None and c.cited_act is None and [refs(s) for s in c.subpoints] == [[("article", "9", None)], []] and c.subpoints[0].note == "unless Article 9 applies;"


def test_packing(spark):
    def block(i, kind, text=None, rows=None):
        return (f"E.b{i}", kind, text, None, None, "table" if rows else None, None, rows)

    df = spark.createDataFrame([("F20", [block(1, "paragraph", "x" * 700), block(2, "paragraph", "y" * 500), block(3, "paragraph", "z")]), ("F21", [block(1, "paragraph", "p"), block(2, "table", None, [[("a", "1")], [("a", "")]]), block(3, "paragraph", "q")]), ("none", [])], f"d string, b array<{tables.BLOCK}>")
    got = {r.d: r.c for r in df.select("d", chunks.packed(F.lit("E"), F.col("b")).alias("c")).collect()}
    assert [(c.chunk_id, c.block_ids) for c in got["F20"]] == [("E#1", ["E.b1", "E.b2"]), ("E#2", ["E.b3"])]
    assert [c.chunk_id for c in got["F21"]] == ["E#1", "E.b2.r1", "E#3"] and got["none"] == []


def test_routing(spark):
    rows = [("generic", None, 5), (None, "Directive", 0), (None, "memo", 3), (None, None, 2)]
    df = spark.createDataFrame(rows, "e string, s string, n int").select(metadata.structure_type(F.col("e"), F.col("s"), F.col("n")).alias("t"))
    assert [r.t for r in df.collect()] == ["generic", "legal", "legal", "generic"]


def test_pipeline_on_odd_rows(spark):
    docs = spark.createDataFrame([("a", "# H\ntext"), ("b", None), ("c", ""), ("d", "  \n"), ("a2", "# H\ntext")], "doc_id string, text string").withColumn("seq", F.lit(9))
    assert {(r.chunk_id, r.text) for r in pipeline.document_chunks(docs).collect()} == {("a:sec1#1", "text"), ("a2:sec1#1", "text")}
    assert pipeline.document_chunks(docs.where("false")).count() == 0


def test_sidecars(spark):
    raw = spark.createDataFrame([("s 1", '{"title": "A b", "extra": "x", "domain": "food"}'), ("s2", "{"), ("s3", '{"doc_id": "own"}')], "stem string, json string")
    got = {r.stem: r for r in metadata.parse_sidecar(raw).collect()}
    assert (got["s 1"].doc_id, got["s 1"].extra) == ("a-b", {"domain": "food"}) and got["s2"].doc_id == "s2" and got["s3"].doc_id == "own"
    assert '"domain":"food"' in metadata.sidecar_json(metadata.parse_sidecar(raw)).where("doc_id = 'a-b'").first().json


ODD = [
    "²Article 3", "éArticle 4", "éArticle 5", "_Article 6", "see article 12a, second subparagraph, point (b) (ii) and Articles 9", "Chapter IV Section 2, Chapter V and chapters X",
    "as in Directive 2001/5/EC of 3 June 2001 on the toys (OJ L 7, p. 9)", "Decision 2010/1/EU of 31 June 2010 on x", "Directive 2001/5/EC con é", "ſection, İ Article 7(2)", "",
]


def test_trees_read_as_columns(spark):
    from lexweave.functions import trees

    df = spark.createDataFrame([(t,) for t in ODD], "t string")
    for t, r, a in df.select("t", refs.references(F.col("t")), refs.cited_act(F.col("t"))).collect():
        assert (trees.references(t) or []) == [x.asDict() for x in r], t
        assert trees.cited_act(t) == (a and a.asDict()), t


@pytest.mark.parametrize(("mark", "field"), [("ANNEX IV", "items"), ("Article 4", "paragraphs")])
def test_elements_are_parsed_once(spark, mark, field):
    """A filter that an explode brings in must not cut up or parse the documents once more."""
    docs = spark.createDataFrame([("d", f"{mark}\nT\n1. Part 5: see Article 9(2)\n2. b")], "doc_id string, text string")
    df = legal.elements(docs).select("id", F.explode(f"parsed.{field}").alias("i"))
    assert [r.i.number for r in df.collect()] == ["1", "2"]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert not [x for x in plan.split("\n") if x.lstrip(" :+-").startswith("Filter") and "lambda" in x]
