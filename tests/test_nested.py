"""Nested records against a plain walk over the same records."""

import json

from pyspark.sql import functions as F

from lexweave.operators import nested
from lexweave.operators.current import current_rows, current_structure

SUB = "array<struct<label:string,text:string,note:string>>"
SCHEMA = (
    "doc_id string, volume int, revision int, elements array<struct<id:string,type:string,number:string,title:string,intro:string,text:string,"
    f"paragraphs:array<struct<index:int,number:string,intro:string,text:string,points:array<struct<label:string,text:string,subpoints:{SUB}>>>>,"
    f"items:array<struct<index:int,number:string,label:string,category:string,intro:string,text:string,subpoints:{SUB}>>,"
    "blocks:array<struct<id:string,type:string,text:string,ordered:boolean,items:array<string>,rows:array<map<string,string>>>>>>, loaded_at timestamp, parent_id string"
)


def element(**k):
    return {"id": None, "type": None, "number": None, "title": None, "intro": None, "text": None, "paragraphs": None, "items": None, "blocks": None} | k


def walk(value, role, parent):
    letter, _, below = nested.ROLES[role]
    for i, node in enumerate(value or [], 1):
        if node is not None:
            me = f"{parent}/{letter}{i}"
            yield parent, me
            for r in below:
                yield from walk(node.get(nested.ROLES[r][1]), r, me)


RECORDS = [
    ("a", 1, 1, [element(type="article", paragraphs=[None, {"index": 1, "number": "1", "intro": None, "text": "t", "points": [{"label": "a", "text": "x", "subpoints": [{"label": "i", "text": "y", "note": None}, None]}]}]), None, element(blocks=[{"id": "b", "type": "table", "text": None, "ordered": None, "items": None, "rows": [{"k": "v"}, {}]}])]),
    ("b", 1, 1, []), ("c", 1, 1, None), ("d", 2, 1, [element(items=[{"index": 1, "number": "1", "label": None, "category": None, "intro": None, "text": None, "subpoints": [{"label": "a", "text": None, "note": "n"}]}])]),
]


def typed(spark, rows):
    return spark.createDataFrame([(*r, None, "own") for r in rows], SCHEMA)


def test_typed_nodes_match_a_walk(spark):
    want = {link for d, v, _, es in RECORDS for link in walk(es, "element", f"{d}|{v}")}
    got = [tuple(r) for r in nested.typed_nodes(typed(spark, RECORDS), wide=False).collect()]
    assert set(got) == want and len(got) == len(want)


def test_variants_agree_between_both_automata(spark):
    raw = spark.createDataFrame([(d, v, json.dumps({"elements": es})) for d, v, _, es in RECORDS], "doc_id string, volume int, body string")
    cols = ["parent_id", "child_id", "role", "place", "variant", "label", "text", "note"]
    a = {tuple(r) for r in nested.typed_nodes(typed(spark, RECORDS)).select(*cols).collect()}
    b = {tuple(r) for r in nested.raw_nodes(raw).select(*cols).collect()}
    assert a == b and {x[4] for x in a} >= {"article", "deep", "nested", "table", "noted"}


def test_raw_shapes(spark):
    bodies = {
        "lone": {"elements": {"paragraphs": {"text": "t", "points": {"label": "a", "text": "x"}}}},
        "keyed": {"elements": [{"paragraphs": [{"points": {"b": {"text": "x", "subpoints": {"ii": "bare", "i": "text"}}, "a": "bare"}}]}]},
        "string": {"elements": json.dumps([{"blocks": json.dumps([{"rows": [{"a": 1}]}])}]), "more": 1},
        "numbers": {"elements": [3, None, "x", {"paragraphs": 5, "items": "no json"}]},
    }
    rows = [(k, 1, json.dumps(v)) for k, v in bodies.items()] + [("bad", 1, "{"), ("null", 1, None), ("empty", 1, ""), ("nan", 1, '{"elements": [NaN]}'), ("list", 1, "[1]"), ("lone", 1, json.dumps(bodies["lone"]))]
    raw = spark.createDataFrame(rows, "doc_id string, volume int, body string")
    got = {}
    for r in nested.links(typed(spark, []), raw).collect():
        got.setdefault(r.child_id.split("|")[0], []).append(r.child_id.partition("|1")[2])
    assert sorted(got["lone"]) == ["/e1", "/e1/p1", "/e1/p1/q1"]
    assert sorted(got["keyed"]) == ["/e1", "/e1/p1", "/e1/p1/q1", "/e1/p1/q1/s1", "/e1/p1/q1/s2", "/e1/p1/q2"]
    assert sorted(got["string"]) == ["/e1", "/e1/b1", "/e1/b1/r1"]
    assert sorted(got["numbers"]) == ["/e1", "/e3", "/e4"] and len(got) == 4


def test_tables_and_empty_input(spark):
    nodes = nested.nodes(typed(spark, RECORDS), spark.createDataFrame([], "doc_id string, volume int, body string"))
    assert {t: nested.flat_table(nodes, t).count() for t in nested.TABLES} == {"elements": 3, "paragraphs": 1, "points": 1, "subpoints": 2, "items": 1, "blocks": 1, "rows": 2}
    assert nested.variant_tables(nodes)["block_table"].count() == 1
    assert nested.nodes(typed(spark, []), spark.createDataFrame([], "doc_id string, volume int, body string")).count() == 0


def test_current_records(spark, tmp_path):
    rows = [("a", 1, 1, []), ("a", 1, 3, [element(type="annex")]), ("a", 1, 2, []), ("a", 2, None, []), (None, 1, 1, [])]
    df = typed(spark, rows)
    df.unionByName(df).write.parquet(str(tmp_path / "t"))
    for source in (df, spark.read.parquet(str(tmp_path / "t"))):
        got = sorted((str(r.doc_id), r.volume, r.revision) for r in current_structure(source).collect())
        assert got == [("None", 1, 1), ("a", 1, 3), ("a", 2, None)]


def test_current_rows_move_no_payload(spark, tmp_path):
    rows = [(n // 3, n, f"payload {n}") for n in range(90)] + [(None, 1, "null"), (None, 2, "key"), (7, None, "least")]
    for part in range(3):
        spark.createDataFrame(rows[part::3], "k int, o int, payload string").write.mode("append").parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = current_rows(df, ["k"], ["o"])
    want = {k: max(x for x in rows if x[0] == k and x[1] is not None) for k in {r[0] for r in rows}}
    assert sorted(tuple(r) for r in out.collect() if r.k is not None) == sorted(v for k, v in want.items() if k is not None)
    assert [r.payload for r in out.where("k is null").collect()] == ["key"] and out.count() == 31
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    by_text = current_rows(df.select("payload"), [F.substring("payload", 1, 3)], [])
    assert sorted(r.payload[:3] for r in by_text.collect()) == ["key", "lea", "nul", "pay"]
    assert current_rows(df.where("k > 1000"), ["k"], ["o"]).count() == 0


def test_the_body_delivered_last_counts(spark):
    bodies = [(n, "r", 1, json.dumps({"elements": [{"type": "article", "title": t}] * k}), at) for n, t, k, at in ((1, "late", 1, "2024-02-01"), (2, "early", 2, "2024-01-01"), (3, "tie", 1, "2023-01-01"), (4, "last", 1, "2024-02-01"))]
    raw = spark.createDataFrame(bodies, "raw_id bigint, doc_id string, volume int, body string, received_at string")
    got = {r.child_id: r.title for r in nested.nodes(typed(spark, RECORDS).where("false"), raw).collect()}
    assert got == {"r|1/e1": "last", "r|1/e2": "early"}


def test_links_are_read_from_the_subtype_tables(spark, monkeypatch):
    bodies = [(f"raw-{d}", v, json.dumps({"elements": es})) for d, v, _, es in RECORDS]
    both = typed(spark, RECORDS), spark.createDataFrame(bodies, "doc_id string, volume int, body string")
    want = {link for d, v, _, es in RECORDS for x in ("", "raw-") for link in walk(es, "element", f"{x}{d}|{v}")}
    assert sorted(tuple(r) for r in nested.links(*both).collect()) == sorted(want)
    tables = {name: t.collect() for name, t in nested.subtypes(nested.nodes(*both)).items()}
    assert {name: len(t) for name, t in tables.items() if t} == {"element_article": 2, "element_itemised": 2, "element_blocked": 2, "paragraph_deep": 2, "point_nested": 2, "subpoint_plain": 2, "subpoint_noted": 2, "item_nested": 2, "block_table": 2, "row_cells": 4}
    monkeypatch.delitem(nested.TABLES, "rows")  # nodes that no table takes have no link
    assert {tuple(r) for r in nested.links(*both).collect()} == {w for w in want if "/r" not in w[1]}


FULL = (
    "doc_id string, volume int, elements array<struct<id:string,type:string,number:string,level:int,title:string,path:array<string>,chapter:struct<number:string,title:string>,"
    f"intro:string,text:string,paragraphs:array<struct<index:int,number:string,intro:string,text:string,points:array<struct<label:string,text:string,subpoints:{SUB}>>>>,"
    "items:array<struct<index:int,number:string,label:string,category:string,intro:string,text:string,"
    f"subpoints:{SUB},cited_act:struct<kind:string,identifier:string,date:string,short_title:string,oj_reference:string>>>,"
    "blocks:array<struct<id:string,type:string,text:string,ordered:boolean,items:array<string>,kind:string,columns:array<string>,rows:array<map<string,string>>>>>>"
)
ACT = {"kind": "directive", "identifier": "2006/42/EC", "date": None, "short_title": "machinery", "oj_reference": "OJ L 157"}
TREE = [
    {"id": "s", "type": "section", "number": "1", "level": 0, "title": "T", "path": ["A", None, "B"], "chapter": None, "intro": "i", "text": "x", "blocks": [
        {"id": "b1", "type": "list", "text": None, "ordered": False, "items": ["one", None, "two"], "kind": None, "columns": None}, None,
        {"id": "b2", "type": "table", "text": None, "ordered": None, "items": None, "kind": "table", "columns": ["k", "l"], "rows": [{"k": "v"}, {}]}]},
    None,
    {"id": "a", "type": "article", "number": None, "level": 2, "title": None, "path": [], "chapter": {"number": "II", "title": None}, "intro": None, "text": None,
     "paragraphs": [{"index": 7, "number": "1", "intro": "i", "text": "t", "points": [{"label": "a", "text": "x", "subpoints": [{"label": "i", "text": "y", "note": "n"}]}]}],
     "items": [{"index": 3, "number": "3", "label": "l", "category": "c", "intro": "i", "text": "t", "cited_act": ACT, "subpoints": [{"label": "a", "text": None, "note": None}]}]},
]


def trees(value, role):
    """The non-null nodes of a nested array by place, null and empty arrays alike, each with all its fields."""
    out = {}
    for i, node in enumerate(value or [], 1):
        if node is not None:
            kids = {nested.ROLES[r][1]: trees(node.get(nested.ROLES[r][1]), r) for r in nested.ROLES[role][2]}
            out[i] = {"cells": node} if role == "row" else {c: node.get(c) for c in nested.FIELDS[role]} | kids
    return out


def rebuilt(all_nodes):
    """The nested records, made from the flat tables only."""
    below = {}
    for name, (role, cols) in nested.TABLES.items():
        for r in nested.flat_table(all_nodes, name).collect():
            d = r.asDict(recursive=True)
            assert not d.get("misfits")
            below.setdefault((d["parent_id"], role), {})[d["place"]] = d["child_id"], {c: d[c] for c in cols if c != "misfits"}

    def made(parent, role):
        return {place: own | {nested.ROLES[r][1]: made(me, r) for r in nested.ROLES[role][2]} for place, (me, own) in below.get((parent, role), {}).items()}

    return {r: made(r, "element") for r in {p for p, role in below if role == "element"}}


def test_records_are_rebuilt_from_the_tables(spark):
    current = spark.createDataFrame([("t", 1, TREE)], FULL)
    raw = spark.createDataFrame([("r", 1, json.dumps({"elements": TREE}))], "doc_id string, volume int, body string")
    assert rebuilt(nested.nodes(current, raw)) == {"t|1": trees(TREE, "element"), "r|1": trees(TREE, "element")}


def test_raw_fields_take_their_declared_types(spark):
    odd = {
        "number": 4, "level": "2", "path": '["A", "B"]', "chapter": json.dumps({"number": 2, "title": "T"}),
        "items": [{"index": "3", "cited_act": [ACT]}, {"index": "3a", "cited_act": "Directive"}],
        "blocks": [{"items": "alone", "ordered": "true", "columns": [1, None]}, {"ordered": "perhaps", "x_more": 1}],
    }
    raw = spark.createDataFrame([("r", 1, json.dumps({"elements": odd}))], "doc_id string, volume int, body string")
    n = {r.child_id: r.asDict(recursive=True) for r in nested.raw_nodes(raw).collect()}
    e, i1, i2, b1, b2 = (n[f"r|1/e1{x}"] for x in ("", "/i1", "/i2", "/b1", "/b2"))
    assert (e["number"], e["level"], e["path"], e["chapter"]) == ("4", 2, ["A", "B"], {"number": "2", "title": "T"})
    assert (i1["index"], i1["cited_act"], i1["misfits"]) == (3, ACT, None)
    assert (i2["index"], i2["cited_act"], i2["misfits"]) == (None, None, {"index": '"3a"', "cited_act": '"Directive"'})
    assert (b1["items"], b1["ordered"], b1["columns"]) == (["alone"], True, ["1", None])
    assert (b2["ordered"], b2["misfits"]) == (None, {"ordered": '"perhaps"'})


def test_variant_tables_are_typed_and_registered(spark):
    from lexweave.plans.nested_queries import QUERIES

    raw = spark.createDataFrame([("r", 1, json.dumps({"elements": TREE + [{"blocks": [{"id": "t", "text": "x", "rows": [{"key": "a", "value": "b", "c": "d"}]}]}]}))], "doc_id string, volume int, body string")
    tables = nested.variant_tables(nested.nodes(spark.createDataFrame([], FULL), raw))
    assert {f"p1_{name}" for name in tables} <= set(QUERIES) and tables["block_list"].columns[4:] != tables["block_table"].columns[4:]
    got = {name: [r.asDict(recursive=True) for r in t.orderBy("child_id").collect()] for name, t in tables.items()}
    assert [(r["ordered"], r["items"], r["others"]) for r in got["block_list"]] == [(False, ["one", None, "two"], {"type": "list"})]
    assert [(r["columns"], r["others"]) for r in got["block_table"]] == [(["k", "l"], {"type": "table"}), (None, {"text": "x"})]
    assert [(r["key"], r["value"], r["others"]) for r in got["row_key_value"]] == [("a", "b", {"c": "d"})]
    assert got["element_section"][0]["others"] == {"type": "section", "number": "1", "intro": "i"} and got["element_article"][0]["chapter"] == {"number": "II", "title": None}
