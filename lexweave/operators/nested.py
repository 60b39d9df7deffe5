"""Deeply nested records as related flat tables (problem 1).

A record is a tree: elements hold paragraphs, items and blocks; paragraphs hold points; points and items hold subpoints;
table blocks hold rows. The shape of every node is classified by a bottom-up tree automaton: the state of a node follows
from its own fields and from the states of its children (:data:`RULES`). Each state is a structural variant with its own
typed subtype table; all variants share the supertype columns (record, parent_id, child_id, role, place, variant).

The automaton runs twice over the same rules: as Column expressions over records with a declared schema, without leaving
the JVM, and in Arrow-fed Python over raw JSON bodies, whose shapes are only known value by value. Raw shapes are first
reduced to the typed ones (:func:`entries`): a lone object is an array of one, an object keyed by labels is the array of
its values, a string that holds an array is that array.

Defined results: null and empty arrays give no nodes; null entries keep their place but are not nodes; a record without
doc_id or volume is named with an empty part; a body that is null, blank or not valid JSON gives nothing; a text where an
object is usual is a node with only that text; repeated deliveries give each node once. Every declared field is carried in
its declared type (:data:`FIELDS`); a raw value that this type cannot hold is kept as JSON in ``misfits``; keys that no role
declares are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from .partitioning import cut

#: role -> (letter of its node ids, field of the parent that holds it, roles of its children)
ROLES: dict[str, tuple[str, str, tuple[str, ...]]] = {
    "element": ("e", "elements", ("paragraph", "item", "block")),
    "paragraph": ("p", "paragraphs", ("point",)),
    "point": ("q", "points", ("subpoint",)),
    "subpoint": ("s", "subpoints", ()),
    "item": ("i", "items", ("subpoint",)),
    "block": ("b", "blocks", ("row",)),
    "row": ("r", "rows", ()),
}

#: Fields by which an object shows itself to be one node and not a collection of labelled nodes.
OWN_FIELDS = {
    "label", "text", "note", "index", "number", "intro", "title", "type", "id", "points", "subpoints", "items",
    "paragraphs", "blocks", "rows", "category", "cited_act", "kind", "columns", "ordered", "level", "path", "chapter",
}

#: Roles whose array may be replaced by an object keyed by labels.
KEYED = {"point", "subpoint"}

#: Transitions of the automaton, first match first: role -> [(variant, condition)]. A condition is a tuple of tests that
#: must all hold: ("has", field), ("is", field, value), ("child", role) for any child, ("child", role, variant).
RULES: dict[str, list[tuple[str, tuple[tuple[str, ...], ...]]]] = {
    "element": [
        ("article", (("is", "type", "article"),)),
        ("annex", (("is", "type", "annex"),)),
        ("section", (("is", "type", "section"),)),
        ("paragraphed", (("child", "paragraph"),)),
        ("itemised", (("child", "item"),)),
        ("blocked", (("child", "block"),)),
        ("bare", ()),
    ],
    "paragraph": [
        ("deep", (("child", "point", "nested"),)),
        ("listed", (("child", "point"),)),
        ("plain", (("has", "text"),)),
        ("bare", ()),
    ],
    "point": [("nested", (("child", "subpoint"),)), ("plain", (("has", "text"),)), ("bare", ())],
    "subpoint": [("noted", (("has", "note"),)), ("plain", (("has", "text"),)), ("bare", ())],
    "item": [("nested", (("child", "subpoint"),)), ("plain", (("has", "text"),)), ("bare", ())],
    "block": [
        ("table", (("is", "type", "table"),)),
        ("list", (("is", "type", "list"),)),
        ("paragraph", (("is", "type", "paragraph"),)),
        ("table", (("child", "row"),)),
        ("paragraph", (("has", "text"),)),
        ("bare", ()),
    ],
    "row": [("key_value", (("has", "key"), ("has", "value"))), ("cells", ())],
}

CHAPTER = "struct<number:string,title:string>"
ACT = "struct<kind:string,identifier:string,date:string,short_title:string,oj_reference:string>"

#: Every declared field of a role that is not a role itself, with its type.
FIELDS: dict[str, dict[str, str]] = {
    "element": {
        "id": "string", "type": "string", "number": "string", "level": "int", "title": "string", "path": "array<string>", "chapter": CHAPTER,
        "intro": "string", "text": "string",
    },
    "paragraph": {"index": "int", "number": "string", "intro": "string", "text": "string"},
    "point": {"label": "string", "text": "string"},
    "subpoint": {"label": "string", "text": "string", "note": "string"},
    "item": {"index": "int", "number": "string", "label": "string", "category": "string", "intro": "string", "text": "string", "cited_act": ACT},
    "block": {"id": "string", "type": "string", "text": "string", "ordered": "boolean", "items": "array<string>", "kind": "string", "columns": "array<string>"},
    "row": {"cells": "map<string,string>"},
}
#: All fields of the supertype table, and by role the raw values, as JSON, that their declared types cannot hold.
PAYLOAD: dict[str, str] = {c: t for own in FIELDS.values() for c, t in own.items()} | {"misfits": "map<string,string>"}

NODE = "parent_id string, child_id string, record string, role string, place int, variant string"
NODE_WIDE = f"{NODE}, {', '.join(f'`{c}` {t}' for c, t in PAYLOAD.items())}"


# ---------------------------------------------------------------------------------------------------- typed records


def _children(node: Column, role: str) -> Column:
    return node[ROLES[role][1]]


def _variant(node: Column, role: str) -> Column:
    """State of a typed node, from RULES; children's states are asked for only where a rule needs them."""

    def test(t: tuple[str, ...]) -> Column:
        if role == "row":
            return F.map_contains_key(node, t[1])
        if t[0] == "is":
            return node[t[1]].eqNullSafe(t[2])
        if t[0] == "has":
            return node[t[1]].isNotNull()
        below = F.coalesce(_children(node, t[1]), F.array())
        return F.exists(below, lambda c: c.isNotNull() & (F.lit(True) if len(t) == 2 else _variant(c, t[1]) == t[2]))

    out: Column | None = None
    for name, tests in RULES[role]:
        if not tests:
            return F.lit(name) if out is None else out.otherwise(name)
        cond = test(tests[0])
        for t in tests[1:]:
            cond = cond & test(t)
        out = F.when(cond, name) if out is None else out.when(cond, name)
    raise ValueError(f"the rules of {role} have no last one without tests")


def _field(node: Column, role: str, name: str, declared: DataType) -> Column:
    """A field of a typed node in its type of :data:`FIELDS`; structs are taken by name, absent fields are null."""
    ddl = FIELDS[role][name]
    if role == "row":
        return node.cast(ddl)
    if name not in declared.names:
        return F.lit(None).cast(ddl)
    own = declared[name].dataType
    if not isinstance(own, StructType) or own.simpleString() == ddl:
        return node[name].cast(ddl)
    parts = [(node[name][f.name] if f.name in own.names else F.lit(None)).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(f"x {ddl}")["x"].dataType]
    return F.when(node[name].isNotNull(), F.struct(*parts))


def _nodes(array: Column, role: str, parent: Column, record: Column, declared: DataType) -> Column:
    """All nodes of ``array`` and below as one array of structs; null entries keep their place."""
    letter, _, below = ROLES[role]

    def one(pair: Column) -> Column:
        node, place = pair["n"], pair["i"]
        me = F.concat(parent, F.lit(f"/{letter}"), place.cast("string"))
        own = {c: _field(node, role, c, declared) for c in FIELDS[role]}
        cols = [parent.alias("parent_id"), me.alias("child_id"), record.alias("record"), F.lit(role).alias("role")]
        cols += [place.cast("int").alias("place"), _variant(node, role).alias("variant")]
        cols += [own.get(c, F.lit(None).cast(t)).alias(c) for c, t in PAYLOAD.items()]
        arrays = [F.array(F.struct(*cols))] + [_nodes(_children(node, r), r, me, record, declared[ROLES[r][1]].dataType.elementType) for r in below]
        return F.concat(*arrays) if len(arrays) > 1 else arrays[0]

    placed = F.transform(F.coalesce(array, F.array()), lambda n, i: F.struct(n.alias("n"), (i + 1).alias("i")))
    return F.flatten(F.transform(F.filter(placed, lambda p: p["n"].isNotNull()), one))


def typed_nodes(current: DataFrame, wide: bool = True) -> DataFrame:
    """Nodes of records with the declared schema; ``current`` has doc_id, volume and elements. No shuffle, no Python.

    Not ``wide``: only the link columns of the same classified nodes.
    """
    record = F.concat_ws("|", F.coalesce("doc_id", F.lit("")), F.coalesce(F.col("volume").cast("string"), F.lit("")))
    df = current.select(record.alias("record"), F.col("elements"))
    nodes = _nodes(F.col("elements"), "element", F.col("record"), F.col("record"), current.schema["elements"].dataType.elementType)
    return df.select(F.explode(nodes).alias("n")).select(*(["n.*"] if wide else ["n.parent_id", "n.child_id"]))


# -------------------------------------------------------------------------------------------------------- raw bodies


def entries(value: Any, role: str) -> list[Any]:
    """The entries that ``value`` stands for where an array of ``role`` is usual.

    Text is read as JSON and kept only if it holds an array or an object; an object is one entry, unless the role may be
    keyed by labels and the object has keys but none of a node's own fields: then its values are the entries, in written
    order. Anything else stands for no entries.
    """
    while isinstance(value, str):
        try:
            value = _loads(value)
        except ValueError:
            return []
    if isinstance(value, dict):
        return list(value.values()) if role in KEYED and value and not OWN_FIELDS & value.keys() else [value]
    return value if isinstance(value, list) else []


def _reject(name: str) -> None:
    raise ValueError(name)


def _loads(body: str) -> Any:
    try:
        return json.loads(body, parse_constant=_reject)
    except RecursionError as e:
        raise ValueError("nested too deeply") from e


def _text(value: Any) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False)


#: What a raw value gives that its declared type cannot hold.
_MISFIT = object()


def _strings(value: Any) -> Any:
    """A raw value as an array of texts: a string that holds an array is that array, anything else alone is an array of one."""
    if isinstance(value, str):
        try:
            held = _loads(value)
        except ValueError:
            held = None
        value = held if isinstance(held, list) else value
    return [_text(v) for v in (value if isinstance(value, list) else [value])]


def _struct(value: Any, names: tuple[str, ...]) -> Any:
    """A raw value as a struct: an object, alone in an array, or in a string."""
    while isinstance(value, str):
        try:
            value = _loads(value)
        except ValueError:
            return _MISFIT
    if isinstance(value, list) and len(value) == 1:
        value = value[0]
    return {n: _text(value.get(n)) for n in names} if isinstance(value, dict) else _MISFIT


def _int(value: Any) -> Any:
    if isinstance(value, str) and re.fullmatch(r"\s*[+-]?[0-9]{1,10}\s*", value):
        value = int(value)
    if isinstance(value, float) and value.is_integer():
        value = int(value)
    return value if type(value) is int and -(1 << 31) <= value < 1 << 31 else _MISFIT


def _boolean(value: Any) -> Any:
    if isinstance(value, str):
        value = {"true": True, "false": False, "1": 1, "0": 0}.get(value.strip().lower(), value)
    return bool(value) if isinstance(value, (bool, int)) and value in (0, 1) else _MISFIT


def _reader(ddl: str) -> Callable[[Any], Any]:
    if ddl.startswith("struct"):
        names = tuple(part.partition(":")[0] for part in ddl[len("struct<") : -1].split(","))
        return lambda value: _struct(value, names)
    return {"string": _text, "int": _int, "boolean": _boolean, "array<string>": _strings}[ddl]


_READERS = {role: {c: _reader(t) for c, t in own.items()} for role, own in FIELDS.items() if role != "row"}


def _payload(fields: dict[str, Any], role: str) -> tuple:
    """The values of PAYLOAD of a raw node."""
    if role == "row":
        return tuple([(str(k), _text(v)) for k, v in fields.items()] if c == "cells" else None for c in PAYLOAD)
    own = {c: read(fields[c]) for c, read in _READERS[role].items() if fields.get(c) is not None}
    misfits = [(c, json.dumps(fields[c], ensure_ascii=False)) for c, v in own.items() if v is _MISFIT]
    own = {c: None if v is _MISFIT else v for c, v in own.items()} | {"misfits": misfits or None}
    return tuple(own.get(c) for c in PAYLOAD)


def _walk(value: Any, role: str, parent: str, out: list[tuple], record: str) -> list[str]:
    """Adds the nodes under ``parent`` to ``out`` and returns the states of the direct ones."""
    letter, _, below = ROLES[role]
    states = []
    for place, node in enumerate(entries(value, role), 1):
        if node is None:
            continue
        me = f"{parent}/{letter}{place}"
        at = len(out)
        out.append((parent, me))
        fields = node if isinstance(node, dict) else {"text": _text(node)}
        children = {r: _walk(fields.get(ROLES[r][1]), r, me, out, record) for r in below}
        for name, tests in RULES[role]:
            if all(
                (fields.get(t[1]) == t[2]) if t[0] == "is"
                else (t[1] in fields if role == "row" else fields.get(t[1]) is not None) if t[0] == "has"
                else (bool(children[t[1]]) if len(t) == 2 else t[2] in children[t[1]])
                for t in tests
            ):
                states.append(name)
                break
        out[at] = (parent, me, record, role, place, states[-1], *_payload(fields, role))
    return states


def raw_nodes(raw: DataFrame) -> DataFrame:
    """Nodes of raw JSON bodies; ``raw`` has doc_id, volume and body. Redelivered bodies repeat their nodes.

    ``delivered`` is when a node's body came: received_at and raw_id, where there are such columns.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    ddl = f"{NODE_WIDE}, delivered string"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for record, body, delivered in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = len(rows)
                try:
                    tree = _loads(body or "")
                except ValueError:
                    continue
                if isinstance(tree, dict):
                    _walk(tree.get("elements"), "element", record, rows, record)
                rows[at:] = [(*row, delivered) for row in rows[at:]]
                if len(rows) > 20_000:
                    yield from _batches(rows, schema)
                    rows = []
            yield from _batches(rows, schema)

    record = F.concat_ws("|", F.coalesce("doc_id", F.lit("")), F.coalesce(F.col("volume").cast("string"), F.lit("")))
    order = [F.lpad(F.coalesce(F.unix_micros(F.col("received_at").cast("timestamp")), F.lit(0)).cast("string"), 20, "0")] if "received_at" in raw.columns else []
    order += [F.lpad(F.col("raw_id").cast("string"), 20, "0")] if "raw_id" in raw.columns else []
    return raw.select(record.alias("record"), "body", F.concat_ws("|", *order).alias("delivered")).mapInArrow(run, ddl)


def _batches(rows: list[tuple], schema: Any) -> Iterator[Any]:
    import pyarrow as pa

    if rows:
        cols = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


# -------------------------------------------------------------------------------------------------------- the tables


def nodes(current: DataFrame, raw: DataFrame) -> DataFrame:
    """The supertype table: every node with its parent, role, place, variant and common fields.

    A node that several raw bodies give is that of the body delivered last. The two sources hold different records; a
    record in both would have the nodes of both.
    """
    found = raw_nodes(raw)
    rest = [c for c in found.columns if c not in ("child_id", "delivered")]
    extra = found.groupBy("child_id").agg(*(F.max_by(c, "delivered").alias(c) for c in rest))
    return typed_nodes(current).unionByName(extra)


#: Subtype tables: name -> (role, columns). The variant column tells the subtype within the table.
TABLES: dict[str, tuple[str, tuple[str, ...]]] = {
    f"{role}s": (role, (*own, *(() if role == "row" else ("misfits",)))) for role, own in FIELDS.items()
}


def flat_table(all_nodes: DataFrame, name: str) -> DataFrame:
    """One flat table of ``TABLES``: supertype keys, parent link, variant, and the role's own columns."""
    role, cols = TABLES[name]
    return all_nodes.where(F.col("role") == role).select("record", "parent_id", "child_id", "place", "variant", *cols)


def variants() -> list[tuple[str, str]]:
    """(role, variant) of every subtype table."""
    return [(role, v) for role, _ in TABLES.values() for v in dict.fromkeys(v for v, _ in RULES[role])]


def subtypes(all_nodes: DataFrame) -> dict[str, DataFrame]:
    """The nodes of each structural variant, ``role_variant``, with the columns of ``all_nodes``."""
    return {f"{role}_{variant}": all_nodes.where((F.col("role") == role) & (F.col("variant") == variant)) for role, variant in variants()}


#: Columns that belong to a variant; variants without an entry may hold any field of their role.
VARIANT_COLUMNS: dict[str, tuple[str, ...]] = {
    "element_article": ("id", "number", "title", "chapter", "intro", "text"),
    "element_annex": ("id", "number", "title", "intro", "text"),
    "element_section": ("id", "level", "title", "path", "text"),
    "paragraph_plain": ("index", "number", "text"),
    "paragraph_bare": ("index", "number", "intro"),
    "point_bare": ("label",),
    "subpoint_plain": ("label", "text"),
    "subpoint_bare": ("label",),
    "item_bare": ("index", "number", "label", "category", "intro", "cited_act"),
    "block_table": ("id", "kind", "columns"),
    "block_list": ("id", "ordered", "items"),
    "block_paragraph": ("id", "text"),
    "row_key_value": ("key", "value"),
}


def variant_table(all_nodes: DataFrame, name: str) -> DataFrame:
    """The table of one structural variant: its own columns, and in ``others``, as text, any other values of its nodes."""
    role = name.split("_")[0]
    cols = VARIANT_COLUMNS.get(name, tuple(FIELDS[role]))
    table = subtypes(all_nodes)[name]
    if name == "row_key_value":
        table = table.withColumns({c: F.col("cells")[c] for c in VARIANT_COLUMNS[name]})
        others = F.map_filter("cells", lambda k, _: ~k.isin("key", "value"))
    else:
        rest = {c: t for c, t in FIELDS[role].items() if c not in cols}
        pairs = [F.struct(F.lit(c).alias("k"), (F.to_json(c) if "<" in t else F.col(c).cast("string")).alias("v")) for c, t in rest.items()]
        others = F.map_from_entries(F.filter(F.array(*pairs), lambda p: p["v"].isNotNull())) if pairs else F.create_map().cast("map<string,string>")
    table = table.withColumn("others", F.when(F.size(others) > 0, others))
    return table.select("record", "parent_id", "child_id", "place", *cols, "others", "misfits")


def variant_tables(all_nodes: DataFrame) -> dict[str, DataFrame]:
    """One table per structural variant, ``role_variant``; write ``all_nodes`` first if several are used."""
    return {name: variant_table(all_nodes, name) for name in subtypes(all_nodes)}


def links(current: DataFrame, raw: DataFrame) -> DataFrame:
    """(parent_id, child_id) of every node of both sources, each link once, read from the subtype tables.

    Every node is classified by the automaton; the keys of the supertype table are written once, each variant to its own
    folder, and the links are those of the variants' tables. A record that stands in both sources repeats links; the narrow
    pairs are made distinct, which Spark starts before its shuffle.
    """
    keys = cut(nodes(current, raw).select("parent_id", "child_id", "role", "variant"), "role", "variant")
    return reduce(DataFrame.unionByName, [t.select("parent_id", "child_id") for t in subtypes(keys).values()]).distinct()
