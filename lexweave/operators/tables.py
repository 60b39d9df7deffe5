"""Pipe tables as ordered rows of (column, value)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.textnorm import is_bold, let, strip, strip_markdown

CELL = "struct<col:string,val:string>"
BLOCK = f"struct<id:string,type:string,text:string,ordered:boolean,items:array<string>,kind:string,columns:array<string>,rows:array<array<{CELL}>>>"


def make_block(kind: str, text: Column | None = None, ordered: Column | None = None, items: Column | None = None, table: Column | None = None) -> Column:
    """A block without id; ``table`` is struct(kind, columns, rows)."""
    none = F.lit(None)
    return F.struct(
        none.cast("string").alias("id"), F.lit(kind).alias("type"),
        (none.cast("string") if text is None else text).alias("text"),
        (none.cast("boolean") if ordered is None else ordered).alias("ordered"),
        (none.cast("array<string>") if items is None else items).alias("items"),
        (none.cast("string") if table is None else table["kind"]).alias("kind"),
        (none.cast("array<string>") if table is None else table["columns"]).alias("columns"),
        (none.cast(f"array<array<{CELL}>>") if table is None else table["rows"]).alias("rows"),
    )


def cells(line: Column) -> Column:
    """Stripped cells of a table line, all pipes at its ends removed."""
    return F.transform(F.split(F.regexp_replace(strip(line), r"\A\|+|\|+\z", ""), r"\|", -1), lambda x: strip(x))


def parse_table(lines: Column) -> Column:
    """struct(kind, columns, rows) of the lines of a pipe table; null if they hold no row.

    Separator rows are left out and short rows filled up. Rows of bold labels alternating with rows of plain values, and
    two columns of which the first is bold throughout, are key-value tables; any other table has its first row as header.
    """
    rows = F.filter(F.transform(lines, cells), lambda r: ~F.forall(r, lambda c: c.rlike(r"\A:?-{3,}:?\z")))
    return let(rows, _shaped)


def _shaped(rows: Column) -> Column:
    fill = lambda w: F.transform(rows, lambda r: F.concat(r, F.array_repeat(F.lit(""), w - F.size(r))))
    full = let(F.array_max(F.transform(rows, F.size)), fill)
    return F.when(F.size(rows) > 0, let(full, lambda r: let(F.filter(r, lambda x, i: i % 2 == 0), lambda even: let(F.filter(r, lambda x, i: i % 2 == 1), lambda odd: _typed(r, even, odd)))))


def _typed(rows: Column, even: Column, odd: Column) -> Column:
    n, width = F.size(rows), F.size(F.get(rows, F.lit(0)))
    paired = (n % 2 == 0) & F.forall(even, lambda r: F.forall(r, is_bold)) & ~F.exists(odd, lambda r: F.exists(r, is_bold))
    listed = (width == 2) & F.forall(rows, lambda r: is_bold(F.get(r, F.lit(0))))
    cell = lambda k, v: F.struct(k.alias("col"), v.alias("val"))
    pair = lambda k, v: F.array(cell(F.lit("key"), strip_markdown(k)), cell(F.lit("value"), strip_markdown(v)))
    pairs = F.flatten(F.transform(even, lambda keys, i: F.zip_with(keys, F.get(odd, i), pair)))
    pairs = F.filter(pairs, lambda p: F.get(p, F.lit(0))["val"] != "")
    from_list = F.transform(rows, lambda r: pair(F.get(r, F.lit(0)), F.get(r, F.lit(1))))

    def named(acc: Column, h: Column) -> Column:
        place = (F.size(acc) + 1).cast("string")
        free = lambda name: F.when(F.array_contains(acc, name), F.concat(name, F.lit("_"), place)).otherwise(name)
        first = let(strip_markdown(h), lambda t: F.when(t == "", F.concat(F.lit("col"), place)).otherwise(t))
        return F.concat(acc, F.array(let(let(let(first, free), free), free)))

    columns = F.aggregate(F.get(rows, F.lit(0)), F.array().cast("array<string>"), named)
    kv, no_columns = F.lit("key_value"), F.lit(None).cast("array<string>")
    shape = lambda kind, cols, r: F.struct(kind.alias("kind"), cols.alias("columns"), r.alias("rows"))
    plain = let(columns, lambda cols: shape(F.lit("table"), cols, F.transform(F.slice(rows, 2, F.greatest(n - 1, F.lit(0))), lambda r: F.zip_with(cols, r, lambda c, v: cell(c, strip_markdown(v))))))
    return F.when(paired, shape(kv, no_columns, pairs)).when(listed, shape(kv, no_columns, from_list)).otherwise(plain)


def row_text(row: Column) -> Column:
    """``key: value`` of a key-value row, else ``column: value`` of the cells that hold something."""
    value = lambda name: F.get(F.filter(row, lambda c: c["col"] == name), F.lit(0))
    both = F.exists(row, lambda c: c["col"] == "key") & F.exists(row, lambda c: c["col"] == "value")
    cells_text = F.array_join(F.transform(F.filter(row, lambda c: c["val"] != ""), lambda c: F.concat(c["col"], F.lit(": "), c["val"])), "; ")
    return F.when(both, F.concat(value("key")["val"], F.lit(": "), value("value")["val"])).otherwise(cells_text)
