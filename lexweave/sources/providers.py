"""Conversion providers: plug-ins that turn a source file into Markdown, a layout and links, run in Arrow batches.

A provider is named by a spec; its code is loaded where it runs, so a library that is not installed matters only to those
who use it. Options that are announced but not there raise ``NotImplementedError`` when they are used.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINK = "struct<source_page:int,link_number:int,kind:int,rect:struct<x0:double,y0:double,x1:double,y1:double>,target:int,position:struct<x:double,y:double>,uri:string,file_name:string>"


@dataclass
class Converted:
    """What a provider makes of one file: ``pages`` of Markdown, a layout as JSON, and raw links with pages counted from 0."""

    pages: list[str]
    layout: str | None = None
    links: list[dict[str, Any]] | None = None


class Provider(Protocol):
    def convert(self, path: str, content: bytes) -> Converted: ...


@dataclass(frozen=True)
class ProviderSpec:
    id: str
    label: str
    load: Callable[[], Provider]
    implemented: bool = True


class _Missing:
    def __init__(self, name: str) -> None:
        self.name = name

    def convert(self, path: str, content: bytes) -> Converted:
        raise NotImplementedError(f"provider {self.name} is not implemented")


class PlainText:
    """Text files as they are; form feeds part pages."""

    def convert(self, path: str, content: bytes) -> Converted:
        return Converted(content.decode("utf-8", "replace").split("\f"), None, [])


class HostedElements:
    """Element documents of a hosted parser, saved as JSON [{page_content, metadata}]: their texts are joined by blank lines."""

    def convert(self, path: str, content: bytes) -> Converted:
        elements = json.loads(content)
        texts = [e["page_content"] for e in elements if (e.get("page_content") or "").strip()]
        if not texts:
            raise RuntimeError(f"{path}: the parser gave no content")
        layout = json.dumps([{"text": e.get("page_content"), "metadata": e.get("metadata")} for e in elements], ensure_ascii=False)
        return Converted(["\n\n".join(texts)], layout, [])


class NativePdf:
    """PDF files by a native library, where one is installed."""

    def __init__(self) -> None:
        try:
            import pymupdf
            import pymupdf4llm
        except ImportError as e:
            raise RuntimeError("no PDF library is installed") from e
        self.library, self.markdown = pymupdf, pymupdf4llm

    def convert(self, path: str, content: bytes) -> Converted:
        links = []
        with self.library.open(stream=content, filetype="pdf") as doc:
            for number, page in enumerate(doc):
                for place, link in enumerate(page.get_links()):
                    box, to = link.get("from"), link.get("to")
                    links.append({
                        "page": number, "number": place, "kind": link.get("kind"), "rect": box and [box.x0, box.y0, box.x1, box.y1],
                        "target": link.get("page"), "position": to and [to.x, to.y], "uri": link.get("uri"), "file": link.get("file"),
                    })
            pages = [p["text"] for p in self.markdown.to_markdown(doc, header=False, footer=False, page_chunks=True)]
            layout = self.markdown.to_json(doc)
        return Converted(pages, layout, links)


PROVIDERS: list[ProviderSpec] = [
    ProviderSpec("pdf-native", "PDF by a native library", NativePdf),
    ProviderSpec("hosted", "Elements of a hosted parser", HostedElements),
    ProviderSpec("text", "Plain text", PlainText),
    *(ProviderSpec(f"option{n}", f"Option {n}", lambda n=n: _Missing(f"option{n}"), implemented=False) for n in (3, 4, 5)),
]


def list_providers() -> list[tuple[str, str, bool]]:
    """(id, label, implemented) of every provider; the first is the default."""
    return [(p.id, p.label, p.implemented) for p in PROVIDERS]


def provider_spec(name: str) -> ProviderSpec:
    for p in PROVIDERS:
        if p.id == name:
            return p
    raise ValueError(f"unknown provider {name!r}; there are {', '.join(p.id for p in PROVIDERS)}")


def link_type(kind: Column) -> Column:
    """``internal`` for a link to a page, ``external`` for an address, else ``other``."""
    return F.when(kind == 1, "internal").when(kind == 2, "external").otherwise("other")


def convert(files: DataFrame, load: Callable[[], Provider]) -> DataFrame:
    """(path, pages, layout, links, error) of files (path, content).

    A file that cannot be converted has its error and no pages; a provider that cannot be loaded fails the job. Links count
    pages and places from 1.
    """
    ddl = f"path string, pages array<string>, layout string, links array<{LINK}>, error string"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def link(x: dict[str, Any]) -> dict[str, Any]:
        box, spot = x.get("rect"), x.get("position")
        return {
            "source_page": x["page"] + 1, "link_number": x["number"] + 1, "kind": x.get("kind"),
            "rect": box and dict(zip(("x0", "y0", "x1", "y1"), box, strict=True)), "target": None if x.get("target") is None else x["target"] + 1,
            "position": spot and dict(zip(("x", "y"), spot, strict=True)), "uri": x.get("uri"), "file_name": x.get("file"),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        provider = load()
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    c = provider.convert(path, content or b"")
                    row = {"path": path, "pages": c.pages, "layout": c.layout, "links": [link(x) for x in c.links or []], "error": None}
                except NotImplementedError:
                    raise
                except Exception as e:  # one bad file must not end the batch
                    row = {"path": path, "pages": None, "layout": None, "links": None, "error": f"{type(e).__name__}: {e}"[:500]}
                yield pa.RecordBatch.from_pylist([row], schema=schema)

    return files.select("path", "content").mapInArrow(run, ddl)


def flat_links(converted: DataFrame) -> DataFrame:
    """One row a link with its type."""
    df = converted.select("path", F.explode("links").alias("l")).select("path", "l.*")
    return df.withColumn("link_type", link_type(F.col("kind")))


def paged_text(pages: Column) -> Column:
    """Pages joined, each under a banner with its number."""
    return F.array_join(F.transform(pages, lambda p, i: F.concat(F.lit("\n--- PAGE "), (i + 1).cast("string"), F.lit(" ---\n"), p)), "\n")
