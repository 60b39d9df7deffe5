import io
import json

import numpy as np
import pytest

from lexweave import jobs
from lexweave.operators.vectors import nearest
from lexweave.plans import catalogue
from lexweave.sources import database, files, providers, web
from lexweave.streaming import incremental


class Fake:
    def convert(self, path, content):
        if content == b"bad":
            raise ValueError("no")
        return providers.Converted(["p1", "p2"], None, [{"page": 0, "number": 0, "kind": 1, "rect": (0.0, 1.0, 2.0, 3.0), "target": 4}, {"page": 1, "number": 0, "kind": 2, "uri": "u"}])


def test_providers(spark):
    df = spark.createDataFrame([("a.pdf", b"x"), ("b.pdf", b"bad"), ("c.pdf", None)], "path string, content binary")
    out = providers.convert(df, Fake).cache()
    assert {r.path: (r.pages, r.error) for r in out.collect()}["b.pdf"] == (None, "ValueError: no")
    assert sorted((r.path, r.source_page, r.target, r.link_type) for r in providers.flat_links(out).where("path = 'a.pdf'").collect()) == [("a.pdf", 1, 5, "internal"), ("a.pdf", 2, None, "external")]
    assert out.where("path = 'a.pdf'").select(providers.paged_text(out["pages"]).alias("t")).first().t == "\n--- PAGE 1 ---\np1\n\n--- PAGE 2 ---\np2"


def test_provider_registry():
    assert [p[0] for p in providers.list_providers()][:2] == ["pdf-native", "hosted"]
    with pytest.raises(ValueError, match="unknown provider"):
        providers.provider_spec("x")
    with pytest.raises(NotImplementedError):
        providers.provider_spec("option3").load().convert("p", b"")
    made = providers.HostedElements().convert("p", json.dumps([{"page_content": "a"}, {"page_content": " "}, {"page_content": "b"}]).encode())
    assert made.pages == ["a\n\nb"]
    with pytest.raises(RuntimeError):
        providers.HostedElements().convert("p", b"[]")


def test_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.y.txt").write_text("# H\ntext", encoding="utf-8")
    (tmp_path / "in/x.y.meta.json").write_text('{"title": "T", "domain": "d"}')
    assert [tuple(r) for r in files.read_documents(spark, str(tmp_path / "in/*.txt")).collect()] == [("x.y", "# H\ntext")]
    meta = files.read_sidecars(spark, str(tmp_path / "in/*.meta.json"))
    assert tuple(meta.select("stem", "doc_id").first()) == ("x.y", "t")
    assert [r.stem for r in files.read_binary(spark, str(tmp_path / "in")).collect()] == ["x.y"]
    from lexweave.operators import metadata, pipeline

    e = pipeline.elements(files.read_documents(spark, str(tmp_path / "in/*.txt")))
    files.write_structures(e, metadata.instrument_json(meta), str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s")).first().structure_type == "generic"
    files.write_chunks(pipeline.document_chunks(files.read_documents(spark, str(tmp_path / "in/*.txt"))), str(tmp_path / "c"))
    assert spark.read.json(str(tmp_path / "c")).first().chunk_id == "x.y:sec1#1"
    files.write_sidecars(meta, str(tmp_path / "m"))
    assert json.loads(spark.read.text(str(tmp_path / "m")).first().value) == {"doc_id": "t", "title": "T", "domain": "d"}


def test_web_and_database(tmp_path):
    class Answer(io.BytesIO):
        headers = {"Content-Type": "text/html; charset=x"}

        def geturl(self):
            return "https://a.b/dir/page.php?q"

    path, kind = web.download("https://a.b", str(tmp_path), lambda request, timeout: Answer(b"hi"))
    assert path.name == "page.html" and path.read_bytes() == b"hi" and kind.startswith("text/html")
    assert database.jdbc_options({"POSTGRES_HOST": "h", "POSTGRES_DB": "d"})["url"] == "jdbc:postgresql://h:5432/d"


def test_stream(spark, tmp_path):
    spark.createDataFrame([("a", "# H\ntext")], "doc_id string, text string").write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        incremental.ingest(incremental.document_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    assert [r.chunk_id for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["a:sec1#1"]
    spark.createDataFrame([("b", "more")], "doc_id string, text string").write.mode("append").parquet(str(tmp_path / "in"))
    incremental.ingest(incremental.document_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    assert sorted(r.chunk_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a:sec1#1", "b:sec1#1"]


def test_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(60)] + [(60, None), (61, []), (62, [0.0] * 4), (63, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {(r.query_id, r["rank"]): r.vec_id for r in nearest(df.where("vec_id < 3"), df, 3).collect()}
    m = np.array([v for _, v in rows[:60]])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    for q in range(3):
        s = m @ m[q]
        s[q] = -9
        assert [got[q, k] for k in (1, 2, 3)] == np.argsort(-s)[:3].tolist()
    assert nearest(df.where("false"), df, 3).count() == 0


def test_jobs(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    law = "CHAPTER I\nGeneral\nArticle 1\nScope\n1. As in Article 2(1): (a) one; (b) two"
    for name, text in (("My Law", law), ("note", "# H\n- x\n- y"), ("other", "plain")):
        (tmp_path / f"in/{name}.txt").write_text(text)
    (tmp_path / "in/My Law.meta.json").write_text('{"title": "The Law", "celex": "C1", "structure_type": "legal"}')
    (tmp_path / "in/note.meta.json").write_text('{"doc_id": "n1", "title": "Note"}')
    common = ["--input", str(tmp_path / "in/*.txt"), "--format", "text", "--sidecars", str(tmp_path / "in/*.meta.json")]
    assert jobs.main(["structure", "--output", str(tmp_path / "s"), *common]) == 0
    assert "1 documents have no sidecar" in capsys.readouterr().out
    got = {(r.structure_type, r.instrument and r.instrument.celex): r.elements for r in spark.read.schema(files.STRUCTURE).json(str(tmp_path / "s")).collect()}
    article = got["legal", "C1"][0]
    assert article.id == "the-law:art1" and article.chapter.title == "General" and [b.type for b in article.blocks] == ["paragraph", "list"]
    assert [p.label for p in article.paragraphs[0].points] == ["a", "b"] and ("generic", None) in got
    assert jobs.main(["chunk", "--output", str(tmp_path / "c"), *common]) == 0
    assert {(r.doc_title, r.chunk_id) for r in spark.read.json(str(tmp_path / "c")).collect()} == {("The Law", "the-law:art1#1"), ("Note", "n1:sec1#1"), ("other", "other:sec1#1")}
    assert jobs.main(["generic", "--stem", "note", "--output", str(tmp_path / "g"), *common[:4]]) == 0
    assert [r.elements[0].id for r in spark.read.json(str(tmp_path / "g")).collect()] == ["note:sec1"]
    assert jobs.main(["legal", "--stem", "My Law", "--output", str(tmp_path / "l"), *common[:4]]) == 0
    assert [r.elements[0].id for r in spark.read.json(str(tmp_path / "l")).collect()] == ["My Law:art1"]
    assert jobs.main(["convert", "--provider", "text", "--stem", "note", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "v")]) == 0
    assert [(r.doc_id, r.text) for r in spark.read.parquet(str(tmp_path / "v/documents")).collect()] == [("note", "\n--- PAGE 1 ---\n# H\n- x\n- y")]


def test_jobs_and_catalogue(capsys):
    assert jobs.main(["providers"]) == 0 and "option3" in capsys.readouterr().out
    assert set(catalogue.oracle_sql()) <= set(catalogue.queries())


def test_native_pdf_gives_markdown_and_layout(monkeypatch):
    import contextlib
    import sys
    import types

    class Page:
        def get_links(self):
            return [{"kind": 2, "uri": "u"}]

    doc, asked = [Page(), Page()], {}
    pymupdf = types.SimpleNamespace(open=lambda stream, filetype: contextlib.nullcontext(doc))

    def to_markdown(d, **options):
        assert d is doc
        asked.update(options)
        return [{"text": "# H"}, {"text": "|a|b|"}]

    monkeypatch.setitem(sys.modules, "pymupdf", pymupdf)
    monkeypatch.setitem(sys.modules, "pymupdf4llm", types.SimpleNamespace(to_markdown=to_markdown, to_json=lambda d: '{"pages": 2}'))
    out = providers.NativePdf().convert("a.pdf", b"x")
    assert (out.pages, out.layout, [x["page"] for x in out.links]) == (["# H", "|a|b|"], '{"pages": 2}', [0, 1])
    assert asked == {"header": False, "footer": False, "page_chunks": True}
