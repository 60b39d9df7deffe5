"""Queries over whole texts and lines of ``documents``, ``metadata`` and ``links``, with SQL that computes them anew."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import textnorm as T
from ..operators import metadata as M
from ..operators.current import current_metadata, current_structure
from ..operators.generic import line_table
from . import sqltext as S

QUERIES = {}
ORACLES = {}


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet").select(F.col("doc_id").cast("string").alias("doc_id"), "text")


def _whole(name: str, expression, sql) -> None:
    """A query of one value a document, compared by length and hash."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        v = expression(F.col("text"))
        return _docs(spark, d).select("doc_id", v.alias("v")).select("doc_id", F.length("v").cast("bigint").alias("chars"), F.md5("v").alias("digest"))

    QUERIES[name] = run
    ORACLES[name] = f"WITH v AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, {sql('text')} AS v FROM documents) SELECT doc_id, CAST(length(v) AS BIGINT) AS chars, md5(v) AS digest FROM v"


_whole("clean_unicode_ws", T.unicode_whitespace, S.unicode_whitespace)
_whole("clean_line_ws", T.line_whitespace, S.line_whitespace)
_whole("clean_superscripts", T.superscripts, S.superscripts)
_whole("clean_empty_markers", T.empty_marker_lines, S.empty_marker_lines)
_whole("clean_blank_collapse", T.blank_lines, S.blank_lines)


def _clean_sql(x: str) -> str:
    return S.strip(S.blank_lines("d"))


def clean_markdown(spark: SparkSession, d: str) -> DataFrame:
    v = T.clean_markdown(F.col("text"))
    return _docs(spark, d).select("doc_id", v.alias("v")).select("doc_id", F.length("v").cast("bigint").alias("chars"), F.md5("v").alias("digest"))


QUERIES["clean_markdown"] = clean_markdown
ORACLES["clean_markdown"] = f"""
WITH a AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, {S.unicode_whitespace("text")} AS a FROM documents),
b AS (SELECT doc_id, {S.line_whitespace("a")} AS b FROM a), c AS (SELECT doc_id, {S.superscripts("b")} AS c FROM b),
d AS (SELECT doc_id, {S.empty_marker_lines("c")} AS d FROM c), e AS (SELECT doc_id, {_clean_sql("d")} AS v FROM d)
SELECT doc_id, CAST(length(v) AS BIGINT) AS chars, md5(v) AS digest FROM e"""

_LINES = f"""
WITH lf AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, {S.breaks_to_lf("text")} AS t FROM documents WHERE text IS NOT NULL),
parts AS (SELECT doc_id, {S.lines_cheap("t")} AS p FROM lf),
lines AS (SELECT doc_id, unnest(p) AS raw, unnest(range(len(p))) AS line_no FROM parts)"""


def _per_line(name: str, expression, sql) -> None:
    """A query of one value a line; lines for which it is empty are left out."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        df = _docs(spark, d).select("doc_id", F.posexplode(T.split_lines(F.col("text"))).alias("line_no", "raw"))
        return df.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), expression(F.col("raw")).alias("v")).where("v <> ''")

    QUERIES[name] = run
    ORACLES[name] = f"{_LINES}, v AS (SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, {sql('raw')} AS v FROM lines) SELECT * FROM v WHERE v <> ''"


_per_line("clean_line", T.clean_line, S.clean_line)
_per_line("normalize_text", T.normalize_text, S.normalize_text)
_per_line("remove_list_separator", T.remove_list_separator, lambda x: S.strip(S.sub(x, rf"\A[{T.WS}]*[-–—•·][{T.WS}]*")))


def _match(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {S.q(pattern)})"


def line_kinds(spark: SparkSession, d: str) -> DataFrame:
    """How many cleaned lines of each kind the legal grammar sees in a document."""
    df = _docs(spark, d).select("doc_id", F.explode(F.transform(T.split_lines(F.col("text")), T.clean_line)).alias("line")).where("line <> ''")
    return df.groupBy("doc_id", T.line_kind(F.col("line")).alias("kind")).agg(F.count("*").alias("n"))


QUERIES["line_kinds"] = line_kinds
ORACLES["line_kinds"] = f"""{_LINES}, c AS (SELECT doc_id, {S.clean_line("raw")} AS line FROM lines)
SELECT doc_id, CASE WHEN {_match("line", T.CHAPTER_LINE)} THEN 'chapter' WHEN {_match("line", T.ARTICLE_LINE)} THEN 'article'
WHEN {_match("line", T.ANNEX_LINE)} THEN 'annex' WHEN {_match("line", T.SECTION_LINE)} THEN 'section' WHEN starts_with(line, '|') THEN 'table' ELSE 'text' END AS kind,
count(*) AS n FROM c WHERE line <> '' GROUP BY ALL"""


def markdown_kinds(spark: SparkSession, d: str) -> DataFrame:
    """How many lines of each kind the Markdown grammar sees in a document."""
    return line_table(_docs(spark, d)).groupBy("doc_id", "kind").agg(F.count("*").alias("n"), F.sum(F.length("line")).alias("chars"))


_MD_KIND = f"""CASE WHEN line = '' THEN 'blank' WHEN {_match("line", T.HEADING_LINE)} THEN 'heading' WHEN starts_with(line, '|') THEN 'table'
WHEN {_match("line", T.ORDERED_LINE)} THEN 'ordered' WHEN {_match("line", T.UNORDERED_LINE)} THEN 'unordered' ELSE 'text' END"""
QUERIES["markdown_kinds"] = markdown_kinds
ORACLES["markdown_kinds"] = f"""{_LINES}, s AS (SELECT doc_id, {S.strip("raw")} AS line FROM lines)
SELECT doc_id, {_MD_KIND} AS kind, count(*) AS n, CAST(sum(length(line)) AS BIGINT) AS chars FROM s GROUP BY ALL"""


def detect_structure_type(spark: SparkSession, d: str) -> DataFrame:
    """Article lines of each document and the parser that follows from them."""
    return M.routed(_docs(spark, d)).select("doc_id", F.col("articles").cast("bigint").alias("articles"), "structure_type")


QUERIES["detect_structure_type"] = detect_structure_type
ORACLES["detect_structure_type"] = f"""{_LINES}, n AS (SELECT doc_id, count(*) FILTER (WHERE {_match(S.clean_line("raw"), T.ARTICLE_LINE)}) AS n FROM lines GROUP BY doc_id)
SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, coalesce(n, 0) AS articles, CASE WHEN coalesce(n, 0) >= 3 THEN 'legal' ELSE 'generic' END AS structure_type
FROM documents d LEFT JOIN n ON n.doc_id = CAST(d.doc_id AS VARCHAR)"""


def generic_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines, characters and list items of every heading section, by a running count of headings."""
    w = Window.partitionBy("doc_id").orderBy("line_no")
    df = line_table(_docs(spark, d)).withColumn("section", F.sum(F.when(F.col("kind") == "heading", 1).otherwise(0)).over(w))
    item = F.col("kind").isin("ordered", "unordered").cast("int")
    return df.groupBy("doc_id", "section").agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("chars"), F.sum(item).cast("bigint").alias("items"))


QUERIES["generic_lines"] = generic_lines
ORACLES["generic_lines"] = f"""{_LINES}, s AS (SELECT doc_id, line_no, {S.strip("raw")} AS line FROM lines), k AS (SELECT *, {_MD_KIND} AS kind FROM s),
g AS (SELECT *, sum(CASE WHEN kind = 'heading' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS section FROM k)
SELECT doc_id, CAST(section AS BIGINT) AS section, count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars,
count(*) FILTER (WHERE kind IN ('ordered', 'unordered')) AS items FROM g GROUP BY doc_id, section"""


# ------------------------------------------------------------------------------------------- metadata, links, files


def _meta(spark: SparkSession, d: str) -> DataFrame:
    return current_metadata(spark.read.parquet(f"{d}/metadata.parquet"))


_CURRENT = "WITH m AS (SELECT * FROM metadata QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY revision DESC NULLS LAST, loaded_at DESC NULLS LAST) = 1)"


def metadata_current(spark: SparkSession, d: str) -> DataFrame:
    """The current sidecar of every document."""
    return _meta(spark, d).select("doc_id", "revision", "title", "celex", "eli", "language", "publication_date", "source", "source_url", "source_type")


QUERIES["metadata_current"] = metadata_current
ORACLES["metadata_current"] = f"{_CURRENT} SELECT doc_id, revision, title, celex, eli, language, publication_date, source, source_url, source_type FROM m"


def slugs(spark: SparkSession, d: str) -> DataFrame:
    """Slug of every current title, of the doc_id where there is none."""
    return _meta(spark, d).select("doc_id", T.slugify(F.coalesce("title", "doc_id")).alias("slug"))


QUERIES["slugify"] = slugs
ORACLES["slugify"] = f"{_CURRENT} SELECT doc_id, {S.slugify('coalesce(title, doc_id)')} AS slug FROM m"


def instrument_projection(spark: SparkSession, d: str) -> DataFrame:
    """Bibliographic fields as JSON, nulls left out."""
    return M.instrument_json(_meta(spark, d))


_FIELDS = ("celex", "eli", "title", "language", "publication_date")
QUERIES["instrument_projection"] = instrument_projection
ORACLES["instrument_projection"] = (
    f"{_CURRENT} SELECT doc_id, '{{' || array_to_string(list_filter(["
    + ", ".join(f"CASE WHEN {f} IS NOT NULL THEN '\"{f}\":' || CAST(to_json({f}) AS VARCHAR) END" for f in _FIELDS)
    + "], lambda v: v IS NOT NULL), ',') || '}' AS instrument FROM m"
)


def metadata_join(spark: SparkSession, d: str) -> DataFrame:
    """Current structure records with their current sidecar, defaults where there is none."""
    docs = current_structure(spark.read.parquet(f"{d}/structure.parquet")).select("doc_id", "volume")
    meta = _meta(spark, d)
    return M.with_metadata(docs, meta).select("doc_id", "volume", "title", "source", "source_type", "placeholder")


QUERIES["metadata_join"] = metadata_join
ORACLES["metadata_join"] = f"""{_CURRENT}, s AS (SELECT DISTINCT doc_id, volume FROM structure)
SELECT s.doc_id, s.volume, CASE WHEN m.doc_id IS NULL THEN s.doc_id ELSE m.title END AS title, m.source, m.source_type, m.doc_id IS NULL AS placeholder
FROM s LEFT JOIN m ON m.doc_id = s.doc_id"""


def structure_router(spark: SparkSession, d: str) -> DataFrame:
    """Parser of each current structure record: as declared in the sidecar, else by source type, else generic."""
    docs = current_structure(spark.read.parquet(f"{d}/structure.parquet")).select("doc_id", "volume")
    df = M.with_metadata(docs, _meta(spark, d))
    return df.select("doc_id", "volume", M.structure_type(F.try_element_at("extra", F.lit("structure_type")), F.col("source_type"), F.lit(0)).alias("structure_type"))


QUERIES["structure_router"] = structure_router
ORACLES["structure_router"] = f"""{_CURRENT}, s AS (SELECT DISTINCT doc_id, volume FROM structure)
SELECT s.doc_id, s.volume, CASE WHEN extra['structure_type'] IN ('legal', 'generic') THEN extra['structure_type']
WHEN lower(source_type) IN ('regulation', 'directive', 'decision', 'legal', 'law', 'act') THEN 'legal' ELSE 'generic' END AS structure_type
FROM s LEFT JOIN m ON m.doc_id = s.doc_id"""


def missing_artifacts(spark: SparkSession, d: str) -> DataFrame:
    """Documents with chunks but without a sidecar."""
    chunks = spark.read.parquet(f"{d}/chunks.parquet").select("doc_id").distinct()
    return M.without_artifact(chunks, spark.read.parquet(f"{d}/metadata.parquet"))


QUERIES["missing_artifacts"] = missing_artifacts
ORACLES["missing_artifacts"] = "SELECT DISTINCT doc_id FROM chunks WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM metadata WHERE doc_id IS NOT NULL)"


def detect_extension(spark: SparkSession, d: str) -> DataFrame:
    """Suffix of every link's target, with a content type made from its number."""
    kinds = ["application/pdf", "text/html; charset=utf-8", "text/plain", "application/octet-stream"]
    kind = F.element_at(F.array(*map(F.lit, kinds)), (F.pmod("link_number", F.lit(4)) + 1).cast("int"))
    df = spark.read.parquet(f"{d}/links.parquet").where("uri is not null").select("uri", kind.alias("kind")).distinct()
    return df.select("uri", "kind", T.detect_extension(F.col("kind"), F.col("uri")).alias("extension"))


_PATH = r"regexp_extract(uri, '\A(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
_SUFFIX = rf"lower(regexp_extract({_PATH}, '[^/.](\.[^./]*)\z', 1))"
_KIND = "(['application/pdf', 'text/html; charset=utf-8', 'text/plain', 'application/octet-stream'])[CAST(link_number % 4 + 1 AS INTEGER)]"
QUERIES["detect_extension"] = detect_extension
ORACLES["detect_extension"] = f"""WITH u AS (SELECT DISTINCT uri, {_KIND} AS kind FROM links WHERE uri IS NOT NULL)
SELECT uri, kind, CASE WHEN kind LIKE 'application/pdf%' THEN '.pdf' WHEN kind LIKE 'text/html%' THEN '.html' WHEN kind = 'text/plain' THEN '.txt'
WHEN {_SUFFIX} = '.htm' THEN '.html' WHEN {_SUFFIX} IN ('.pdf', '.html', '.txt', '.xml', '.docx') THEN {_SUFFIX} ELSE '.html' END AS extension FROM u"""


def build_filename(spark: SparkSession, d: str) -> DataFrame:
    """File name of every link's target."""
    df = spark.read.parquet(f"{d}/links.parquet").where("uri is not null").select("uri").distinct()
    return df.select("uri", T.build_filename(F.col("uri"), F.lit(".html")).alias("file_name"))


_NAME = rf"regexp_extract(regexp_replace({_PATH}, '/+\z', ''), '([^/]*)\z', 1)"
QUERIES["build_filename"] = build_filename
ORACLES["build_filename"] = rf"""SELECT DISTINCT uri, coalesce(nullif(regexp_replace({_NAME}, '(.)\.[^.]*\z', '\1'), ''), 'downloaded_document') || '.html' AS file_name
FROM links WHERE uri IS NOT NULL"""


def distinct_stems(spark: SparkSession, d: str) -> DataFrame:
    """Stems of the files that links name."""
    return M.stems(spark.read.parquet(f"{d}/links.parquet").where("file_name is not null").select(F.col("file_name").alias("path")))


QUERIES["distinct_stems"] = distinct_stems
ORACLES["distinct_stems"] = r"""SELECT DISTINCT regexp_replace(regexp_extract(file_name, '([^/]*)\z', 1), '(.)\.[^.]*\z', '\1') AS stem FROM links
WHERE file_name IS NOT NULL AND NOT ends_with(file_name, '.meta.json') AND regexp_extract(file_name, '([^/]*)\z', 1) <> ''"""


def first_supported(spark: SparkSession, d: str) -> DataFrame:
    """The preferred file of each stem among the files that links name."""
    return M.first_supported(spark.read.parquet(f"{d}/links.parquet").where("file_name is not null").select(F.col("file_name").alias("path")))


QUERIES["first_supported"] = first_supported
ORACLES["first_supported"] = r"""WITH f AS (SELECT DISTINCT file_name AS path, regexp_extract(file_name, '([^/]*)\z', 1) AS name FROM links WHERE file_name IS NOT NULL),
r AS (SELECT regexp_replace(name, '(.)\.[^.]*\z', '\1') AS stem, path, list_position(['pdf', 'html', 'txt', 'docx', 'xml'], lower(regexp_extract(name, '\.([^.]*)\z', 1))) AS k FROM f)
SELECT stem, path FROM r WHERE k IS NOT NULL AND k > 0 QUALIFY row_number() OVER (PARTITION BY stem ORDER BY k, path) = 1"""


def link_counts(spark: SparkSession, d: str) -> DataFrame:
    """Links of every document by type, each link once, with the pages they lead to and the area they take up."""
    links = spark.read.parquet(f"{d}/links.parquet").dropDuplicates(["doc_id", "volume", "source_page", "link_number"])
    area = (F.col("rect.x1") - F.col("rect.x0")) * (F.col("rect.y1") - F.col("rect.y0"))
    return links.groupBy("doc_id", "link_type").agg(F.count("*").alias("n"), F.count_distinct("target_page").alias("pages"), F.count("uri").alias("uris"), F.sum(F.when(area.isNull(), 1).otherwise(0)).alias("no_area"))


QUERIES["link_counts"] = link_counts
ORACLES["link_counts"] = """WITH l AS (SELECT * FROM links QUALIFY row_number() OVER (PARTITION BY doc_id, volume, source_page, link_number ORDER BY uri) = 1)
SELECT doc_id, link_type, count(*) AS n, count(DISTINCT target_page) AS pages, count(uri) AS uris,
count(*) FILTER (WHERE (rect.x1 - rect.x0) * (rect.y1 - rect.y0) IS NULL) AS no_area FROM l GROUP BY ALL"""


def vector_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """The five nearest vectors, by cosine, of every vector whose id is divisible by 100."""
    from ..operators.vectors import nearest

    vectors = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors.where("vec_id % 100 = 0"), vectors, 5).select("query_id", "vec_id", F.col("rank").cast("bigint").alias("rank"))


QUERIES["vector_neighbours"] = vector_neighbours
ORACLES["vector_neighbours"] = """WITH p AS (SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])) AS s
FROM embeddings q, embeddings v WHERE q.vec_id % 100 = 0 AND v.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank FROM p) SELECT query_id, vec_id, rank FROM r WHERE rank <= 5"""

