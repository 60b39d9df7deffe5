"""Sidecar metadata: defaults, projections, and which documents lack artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.textnorm import article_lines, instrument, slugify

FIELDS = ("title", "celex", "eli", "language", "publication_date", "source", "source_url", "source_type")
#: Fixed value: source types of legal documents.
LEGAL_TYPES = ("regulation", "directive", "decision", "legal", "law", "act")
LEAST_ARTICLES = 3


def parse_sidecar(raw: DataFrame) -> DataFrame:
    """(stem, doc_id, fields, extra) of JSON sidecars (stem, json): unknown keys go to ``extra``, a literal key ``extra`` is dropped.

    A missing doc_id is the slug of the title, or else of the stem; JSON that cannot be read gives the defaults.
    """
    parsed = raw.select("stem", F.from_json("json", "map<string,string>").alias("m"))
    get = lambda k: F.try_element_at("m", F.lit(k))
    known = F.array(*map(F.lit, ("doc_id", "extra", *FIELDS)))
    return parsed.select(
        "stem", F.coalesce(get("doc_id"), slugify(F.coalesce(get("title"), F.col("stem")))).alias("doc_id"),
        *(get(f).alias(f) for f in FIELDS), F.map_filter("m", lambda k, v: ~F.array_contains(known, k)).alias("extra"),
    )


def sidecar_json(meta: DataFrame) -> DataFrame:
    """(doc_id, json): the fields, nulls left out, and ``extra`` on the same level."""
    pairs = F.array(*(F.struct(F.lit(f).alias("key"), F.col(f).alias("value")) for f in ("doc_id", *FIELDS)))
    own = F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))
    return meta.select("doc_id", F.to_json(F.map_concat(own, F.coalesce("extra", F.create_map().cast("map<string,string>")))).alias("json"))


def with_metadata(docs: DataFrame, meta: DataFrame) -> DataFrame:
    """Documents with their sidecar fields; one without a sidecar has its doc_id as title."""
    missing = F.col("m.doc_id").isNull()
    joined = docs.alias("d").join(meta.alias("m"), F.col("d.doc_id") == F.col("m.doc_id"), "left")
    return joined.select("d.*", *(F.when(missing, F.col("d.doc_id").cast("string")).otherwise(F.col("m.title")).alias(f) if f == "title" else F.col(f"m.{f}").alias(f) for f in FIELDS), F.col("m.extra").alias("extra"), missing.alias("placeholder"))


def named(docs: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Documents (doc_id: the stem, text) under the doc_id of the sidecar of their stem, or the slug of the stem without one."""
    own = sidecars.groupBy("stem").agg(F.min("doc_id").alias("own"))
    df = docs.join(own, docs["doc_id"] == own["stem"], "left").withColumn("doc_id", F.coalesce("own", slugify(docs["doc_id"])))
    return df.select(*docs.columns)


def instrument_json(meta: DataFrame) -> DataFrame:
    """(doc_id, instrument): JSON of the bibliographic fields, nulls left out."""
    return meta.select("doc_id", instrument().alias("instrument"))


def structure_type(explicit: Column, source_type: Column, articles: Column) -> Column:
    """``legal`` or ``generic``: as declared, else by source type, else by the number of article lines."""
    return F.coalesce(
        F.when(explicit.isin("legal", "generic"), explicit),
        F.when(F.lower(source_type).isin(*LEGAL_TYPES), "legal"),
        F.when(articles >= LEAST_ARTICLES, "legal"),
        F.lit("generic"),
    )


def routed(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text) with how many article lines they have and the parser that fits."""
    n = F.coalesce(article_lines(F.col("text")), F.lit(0))
    df = docs.withColumn("articles", n)
    null = F.lit(None).cast("string")
    explicit = F.col("explicit") if "explicit" in docs.columns else null
    kind = F.col("source_type") if "source_type" in docs.columns else null
    return df.withColumn("structure_type", structure_type(explicit, kind, F.col("articles")))


def stems(paths: DataFrame) -> DataFrame:
    """Distinct sorted stems of files (path); sidecars are left out, only the last suffix goes."""
    name = F.regexp_extract("path", r"([^/]*)\z", 1)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*\z", "")
    return paths.where(~name.endswith(".meta.json") & (name != "")).select(stem.alias("stem")).distinct().orderBy("stem")


#: Fixed value: the order in which formats of one stem are preferred.
FORMATS = ("pdf", "html", "txt", "docx", "xml")


def first_supported(paths: DataFrame) -> DataFrame:
    """(stem, path) of the preferred supported file of each stem."""
    name = F.regexp_extract("path", r"([^/]*)\z", 1)
    rank = F.array_position(F.array(*map(F.lit, FORMATS)), F.lower(F.regexp_extract(name, r"\.([^.]*)\z", 1)))
    df = paths.select(F.regexp_replace(name, r"(?<=.)\.[^.]*\z", "").alias("stem"), "path", rank.alias("rank")).where("rank > 0")
    return df.groupBy("stem").agg(F.min(F.struct("rank", "path")).alias("m")).select("stem", "m.path")


def first_supported_files(found: DataFrame, stems: list[str]) -> DataFrame:
    """Files (path, ...) that are the preferred ones of their stem; of the named stems if any are named."""
    best = first_supported(found.select("path"))
    return found.join(best.where(F.col("stem").isin(*stems)) if stems else best, "path", "left_semi")


def without_artifact(docs: DataFrame, artifacts: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents for which there is no artifact."""
    return docs.join(artifacts.select(key).distinct(), key, "left_anti")
