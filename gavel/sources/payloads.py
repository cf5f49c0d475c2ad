"""JSON payloads of the portals, with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CALENDAR = "meetings ARRAY<STRUCT<id STRING, dateTime STRING, organ STRUCT<id STRING, name STRING>, notPublished BOOLEAN>>"
POINTS = "Data STRUCT<Points ARRAY<STRUCT<Id BIGINT, isFile BOOLEAN, Titre STRING, FileName STRING, SeanceDate STRING>>>"
BLOCKS = "data ARRAY<STRUCT<type STRING, items ARRAY<STRUCT<uid STRING, contentType STRING, filename STRING>>>>"
_REFERENCE = "STRUCT<data STRUCT<type STRING, id STRING>>"
RESOURCES = f"data ARRAY<STRUCT<type STRING, id STRING, attributes MAP<STRING, STRING>, relationships STRUCT<organ {_REFERENCE}, minutes {_REFERENCE}>>>, included ARRAY<STRUCT<type STRING, id STRING, attributes MAP<STRING, STRING>, relationships STRUCT<parent {_REFERENCE}>>>, links STRUCT<next STRING>"


def meetings(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Published meetings of calendar payloads: id, day, organ_id, organ. A broken payload gives none."""
    m = payloads.select(*(c for c in payloads.columns if c != column), F.explode(F.from_json(column, CALENDAR)["meetings"]).alias("m"))
    kept = m.filter(~F.coalesce("m.notPublished", F.lit(False)))
    return kept.select(*(c for c in kept.columns if c != "m"), F.col("m.id").alias("id"), F.try_to_date(F.substr("m.dateTime", F.lit(1), F.lit(10)), "yyyy-MM-dd").alias("day"), F.col("m.organ.id").alias("organ_id"), F.col("m.organ.name").alias("organ"))


def session_files(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Files among the points of sessions: file_id, name (title, else file stem), day."""
    p = payloads.select(*(c for c in payloads.columns if c != column), F.explode(F.from_json(column, POINTS)["Data"]["Points"]).alias("p")).filter("p.isFile")
    name = F.coalesce(F.nullif("p.Titre", F.lit("")), F.regexp_replace("p.FileName", r"\.[A-Za-z0-9]+$", ""))
    return p.select(*(c for c in p.columns if c != "p"), F.col("p.Id").alias("file_id"), name.alias("name"), F.try_to_date(F.substr("p.SeanceDate", F.lit(1), F.lit(10)), "yyyy-MM-dd").alias("day"))


def block_files(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """PDF items of content blocks: uid, filename (uid.pdf by default, extension forced)."""
    b = payloads.select(*(c for c in payloads.columns if c != column), F.explode(F.from_json(column, BLOCKS)["data"]).alias("b")).filter("b.type = 'lgc-file'")
    i = b.select(*(c for c in b.columns if c != "b"), F.explode("b.items").alias("i")).filter("i.uid is not null and contains(i.contentType, 'pdf')")
    name = F.coalesce("i.filename", F.concat("i.uid", F.lit(".pdf")))
    return i.select(*(c for c in i.columns if c != "i"), F.col("i.uid").alias("uid"), F.when(F.lower(name).endswith(".pdf"), name).otherwise(F.concat(name, F.lit(".pdf"))).alias("filename"))


def resources(payloads: DataFrame, page: str, column: str = "payload") -> DataFrame:
    """Included resources of paged payloads: type, id, name, parent_type, parent_id; of repeated ones the last page's."""
    r = payloads.select(page, F.explode(F.from_json(column, RESOURCES)["included"]).alias("r"))
    latest = r.groupBy("r.type", "r.id").agg(F.max_by("r", page).alias("r"))
    return latest.select("type", "id", F.col("r.attributes")["name"].alias("name"), F.col("r.relationships.parent.data.type").alias("parent_type"), F.col("r.relationships.parent.data.id").alias("parent_id"))


def entries(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Primary resources of paged payloads: id, start (actual, else planned, else onbekend), organ, minutes."""
    d = payloads.select(*(c for c in payloads.columns if c != column), F.explode(F.from_json(column, RESOURCES)["data"]).alias("d"))
    attribute = lambda k: F.nullif(F.try_element_at("d.attributes", F.lit(k)), F.lit(""))
    start = F.coalesce(F.substr(F.coalesce(attribute("started"), attribute("planned")), F.lit(1), F.lit(10)), F.lit("onbekend"))
    return d.select(*(c for c in d.columns if c != "d"), F.col("d.id").alias("id"), start.alias("start"), F.col("d.relationships.organ.data.id").alias("organ"), F.col("d.relationships.minutes.data.id").alias("minutes"))


def sitemap_locations(xml: Column) -> Column:
    """Array of the locations in a sitemap."""
    return F.regexp_extract_all(xml, F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1))


def wiki_names(text: Column) -> Column:
    """Array of names linked in the rows of a wiki table: the display name, else the target; flags are left out."""
    link = r"\|\s*\[\[([^\]|#]+)(?:\|([^\]]*))?\]\]"
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(link), F.lit(1)).alias("target"), F.regexp_extract_all(text, F.lit(link), F.lit(2)).alias("shown"))
    names = F.transform(pairs, lambda p: F.trim(F.coalesce(F.nullif(p["shown"], F.lit("")), p["target"])))
    return F.filter(names, lambda n: ~n.rlike("(?i)^(bestand|file|vlag):"))


def script_calls(text: Column, function: str) -> Column:
    """Array of (file, url): third and fourth argument of each call of a function in script text."""
    call = rf"{function}\(\s*'[^']*'\s*,\s*'[^']*'\s*,\s*'([^']*)'\s*,\s*'([^']*)'\s*\)"
    return F.arrays_zip(F.regexp_extract_all(text, F.lit(call), F.lit(1)).alias("file"), F.regexp_extract_all(text, F.lit(call), F.lit(2)).alias("url"))


def script_variable(text: Column, name: str, default: str) -> Column:
    """Six digits assigned to a script variable, else the default."""
    return F.coalesce(F.nullif(F.regexp_extract(text, rf"{name}\s*=\s*[\"']?(\d{{6}})", 1), F.lit("")), F.lit(default))
