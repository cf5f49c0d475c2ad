"""The harvest: one pipeline for all source types, driven by a row of settings each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavel.functions import dates, urls
from gavel.operators import reports, sinks
from gavel.plans import links
from gavel.registry import query
from gavel.session import scratch, table
from gavel.sources import adapters
from gavel.streaming import watch


LINK = f"{links.BASE} || '/' || regexp_replace(href, '^/+', '') || '-' || strftime(DATE '2024-12-31' - INTERVAL (CAST(pos * 40 + page_id % 30 AS INT)) DAY, '%Y%m%d') || '.pdf'"


def _dated_links(spark, sf_dir) -> DataFrame:
    """The pages' links as documents whose names hold dates that go back with their place on the page."""
    rows = links._links(spark, sf_dir).withColumn("entity", urls.host(F.col("url")))
    day = F.date_sub(F.lit("2024-12-31").cast("date"), (F.col("pos") * 40 + F.col("page_id") % 30).cast("int"))
    return rows.select("entity", "page_id", "pos", "label", F.concat("link", F.lit("-"), F.date_format(day, "yyyyMMdd"), F.lit(".pdf")).alias("link"))


DOCS = f"(SELECT lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)', 2)) AS entity, page_id, pos, label, {LINK} AS link, CAST(DATE '2024-12-31' - INTERVAL (CAST(pos * 40 + page_id % 30 AS INT)) DAY AS DATE) AS day FROM {links.ANCHORS})"


@query(f"SELECT entity, page_id, pos, link, day, strftime(day, '%Y-%m-%d') || '_' || list_extract(string_split(link, '/'), -1) AS raw, CASE WHEN contains(lower(label), 'agenda') THEN 'agenda' ELSE 'overig' END AS doc_type FROM {DOCS} WHERE day >= DATE '2024-12-31' - 31 * 3 AND (contains(lower(label), 'th') OR contains(lower(link), 'th')) QUALIFY row_number() OVER (PARTITION BY entity, link ORDER BY page_id, pos) = 1")
def harvest_documents(spark, sf_dir):
    """From pages to the documents to download, with the settings of one source type."""
    one = {"one": adapters.Source(("cms_path",), months=3, scope=("entity",))}
    out = adapters.select_documents(_dated_links(spark, sf_dir).withColumn("type", F.lit("one")), F.lit("2024-12-31").cast("date"), ["th"], sources=one)
    return out.select("entity", "page_id", F.col("pos").cast("long").alias("pos"), "link", "day", F.concat_ws("_", F.date_format("day", "yyyy-MM-dd"), urls.last_segment(F.col("link"))).alias("raw"), "doc_type")


@query(f"SELECT entity, count(*) AS total, count(*) FILTER (WHERE NOT skipped AND ok) AS new, count(*) FILTER (WHERE skipped) AS skipped, count(*) FILTER (WHERE NOT skipped AND NOT ok) AS failed FROM (SELECT *, page_id % 4 = 0 AS skipped, page_id % 4 IN (2, 3) AS ok FROM {DOCS}) GROUP BY 1")
def harvest_outcomes(spark, sf_dir):
    """New, skipped and failed documents of each entity against a manifest of what is there."""
    rows = _dated_links(spark, sf_dir).withColumn("hint", F.concat(F.lit("d"), F.col("page_id").cast("string"), F.lit("-"), F.col("pos").cast("string"), F.lit(".pdf")))
    rows = rows.withColumns({"url": F.col("link"), "disposition": F.lit(None).cast("string"), "content_type": F.lit("application/pdf"), "status": F.lit(200), "body": F.when(F.col("page_id") % 4 == 1, "<html>").otherwise("%PDF-1.4")})
    manifest = rows.filter("page_id % 4 = 0").select(F.col("hint").alias("file"))
    out = sinks.stored(rows, manifest)
    return reports.outcomes(out, ["entity"], F.col("success"), F.col("skipped"))


# what SQL knows of the types, by hand: where the date stands and how exact it is, limit, undated ones, end at the first old one, scope, filter, sink
_TYPES = """(VALUES
('meetingburger', 'label', 'day', DATE '2024-01-06', true, true, 'entity', true, false, false, 1, true, ''),
('lblod', 'label', 'day', DATE '2023-12-25', true, false, 'none', true, true, false, 100, false, '.pdf'),
('imio', 'label', 'day', DATE '2023-12-25', true, false, 'entity', true, true, true, 1, true, ''),
('wordpress', 'label', 'day', DATE '2023-12-25', true, false, 'page', true, true, true, 1, true, ''),
('drupal', 'link', 'month', DATE '2023-12-25', true, false, 'page', true, true, true, 1, true, ''),
('icordis', 'link', 'day', DATE '2023-12-25', true, false, 'page', false, true, true, 1, true, ''),
('linkebeek', 'link', 'day', DATE '2023-12-25', true, false, 'entity', true, false, true, 1, true, ''),
('docodis', 'label', 'day', DATE '2023-12-25', true, false, 'page', true, false, true, 1, true, ''),
('pubcon', 'label', 'day', DATE '2023-12-25', true, false, 'entity', true, true, true, 1, true, ''),
('irisnet', 'label', 'day', DATE '2024-01-06', false, false, 'page', true, false, false, 1, true, ''),
('idelibe', 'label', 'day', DATE '2024-01-06', true, false, 'page', true, true, false, 1, true, ''),
('ibabs', 'label', 'day', DATE '2024-10-01', false, false, 'entity', true, true, true, 1, true, ''),
('gelinktnotuleren', 'label', 'day', DATE '2023-12-25', true, false, 'page', true, true, true, 1, true, ''),
('provantwerpen', 'link', 'day', DATE '2024-06-30', false, false, 'page', true, true, true, 1, true, ''),
('vlaamsbrabant', 'label', 'day', DATE '2024-09-01', false, false, 'page', true, true, true, 1, true, ''),
('hainaut', 'label', 'day', DATE '2024-06-30', false, false, 'page', true, true, true, 1, true, ''),
('brussel', 'label', 'day', DATE '2023-12-25', false, false, 'page', true, true, true, 1, true, ''),
('molenbeek', 'label', 'day', DATE '2023-12-25', false, false, 'page', true, true, true, 1, true, ''),
('schaerbeek', 'label', 'day', DATE '2023-12-25', false, false, 'page', true, true, true, 1, true, ''),
('ixelles', 'label', 'day', DATE '2023-12-25', true, false, 'page', true, true, true, 1, true, ''),
('forest', 'link', 'day', DATE '2023-12-25', true, false, 'page', true, true, true, 1, true, '')
) t(type, stands, exact, first, undated, stops, scope, on_label, on_link, magic, least, there_ok, forced)"""
_PLACED = f"(SELECT * EXCLUDE (day), CASE WHEN pos % 7 = 3 THEN NULL WHEN exact = 'month' THEN CAST(date_trunc('month', day) AS DATE) ELSE day END AS day, day AS stood FROM (SELECT d.*, {links.ABSOLUTE} AS plain, t.* FROM (SELECT *, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)', 2)) AS entity, CAST(DATE '2024-12-31' - INTERVAL (CAST(pos * 40 + page_id % 30 AS INT)) DAY AS DATE) AS day FROM {links.ANCHORS}) d JOIN {_TYPES} ON type = (SELECT list(type ORDER BY type) FROM {_TYPES})[page_id % 21 + 1]))"
_CHOSEN = f"""SELECT type, entity, page_id, pos, plain, day FROM (
SELECT *, bool_or(stops AND coalesce(day < first, false)) OVER (PARTITION BY type, entity ORDER BY page_id, pos) AS ended FROM {_PLACED})
WHERE NOT ended AND coalesce(day >= first, undated) AND ((on_label AND contains(lower(label), 'th')) OR (on_link AND contains(lower(plain), 'th')))
QUALIFY row_number() OVER (PARTITION BY type, CASE scope WHEN 'none' THEN page_id || '/' || pos WHEN 'page' THEN CAST(page_id AS VARCHAR) ELSE entity END, plain, CASE WHEN stands = 'link' AND pos % 7 <> 3 THEN stood END ORDER BY page_id, pos) = 1"""


def _all_types(spark, sf_dir) -> DataFrame:
    """The pages' links, dealt to all types by page; each has its date where its type looks for it, every seventh none."""
    rows = links._links(spark, sf_dir).withColumn("entity", urls.host(F.col("url")))
    kind = F.element_at(F.lit(sorted([*adapters.SOURCES, "forest"])), (F.col("page_id") % 21 + 1).cast("int"))
    day = F.date_sub(F.lit("2024-12-31").cast("date"), (F.col("pos") * 40 + F.col("page_id") % 30).cast("int"))
    of = lambda pattern: F.date_format(day, pattern)
    month = lambda table: dates.month_name(F.month(day), table)
    spoken = lambda table: F.concat(of("d "), month(table), of(" yyyy"))
    said = F.when(kind.isin("meetingburger", "lblod", "ibabs"), spoken(dates.DUTCH)).when(kind == "imio", spoken(dates.FRENCH)).when(kind == "hainaut", F.concat(F.lit("du "), spoken(dates.FRENCH)))
    said = said.when(kind.isin("docodis", "idelibe", "gelinktnotuleren", "vlaamsbrabant"), of("yyyy-MM-dd")).when(kind.isin("pubcon", "brussel", "molenbeek", "wordpress"), of("dd/MM/yyyy")).when(kind == "ixelles", of("'Séance du 'dd/MM/yyyy")).when(kind == "schaerbeek", of("ddMMyyyy-"))
    dated = F.col("pos") % 7 != 3
    at_start = F.concat_ws(" ", F.when(dated, said), "label")
    label = F.when(kind == "irisnet", F.concat_ws(" ", "label", F.when(dated, of("yyyy-MM-dd")))).when(said.isNotNull(), at_start).otherwise(F.col("label"))
    link = F.when(~dated, F.col("link")).when(kind == "drupal", F.concat("link", of("'/'yyyy-MM'/x.pdf'"))).when(kind == "icordis", F.concat("link", of("'-'yyyyMMdd'.pdf'"))).when(kind == "linkebeek", F.concat("link", of("'-'d-"), month(dates.DUTCH), of("-yyyy"))).when(kind == "provantwerpen", F.concat("link", of("'/'yyyy-MM-dd'/x.pdf'"))).when(kind == "forest", F.concat("link", of("'-'yyyyMMdd'.pdf'"))).otherwise(F.col("link"))
    return rows.select(kind.alias("type"), "entity", "page_id", "pos", label.alias("label"), link.alias("link"), F.col("link").alias("plain"))


@query(_CHOSEN)
def harvest_all_types(spark, sf_dir):
    """What every source type would download, by its own settings, in one plan."""
    out = adapters.select_documents(_all_types(spark, sf_dir), F.lit("2024-12-31").cast("date"), ["th"])
    return out.select("type", "entity", "page_id", F.col("pos").cast("long").alias("pos"), "plain", "day")


@query(
    f"""SELECT type, count(DISTINCT entity) AS entities, count(DISTINCT CASE WHEN failed THEN entity END) AS with_failures, count(*) AS total, count(*) FILTER (WHERE NOT there AND NOT failed AND ok) AS new, count(*) FILTER (WHERE there) AS skipped, count(*) FILTER (WHERE failed) AS failed
FROM (SELECT type, entity, page_id % 4 = 0 AS there, ok, NOT (page_id % 4 = 0) AND NOT ok AS failed FROM (SELECT type, entity, page_id, CASE page_id % 4 WHEN 1 THEN NOT magic AND least <= 6 WHEN 2 THEN least <= 120 WHEN 3 THEN least <= 8 ELSE true END AS ok FROM {_PLACED})) GROUP BY type"""
)
def harvest_all_tally(spark, sf_dir):
    """New, skipped and failed documents of each type, every type by its own sink policy."""
    rows = _all_types(spark, sf_dir).withColumn("hint", F.concat(F.lit("d"), F.col("page_id").cast("string"), F.lit("-"), F.col("pos").cast("string"), F.lit(".pdf")))
    body = F.when(F.col("page_id") % 4 == 1, "<html>").when(F.col("page_id") % 4 == 2, F.rpad(F.lit("%PDF-1.4"), 120, "x")).otherwise("%PDF-1.4")
    rows = rows.withColumns({"url": F.col("plain"), "disposition": F.lit(None).cast("string"), "content_type": F.lit("application/pdf"), "status": F.lit(200), "body": body})
    there = rows.filter("page_id % 4 = 0").select(F.col("hint").alias("file"))
    return adapters.outcomes(sinks.stored(rows, there, adapters.policies(F.col("type"))))


@query(
    """SELECT page_id, type FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'hainaut' WHEN 1 THEN 'molenbeek' ELSE 'docodis' END AS type FROM pages)"""
)
def harvest_listings(spark, sf_dir):
    """Pages of types whose listings differ: below headings, in rows that begin with a date, and plain links."""
    day = F.date_sub(F.lit("2024-12-31").cast("date"), (F.col("page_id") % 300).cast("int"))
    kind = F.when(F.col("page_id") % 3 == 0, "hainaut").when(F.col("page_id") % 3 == 1, "molenbeek").otherwise("docodis")
    text = F.when(kind == "hainaut", F.concat(F.lit("<h3>Conseil du "), F.date_format(day, "d "), adapters.french_month(day), F.date_format(day, " yyyy"), F.lit('</h3><a href="/x">page</a><a href="/a.pdf">a</a><a href="/b.pdf">b</a>')))
    text = text.when(kind == "molenbeek", F.concat(F.lit("<table><tr><td>"), F.date_format(day, "dd/MM/yyyy"), F.lit('</td><td><a href="/a.pdf">pdf</a></td></tr><tr><td>x</td><td><a href="/b.pdf">b</a></td></tr></table>')))
    text = text.otherwise(F.concat(F.lit('<a href="/a.pdf">Zitting '), F.date_format(day, "yyyy-MM-dd"), F.lit("</a>")))
    pages = table(spark, sf_dir, "pages").select(kind.alias("type"), urls.host(F.col("url")).alias("entity"), "page_id", "url", text.alias("html"))
    chosen = adapters.select_documents(adapters.listings(pages), F.lit("2024-12-31").cast("date"), months=100)
    return chosen.filter((F.col("day") == F.date_sub(F.lit("2024-12-31").cast("date"), (F.col("page_id") % 300).cast("int"))) & F.col("link").endswith("/a.pdf")).select("page_id", "type")


@query("SELECT doc_id, source FROM documents WHERE doc_id % 3 <> 0 AND md5(coalesce(text, '')) NOT IN (SELECT md5(coalesce(text, '')) FROM documents WHERE doc_id % 3 = 0)")
def incremental_new_only(spark, sf_dir):
    """Second slice of the documents without the texts that the first one brought; texts meet as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.md5(F.coalesce("text", F.lit(""))).alias("digest"))
    return docs.filter("doc_id % 3 <> 0").join(docs.filter("doc_id % 3 = 0").select("digest").distinct(), "digest", "left_anti").select("doc_id", "source")


_FILES = "SELECT doc_id, source || '/' || doc_id AS stem, doc_id % 5 AS kind, strlen(coalesce(text, '')) AS n FROM documents WHERE source IS NOT NULL"


@query(f"SELECT CASE kind WHEN 2 THEN stem || '.html' ELSE stem || '.pdf' END AS file, CASE kind WHEN 0 THEN n + 9 WHEN 2 THEN n WHEN 3 THEN 14 ELSE n END AS bytes FROM ({_FILES}) WHERE kind IN (0, 2, 3) OR (kind = 4 AND n >= 100)")
def files_written(spark, sf_dir):
    """Documents as files on disk, in a folder a source: PDF by its first bytes, pages that payloads hold, an older sink's
    least size; a second run leaves alone what the first has written."""
    path, kind, missing = scratch(spark, "files"), F.col("doc_id") % 5, F.lit(None).cast("string")
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").filter("source is not null").select("doc_id", "source", kind.alias("kind"), F.concat(F.col("doc_id").cast("string"), F.lit(".pdf")).alias("hint"), F.lit("https://x.be/d").alias("url"), missing.alias("disposition"), F.lit("application/pdf").alias("content_type"), F.lit(200).alias("status"), F.when(kind == 0, F.concat(F.lit("%PDF-1.4 "), text)).otherwise(text).alias("body"))

    def store(some: DataFrame, policy: sinks.Policy = sinks.Policy()) -> None:  # noqa: B008  it is frozen
        sinks.write_files(sinks.stored(some, sinks.files_below(spark, path), policy, "source"), path, "source")

    store(rows.filter("kind = 3").withColumn("body", F.lit("%PDF-1.4 first")))
    store(rows.filter("kind in (0, 1, 3)").withColumn("body", F.when(F.col("kind") == 1, F.concat(F.lit("<html>"), "body")).when(F.col("kind") == 3, F.lit("%PDF-1.4 second one")).otherwise(F.col("body"))))
    store(sinks.inline_documents(rows.filter("kind = 2").withColumns({"name": F.col("doc_id").cast("string"), "content": F.col("body")}), "name", "content"), sinks.INLINE)
    store(rows.filter("kind = 4"), sinks.LEGACY_PDF)
    return sinks.files_below(spark, path)


@query(f"SELECT count(*) AS total, count(*) FILTER (WHERE NOT skipped AND ok) AS new, count(*) FILTER (WHERE skipped) AS skipped, count(*) FILTER (WHERE NOT skipped AND NOT ok) AS failed, true AS same FROM (SELECT *, page_id % 4 = 0 AS skipped, page_id % 4 IN (2, 3) AS ok FROM {DOCS})")
def harvest_watched(spark, sf_dir):
    """Counts that a listener hears while pages are harvested as a stream, one file a batch, against those of the batch job."""
    folder, out, checkpoint = scratch(spark, "watched-in"), scratch(spark, "watched"), scratch(spark, "watched-checkpoint")
    rows = _dated_links(spark, sf_dir).select("page_id", F.col("link").alias("url"), F.concat(F.lit("d"), F.col("page_id").cast("string"), F.lit("-"), F.col("pos").cast("string"), F.lit(".pdf")).alias("hint"))
    rows.repartition(3, "page_id").write.parquet(folder)
    there = rows.filter("page_id % 4 = 0").select(F.col("hint").alias("file"))

    def judged(found: DataFrame) -> DataFrame:
        missing, body = F.lit(None).cast("string"), F.when(F.col("page_id") % 4 == 1, "<html>").otherwise("%PDF-1.4")
        return sinks.stored(found.withColumns({"disposition": missing, "content_type": F.lit("application/pdf"), "status": F.lit(200), "body": body}), there).select("file", "success", "skipped", "error")

    def run() -> None:
        stream = spark.readStream.schema("page_id long, url string, hint string").option("maxFilesPerTrigger", 1).parquet(folder)
        watch.watched(judged(stream)).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

    heard = watch.listening(spark, run)
    written = spark.read.schema("success boolean, skipped boolean").parquet(out)
    told = F.struct(*(F.lit(heard[c]).alias(c) for c in watch.COUNTS))
    sums = reports.outcomes(written, [], F.col("success"), F.col("skipped"))
    return sums.select(*(F.col(c).cast("long").alias(c) for c in watch.COUNTS), (F.struct(*(F.col(c).cast("int").alias(c) for c in watch.COUNTS)) == told).alias("same"))


@query("SELECT n_regionkey, '{\"n\":' || count(*) || ',\"items\":[' || string_agg('{\"n_nationkey\":' || n_nationkey || ',\"n_name\":\"' || n_name || '\"}', ',' ORDER BY n_nationkey) || ']}' AS document FROM nation GROUP BY 1")
def json_by_entity(spark, sf_dir):
    return sinks.json_documents(table(spark, sf_dir, "nation").select("n_regionkey", "n_nationkey", "n_name"), ["n_regionkey"])
