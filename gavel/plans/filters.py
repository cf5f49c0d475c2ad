"""Filter queries: documents by term, organ matches, statuses, publication."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.functions import filters
from gavel.operators import lookups
from gavel.registry import query
from gavel.session import table


@query("SELECT page_id, contains(lower(t), 'the') OR contains(lower(url), 'the') AS hit FROM (SELECT page_id, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS t FROM pages)")
def doc_filter_single(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", filters.any_term([F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.col("url")], ["the"]).alias("hit"))


@query("SELECT doc_id, contains(lower(text), 'notulen') OR contains(lower(text), 'tion') OR contains(lower(text), 'eau') OR contains(lower(source), 'notulen') OR contains(lower(source), 'tion') OR contains(lower(source), 'eau') AS hit, true AS unfiltered FROM documents")
def doc_filter_terms(spark, sf_dir):
    text = [F.col("text"), F.col("source")]
    return table(spark, sf_dir, "documents").select("doc_id", filters.any_term(text, [" notulen", "tion ", "eau", ""]).alias("hit"), filters.any_term(text, []).alias("unfiltered"))


@query("SELECT p_partkey, (p_partkey % 5 < 4) AS hit, (p_partkey % 5 = 4) AS other FROM part")
def doc_filter_alias(spark, sf_dir):
    """A filter on minutes takes their other names too; any other filter is itself."""
    name = F.concat(F.element_at(F.lit([*filters.MINUTES["aliases"], "agenda"]), (F.col("p_partkey") % 5 + 1).cast("int")), F.lit(" "), F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", filters.any_term([name], filters.aliased("Notulen")).alias("hit"), filters.any_term([name], filters.aliased("agenda")).alias("other"))


@query("SELECT p_partkey, CASE WHEN contains(t, 'agenda') OR contains(t, 'projet') THEN false WHEN contains(t, 'proces') OR contains(t, 'synthese') THEN true ELSE regexp_matches(lower(f), '^pv[A-Za-z0-9_]') END AS hit FROM (SELECT p_partkey, f, lower(coalesce(nullif(title, ''), f)) AS t FROM (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'Agenda ' || p_name WHEN 1 THEN 'Proces-verbal' WHEN 2 THEN 'Note de synthese' WHEN 3 THEN '' ELSE p_name END AS title, CASE WHEN p_partkey % 2 = 0 THEN 'PVpublic' ELSE 'x' END || p_partkey || '.pdf' AS f FROM part))")
def doc_filter_include_exclude(spark, sf_dir):
    k = F.col("p_partkey")
    title = F.when(k % 6 == 0, F.concat(F.lit("Agenda "), "p_name")).when(k % 6 == 1, "Proces-verbal").when(k % 6 == 2, "Note de synthese").when(k % 6 == 3, "").otherwise(F.col("p_name"))
    file = F.concat(F.when(k % 2 == 0, "PVpublic").otherwise("x"), k.cast("string"), F.lit(".pdf"))
    return table(spark, sf_dir, "part").select("p_partkey", filters.include_exclude(title, file, ["agenda", "projet"], ["proces", "synthese"]).alias("hit"))


@query("SELECT c_custkey, CASE WHEN contains(lower(c_mktsegment), 'build') THEN true ELSE false END AS one_way, (contains(lower(c_mktsegment), 'building and more') OR contains('building and more', lower(c_mktsegment))) AS two_way, regexp_matches(c_name || ' x', '(?i)(^|[ ])x([ ]|$)') AS word, c_mktsegment = 'BUILDING' AS code, contains(lower(c_mktsegment), 'mach') AS translated FROM customer")
def organ_match(spark, sf_dir):
    """The five ways in which organs are matched."""
    s = F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        filters.organ_one_way(s, F.lit(" Build ")).alias("one_way"),
        filters.organ_two_way(s, F.lit("Building and more")).alias("two_way"),
        filters.organ_word(F.concat("c_name", F.lit(" x")), "x").alias("word"),
        filters.organ_code(s, "building").alias("code"),
        filters.organ_translated(s, "gemeenteraad", {"gemeenteraad": "mach"}).alias("translated"),
    )


@query("SELECT t.term, coalesce(min_by(n_name, n_nationkey) FILTER (WHERE n_name IS NOT NULL), t.term) AS resolved FROM (VALUES ('GER'), ('united'), ('atlantis'), ('a')) t(term) LEFT JOIN nation ON contains(lower(n_name), lower(t.term)) OR contains(lower(t.term), lower(n_name)) GROUP BY 1")
def organ_first_match(spark, sf_dir):
    """Each term's first organ by number; a term without one stands for itself."""
    terms = spark.createDataFrame([("GER",), ("united",), ("atlantis",), ("a",)], "term string")
    return lookups.first_match(terms, table(spark, sf_dir, "nation"), "term", "n_name", "n_nationkey").select("term", "resolved")


@query("SELECT doc_id, CASE WHEN contains(lower(text), 'tion') THEN 'projet' ELSE 'definitief' END AS status, (contains(lower(text), 'de la') OR contains(lower(text), 'of the')) AS relevant FROM documents")
def status_and_category(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", filters.status(F.col("text"), "tion").alias("status"), filters.any_term([F.col("text")], ["de la", "of the"]).alias("relevant"))


@query("SELECT event_id, NOT coalesce(hidden, false) AS published, starts_with(body, '%PDF') AS is_file FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS hidden, CASE WHEN event_id % 4 = 0 THEN '' WHEN event_id % 4 = 1 THEN '%PDF-1.7' ELSE '<html>' END AS body FROM events)")
def published_and_body(spark, sf_dir):
    k = F.col("event_id")
    hidden = F.when(k % 3 == 0, True).when(k % 3 == 1, False)
    body = F.when(k % 4 == 0, "").when(k % 4 == 1, "%PDF-1.7").otherwise("<html>")
    return table(spark, sf_dir, "events").select("event_id", filters.is_published(hidden).alias("published"), filters.body_ok(body).alias("is_file"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 36 ELSE 12 END AS months, CASE WHEN c_custkey % 3 = 0 THEN greatest(50, CASE WHEN c_custkey % 2 = 0 THEN 36 ELSE 12 END * 8) ELSE CAST(c_custkey % 3 * 7 AS INT) END AS items FROM customer")
def default_limits(spark, sf_dir):
    """Default look-back by organ, and the items read when no limit is given."""
    organ = F.when(F.col("c_custkey") % 2 == 0, "Gemeenteraad Gent").otherwise("Vast Bureau")
    months = filters.default_months(organ)
    given = F.when(F.col("c_custkey") % 3 == 0, 100).otherwise((F.col("c_custkey") % 3 * 7).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", months.alias("months"), filters.item_budget(given, months).alias("items"))


@query("SELECT n_nationkey, n_name FROM nation WHERE contains(lower(n_name), 'ion_1') ORDER BY n_nationkey LIMIT 1")
def entity_by_name(spark, sf_dir):
    """The first entity that a name fits, in catalogue order."""
    return table(spark, sf_dir, "nation").filter(filters.has(F.col("n_name"), "ion_1")).orderBy("n_nationkey").limit(1).select("n_nationkey", "n_name")
