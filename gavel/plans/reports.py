"""Aggregates and rendered reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.operators import reports
from gavel.registry import query
from gavel.session import table

DAY = "CAST(o_orderdate AS DATE)"


@query(f"SELECT {DAY} AS day, count(*) AS n_documents, string_agg('o' || o_orderkey, ', ' ORDER BY o_orderkey) AS documents FROM orders GROUP BY 1")
def meetings_grouped(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    return reports.documents_by_meeting(rows, ["day"], ["o_orderkey"], F.concat(F.lit("o"), F.col("o_orderkey").cast("string")))


@query("SELECT coalesce(nullif(g, ''), 'Overig') AS folder, count(*) AS n, max(doc_id) AS newest FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN '' ELSE lang END AS g FROM documents) GROUP BY 1")
def group_default_key(spark, sf_dir):
    g = F.when(F.col("doc_id") % 5 == 0, F.lit(None)).when(F.col("doc_id") % 5 == 1, "").otherwise(F.col("lang"))
    return table(spark, sf_dir, "documents").groupBy(F.coalesce(F.nullif(g, F.lit("")), F.lit("Overig")).alias("folder")).agg(F.count("*").alias("n"), F.max("doc_id").alias("newest"))


@query("SELECT o_orderpriority, count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS new, count(*) FILTER (WHERE o_orderstatus = 'P') AS skipped, count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'P')) AS failed FROM orders GROUP BY 1")
def outcome_counts(spark, sf_dir):
    status = F.col("o_orderstatus")
    return reports.outcomes(table(spark, sf_dir, "orders"), ["o_orderpriority"], status.isin("F", "P"), status == "P")


@query("SELECT l_returnflag AS entity, count(*) AS meetings, CAST(sum(n) AS BIGINT) AS files, count(*) FILTER (WHERE n > 2) AS meetings_with, CAST(sum(returned) AS BIGINT) AS returned FROM (SELECT l_returnflag, l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_quantity > 25) AS returned FROM lineitem GROUP BY 1, 2) GROUP BY 1")
def nested_sizes(spark, sf_dir):
    """Sums over the files of meetings, and meetings with more than two files."""
    meetings = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_orderkey").agg(F.count("*").alias("files"), F.count_if(F.col("l_quantity") > 25).alias("returned"))
    return meetings.groupBy(F.col("l_returnflag").alias("entity")).agg(F.count("*").alias("meetings"), F.sum("files").alias("files"), F.count_if(F.col("files") > 2).alias("meetings_with"), F.sum("returned").alias("returned"))


@query("SELECT l_orderkey, bool_and(coalesce(l_quantity < 40, true)) AND count(*) FILTER (WHERE l_quantity IS NOT NULL) > 0 AS all_old, bool_or(l_returnflag = 'R') AS any_returned FROM lineitem GROUP BY 1")
def quantifiers(spark, sf_dir):
    """All dated links old, of which there must be one; any flag set."""
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
    return rows.agg((F.bool_and(F.coalesce(F.col("l_quantity") < 40, F.lit(True))) & (F.count("l_quantity") > 0)).alias("all_old"), F.bool_or(F.col("l_returnflag") == "R").alias("any_returned"))


@query("SELECT c_nationkey, count(*) AS tried, count(*) FILTER (WHERE c_acctbal > 0) AS downloaded, round(avg(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END), 6) AS coverage FROM customer GROUP BY 1")
def totals_over_entities(spark, sf_dir):
    good = F.col("c_acctbal") > 0
    return table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("tried"), F.count_if(good).alias("downloaded"), F.round(F.avg(good.cast("int")), 6).alias("coverage"))


@query("SELECT n_regionkey, string_agg(n_name, '; ' ORDER BY n_nationkey) AS problems FROM nation GROUP BY 1")
def problems_listagg(spark, sf_dir):
    names = F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name")))
    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_join(F.transform(names, lambda x: x["n_name"]), "; ").alias("problems"))


@query("SELECT p_partkey, '<a class=\"' || CASE WHEN p_partkey % 2 = 0 THEN 'local' ELSE 'external' END || '\" href=\"' || CASE WHEN p_partkey % 2 = 0 THEN 'files/' || p_partkey || '.pdf' ELSE 'https://x.be/?a=1&amp;b=' || p_partkey END || '\">' || p_name || ' &lt;x&gt;</a>' AS badge FROM part")
def html_badges(spark, sf_dir):
    k = F.col("p_partkey").cast("string")
    local = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("files/"), k, F.lit(".pdf")))
    return table(spark, sf_dir, "part").select("p_partkey", reports.badge(F.concat("p_name", F.lit(" <x>")), F.concat(F.lit("https://x.be/?a=1&b="), k), local).alias("badge"))


@query("SELECT n_regionkey, '<table><tr><th>n_nationkey</th><th>n_name</th></tr>' || string_agg('<tr><td>' || n_nationkey || '</td><td>' || n_name || '</td></tr>', '' ORDER BY n_nationkey) || '</table><p>' || count(*) || CASE WHEN count(*) = 1 THEN ' rij' ELSE ' rijen' END || '</p>' AS html FROM nation GROUP BY 1")
def html_tables(spark, sf_dir):
    return reports.table_report(table(spark, sf_dir, "nation"), ["n_regionkey"], ["n_nationkey", "n_name"], ["n_nationkey"])


@query("SELECT lang, string_agg(DISTINCT source, ', ' ORDER BY source) AS sources FROM documents GROUP BY 1")
def distinct_joined(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.array_join(F.sort_array(F.collect_set("source")), ", ").alias("sources"))


@query("SELECT c_nationkey, min_by(c_name, c_custkey) AS first_name FROM customer WHERE c_name <> '' GROUP BY 1")
def first_per_key(spark, sf_dir):
    return table(spark, sf_dir, "customer").filter("c_name <> ''").groupBy("c_nationkey").agg(F.min_by("c_name", "c_custkey").alias("first_name"))
