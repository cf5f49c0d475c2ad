"""Order-dependent queries on events, orders, lines and conversations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gavel.operators import ordered
from gavel.registry import query
from gavel.session import table


@query("SELECT event_id, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1")
def first_occurrence(spark, sf_dir):
    return ordered.first_occurrence(table(spark, sf_dir, "events"), ["event_type"], ["event_id"], ["user_id"]).select("event_id", "user_id", "event_type")


@query("SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1")
def first_text(spark, sf_dir):
    """The first document of each text; the shuffle carries digests, not texts."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", F.md5("text").alias("digest"))
    return ordered.first_occurrence(rows, ["digest"], ["doc_id"]).select("doc_id", "source")


@query("SELECT event_id, last_value(CASE WHEN event_type = 'error' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS carried FROM events")
def locf_heading(spark, sf_dir):
    rows = ordered.carried_forward(table(spark, sf_dir, "events"), F.when(F.col("event_type") == "error", F.col("value")), ["user_id"], ["event_id"], "carried")
    return rows.select("event_id", "carried")


@query("SELECT event_id, coalesce(last_value(CASE WHEN event_type = 'error' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING), value) AS used FROM events")
def locf_with_fallback(spark, sf_dir):
    """A document takes the date above it, and its own where there is none yet."""
    rows = ordered.carried_forward(table(spark, sf_dir, "events"), F.when(F.col("event_type") == "error", F.col("value")), ["user_id"], ["event_id"], "carried")
    return rows.select("event_id", F.coalesce("carried", "value").alias("used"))


@query("SELECT user_id, section, min(event_id) AS first_link FROM (SELECT *, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS section FROM events) WHERE event_type <> 'error' AND section > 0 GROUP BY 1, 2")
def scope_until_marker(spark, sf_dir):
    """The first link of each heading; links above the first heading belong to none."""
    rows = ordered.sections(table(spark, sf_dir, "events"), F.col("event_type") == "error", ["user_id"], ["event_id"])
    return rows.filter("event_type <> 'error' AND section > 0").groupBy("user_id", "section").agg(F.min("event_id").alias("first_link"))


@query("SELECT event_id FROM (SELECT event_id, max(CASE WHEN event_id % 7 <> 0 AND value < 3 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id DESC ROWS UNBOUNDED PRECEDING) AS old FROM events) WHERE old = 0")
def stop_at_first_old(spark, sf_dir):
    """Newest first, up to the first old element; elements without a date do not stop it."""
    rows = table(spark, sf_dir, "events").withColumn("newest", -F.col("event_id")).withColumn("age", F.when(F.col("event_id") % 7 != 0, F.col("value")))
    return ordered.until_first_old(rows, F.col("age") < 3, ["user_id"], ["newest"]).select("event_id")


@query("SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) <= 4")
def last_n_per_group(spark, sf_dir):
    return ordered.ends(table(spark, sf_dir, "events"), ordered.folders_to_read(36), ["user_id"], ["event_id"], last=True).select("user_id", "event_id")


@query("SELECT conv_id, turn, role FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) <= 2")
def first_n_per_group(spark, sf_dir):
    return ordered.ends(table(spark, sf_dir, "conversations"), 2, ["conv_id"], ["turn"]).select("conv_id", "turn", "role")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey) = 1 THEN l_returnflag || '.pdf' ELSE l_returnflag || '_' || substr(CAST(l_partkey AS VARCHAR), 1, 8) || '.pdf' END AS file FROM lineitem")
def name_collision_suffix(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("name", F.concat("l_returnflag", F.lit(".pdf")))
    return ordered.distinct_names(rows, "name", "l_partkey", ["l_orderkey"], ["l_linenumber", "l_partkey"], "file").select("l_orderkey", "l_linenumber", "file")


@query("SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS nr FROM customer WHERE c_acctbal < 0")
def row_numbering(spark, sf_dir):
    nr = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey"))
    return table(spark, sf_dir, "customer").filter("c_acctbal < 0").select("c_nationkey", "c_custkey", nr.alias("nr"))


@query("SELECT event_id, user_id FROM events WHERE value < 10 QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1")
def filter_before_dedup(spark, sf_dir):
    """What the filter drops does not hide later rows of its key."""
    rows = table(spark, sf_dir, "events").filter("value < 10")
    return ordered.first_occurrence(rows, ["event_type"], ["event_id"], ["user_id"]).select("event_id", "user_id")


@query("SELECT event_id, user_id FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1) WHERE value < 10")
def filter_after_dedup(spark, sf_dir):
    return ordered.first_occurrence(table(spark, sf_dir, "events"), ["event_type"], ["event_id"], ["user_id"]).filter("value < 10").select("event_id", "user_id")
