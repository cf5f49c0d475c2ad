"""JSON queries: payloads are built from tables and read back as the portals' are."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.operators import lookups
from gavel.registry import query
from gavel.session import table
from gavel.sources import payloads


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, coalesce(json_extract_string(props, '$.missing'), json_extract_string(props, '$.k'), '') AS first FROM events")
def json_props(spark, sf_dir):
    path = lambda p: F.get_json_object("props", p)
    return table(spark, sf_dir, "events").select("event_id", path("$.k").cast("long").alias("k"), F.coalesce(path("$.missing"), path("$.k"), F.lit("")).alias("first"))


@query("SELECT strftime(o_orderdate, '%Y%m') AS month, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderdate AS DATE) AS day, o_orderpriority AS organ FROM orders WHERE o_orderkey % 4 <> 1")
def json_meetings(spark, sf_dir):
    """A month's meetings as the calendar gives them; those not published go, unmarked ones stay."""
    meeting = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("dateTime"), F.struct(F.col("o_orderpriority").alias("id"), F.col("o_orderpriority").alias("name")).alias("organ"), F.when(F.col("o_orderkey") % 4 == 1, True).when(F.col("o_orderkey") % 4 == 2, False).alias("notPublished"))
    calls = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyyMM").alias("month")).agg(F.to_json(F.struct(F.collect_list(meeting).alias("meetings"))).alias("payload"))
    return payloads.meetings(calls).select("month", "id", "day", "organ")


@query("SELECT l_orderkey AS session, CAST(l_partkey AS BIGINT) AS file_id, CASE WHEN l_linenumber % 2 = 0 THEN 'PV ' || l_partkey ELSE 'f' || l_partkey END AS name, CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE l_returnflag = 'R'")
def json_session_files(spark, sf_dir):
    point = F.struct(F.col("l_partkey").alias("Id"), (F.col("l_returnflag") == "R").alias("isFile"), F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("PV "), F.col("l_partkey").cast("string"))).otherwise("").alias("Titre"), F.concat(F.lit("f"), F.col("l_partkey").cast("string"), F.lit(".pdf")).alias("FileName"), F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("SeanceDate"))
    calls = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("session")).agg(F.to_json(F.struct(F.struct(F.collect_list(point).alias("Points")).alias("Data"))).alias("payload"))
    return payloads.session_files(calls)


@query("SELECT p_partkey AS page, CAST(p_partkey AS VARCHAR) AS uid, CASE p_partkey % 3 WHEN 0 THEN p_name || '.pdf' WHEN 1 THEN p_partkey || '.pdf' ELSE p_name || '.PDF' END AS filename FROM part WHERE p_partkey % 4 <> 0 AND p_size % 2 = 0")
def json_blocks(spark, sf_dir):
    k = F.col("p_partkey").cast("string")
    item = F.struct(k.alias("uid"), F.when(F.col("p_size") % 2 == 0, "application/pdf").otherwise("image/png").alias("contentType"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).when(F.col("p_partkey") % 3 == 2, F.concat("p_name", F.lit(".PDF"))).alias("filename"))
    block = F.struct(F.when(F.col("p_partkey") % 4 == 0, "text").otherwise("lgc-file").alias("type"), F.array(item).alias("items"))
    calls = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page"), F.to_json(F.struct(F.array(block).alias("data"))).alias("payload"))
    return payloads.block_files(calls)


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN '1999-01-02' WHEN c_custkey % 3 = 1 THEN '1998-05-06' ELSE 'onbekend' END AS start, coalesce(r_name, 'stad') AS organ FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <> 7) ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def jsonapi_join(spark, sf_dir):
    """Meetings whose organ's parent is looked up among the included resources; a missing hop gives the entity."""
    reference = lambda kind, c: F.struct(F.struct(F.lit(kind).alias("type"), F.col(c).cast("string").alias("id")).alias("data"))
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    organs = nation.filter("n_nationkey <> 7").select(F.struct(F.lit("organ").alias("type"), F.col("n_nationkey").cast("string").alias("id"), F.create_map(F.lit("name"), "n_name").alias("attributes"), F.struct(reference("unit", "n_regionkey").alias("parent")).alias("relationships")).alias("r"))
    units = region.select(F.struct(F.lit("unit").alias("type"), F.col("r_regionkey").cast("string").alias("id"), F.create_map(F.lit("name"), "r_name").alias("attributes")).alias("r"))
    included = organs.select(F.to_json("r").alias("j")).unionAll(units.select(F.to_json("r").alias("j")))
    side = included.select(F.lit(0).alias("page"), F.concat(F.lit('{"included":['), "j", F.lit("]}")).alias("payload"))
    known = payloads.resources(side, "page")
    start = F.when(F.col("c_custkey") % 3 == 0, F.create_map(F.lit("started"), F.lit("1999-01-02T10:00:00Z"))).when(F.col("c_custkey") % 3 == 1, F.create_map(F.lit("planned"), F.lit("1998-05-06"))).otherwise(F.create_map(F.lit("x"), F.lit("")))
    item = F.struct(F.lit("meeting").alias("type"), F.col("c_custkey").cast("string").alias("id"), start.alias("attributes"), F.struct(reference("organ", "c_nationkey").alias("organ")).alias("relationships"))
    meetings = payloads.entries(table(spark, sf_dir, "customer").select(F.to_json(F.struct(F.array(item).alias("data"))).alias("payload")))
    name = lambda kind, c: F.concat(F.lit(kind), F.lit(":"), F.col(c))
    parents = known.select(F.concat_ws(":", "type", "id").alias("id"), F.concat_ws(":", "parent_type", "parent_id").alias("parent"), "name")
    out = lookups.nearest_ancestor(meetings.select(name("organ", "organ").alias("id"), F.col("id").alias("meeting"), "start"), parents, 1, F.lit("stad"))
    return out.select(F.col("meeting").cast("long").alias("id"), "start", F.col("ancestor").alias("organ"))


@query("SELECT o_orderkey, '/notulen-' || strftime(o_orderdate, '%d%m%Y') || '-0' AS loc, CAST(o_orderdate AS DATE) AS day FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1996-01-01'")
def sitemap_documents(spark, sf_dir):
    """Locations of a sitemap whose slugs hold dates; strict cutoff."""
    from gavel.functions import dates

    xml = F.concat(F.lit("<urlset><url><loc> /notulen-"), F.date_format("o_orderdate", "ddMMyyyy"), F.lit("-0 </loc></url><url><loc>/x</loc></url></urlset>"))
    found = table(spark, sf_dir, "orders").select("o_orderkey", F.explode(payloads.sitemap_locations(xml)).alias("loc"))
    found = found.withColumn("day", dates.parsed(F.regexp_replace("loc", "^/notulen-", ""), "slug"))
    return found.filter(dates.since(F.col("day"), F.lit("1996-01-01").cast("date"), False))


@query("SELECT n_nationkey, unnest([n_name, 'Vlag van ' || n_name]) AS name FROM nation")
def wiki_table_names(spark, sf_dir):
    text = F.concat(F.lit("{|\n| [[X (stad)|"), "n_name", F.lit("]]\n| [[Bestand:v.svg]]\n| [[Vlag van "), "n_name", F.lit("]]\n|}"))
    return table(spark, sf_dir, "nation").select("n_nationkey", F.explode(payloads.wiki_names(text)).alias("name"))


@query("SELECT p_partkey, 'f' || p_partkey || '.pdf' AS file, '/d?id=' || p_partkey AS url, CASE WHEN p_partkey % 2 = 0 THEN '20' || lpad(CAST(p_size AS VARCHAR), 2, '0') || '01' ELSE '202101' END AS first_month FROM part")
def script_extracts(spark, sf_dir):
    """Arguments of script calls and the value of a script variable."""
    k = F.col("p_partkey").cast("string")
    text = F.concat(F.lit("x(); download('a', 'b', 'f"), k, F.lit(".pdf', '/d?id="), k, F.lit("'); "), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("var minMonth = '20"), F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit("01'"))).otherwise(""))
    calls = table(spark, sf_dir, "part").select("p_partkey", F.explode(payloads.script_calls(text, "download")).alias("c"), payloads.script_variable(text, "minMonth", "202101").alias("first_month"))
    return calls.select("p_partkey", "c.file", "c.url", "first_month")
