"""Lookup queries: defaults, ancestors, priorities, membership, set comparison, trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.operators import lookups
from gavel.registry import query
from gavel.session import spread, table


@query("SELECT c_custkey, coalesce(n_name, 'onbekend') AS n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON c_nationkey = n_nationkey")
def left_default_join(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").filter("n_nationkey < 20").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return lookups.with_default(table(spark, sf_dir, "customer"), nations, "c_nationkey", {"n_name": F.lit("onbekend")}).select("c_custkey", "n_name")


@query("SELECT s_suppkey, coalesce(CAST(s_nationkey % 4 + 1 AS VARCHAR) || ': ' || CASE s_nationkey % 4 + 1 WHEN 1 THEN 'Agenda' WHEN 2 THEN 'Notulen' WHEN 3 THEN 'Besluit' END, CAST(s_nationkey % 4 + 1 AS VARCHAR)) AS label FROM supplier")
def code_labels(spark, sf_dir):
    """A code's label, and the code itself where there is none."""
    code = (F.col("s_nationkey") % 4 + 1).cast("string")
    labels = F.create_map(*map(F.lit, ("1", "Agenda", "2", "Notulen", "3", "Besluit")))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.coalesce(F.concat(code, F.lit(": "), F.try_element_at(labels, code)), code).alias("label"))


@query("SELECT c_custkey AS id, coalesce(r_name, c_name) AS ancestor FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 5 <> 0) ON c_nationkey = n_nationkey LEFT JOIN (SELECT * FROM region WHERE r_regionkey <> 2) ON n_regionkey = r_regionkey")
def two_hop_parent(spark, sf_dir):
    """Customer to nation to region; a missing hop gives the customer's own name."""
    key = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
    nation, region, customer = (table(spark, sf_dir, t) for t in ("nation", "region", "customer"))
    parents = nation.filter("n_nationkey % 5 <> 0").select(key("n", "n_nationkey").alias("id"), key("r", "n_regionkey").alias("parent"), F.col("n_name").alias("name"))
    parents = parents.unionAll(region.filter("r_regionkey <> 2").select(key("r", "r_regionkey"), F.lit(None).cast("string"), "r_name"))
    rows = customer.select(key("n", "c_nationkey").alias("id"), "c_custkey", "c_name")
    out = lookups.nearest_ancestor(rows, parents, 1, F.col("c_name"))
    return out.select(F.col("c_custkey").alias("id"), "ancestor")


@query("SELECT c_custkey, coalesce(CASE WHEN c_custkey % 2 = 0 THEN 'own' || c_custkey END, k) AS key FROM customer LEFT JOIN (SELECT lower(n_name) AS n, min(n_nationkey || '!') AS k FROM nation GROUP BY 1) ON lower(n) = CASE c_custkey % 3 WHEN 0 THEN 'nation_6' WHEN 1 THEN 'nation_7' ELSE 'nowhere' END")
def fill_missing_key(spark, sf_dir):
    """Keys that rows lack come from the platform's list, by name in either case."""
    platform = table(spark, sf_dir, "nation").groupBy(F.lower("n_name").alias("__n")).agg(F.min(F.concat(F.col("n_nationkey").cast("string"), F.lit("!"))).alias("__k"))
    rows = table(spark, sf_dir, "customer").withColumn("name", F.when(F.col("c_custkey") % 3 == 0, "Nation_6").when(F.col("c_custkey") % 3 == 1, "Nation_7").otherwise("Nowhere"))
    own = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("own"), F.col("c_custkey").cast("string")))
    return rows.join(platform, F.lower("name") == F.col("__n"), "left").select("c_custkey", F.coalesce(own, "__k").alias("key"))


MAPPINGS = [(1, "NATION_1", "Frankrijk"), (2, "NATION_1", "Gallia"), (2, "NATION_4", "Duitsland"), (3, "NATION_7", "Kina"), (4, "NATION_2", "Nippon")]
MAPPING_SQL = "(VALUES " + ", ".join(f"({p}, '{a}', '{b}')" for p, a, b in MAPPINGS) + ") m(priority, from_name, to_name)"


@query(f"SELECT n_nationkey, coalesce(t, n_name) AS name FROM nation LEFT JOIN (SELECT from_name, min_by(to_name, priority) AS t FROM {MAPPING_SQL} GROUP BY 1) ON n_name = from_name")
def priority_mapping(spark, sf_dir):
    mappings = spark.createDataFrame(MAPPINGS, "priority int, from_name string, to_name string")
    return lookups.mapped(table(spark, sf_dir, "nation"), "n_name", mappings, "name").select("n_nationkey", "name")


@query(f"WITH named AS (SELECT coalesce(t, n_name) AS name FROM nation LEFT JOIN (SELECT from_name, min_by(to_name, priority) AS t FROM {MAPPING_SQL} GROUP BY 1) ON n_name = from_name), wiki AS (SELECT n_name AS name FROM nation WHERE n_nationkey > 3 UNION SELECT 'Nippon') SELECT name, 'missing' AS side FROM (SELECT name FROM named EXCEPT SELECT name FROM wiki) UNION ALL SELECT name, 'extra' FROM (SELECT name FROM wiki EXCEPT SELECT name FROM named)")
def reconcile_names(spark, sf_dir):
    """Names of one list, mapped, against those of another: what either lacks."""
    mappings = spark.createDataFrame(MAPPINGS, "priority int, from_name string, to_name string")
    nation = table(spark, sf_dir, "nation")
    named = lookups.mapped(nation, "n_name", mappings, "name")
    wiki = nation.filter("n_nationkey > 3").select(F.col("n_name").alias("name")).unionAll(spark.range(1).select(F.lit("Nippon").alias("name")))
    return lookups.differences(named, wiki, "name")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 25)")
def anti_seen(spark, sf_dir):
    seen = table(spark, sf_dir, "part").filter("p_size < 25").select(F.col("p_partkey").alias("l_partkey"))
    return lookups.unseen(table(spark, sf_dir, "lineitem"), seen, "l_partkey").select("l_orderkey", "l_linenumber")


@query("SELECT o_orderkey, 1 AS level, 'order' AS name FROM orders UNION ALL SELECT o_orderkey, 2, 'line ' || l_linenumber FROM orders JOIN lineitem ON o_orderkey = l_orderkey UNION ALL SELECT o_orderkey, 3, p_name FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey")
def tree_expand(spark, sf_dir):
    """Meetings, their items and the items' documents as levels of one table."""
    orders, items, part = table(spark, sf_dir, "orders").select("o_orderkey"), table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber"), table(spark, sf_dir, "part").select("p_partkey", "p_name")
    n = items.count()
    lines = spread(orders, n, "o_orderkey").join(spread(items, n, "l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    parts = spread(lines, n, "l_partkey").join(spread(part, n, "p_partkey"), F.col("l_partkey") == F.col("p_partkey"))
    level = lambda df, n, name: df.select("o_orderkey", F.lit(n).alias("level"), name.alias("name"))
    return lookups.levels(level(orders, 1, F.lit("order")), level(lines, 2, F.concat(F.lit("line "), F.col("l_linenumber").cast("string"))), level(parts, 3, F.col("p_name")))


@query("SELECT c_nationkey AS nation, 'missing' AS side FROM (SELECT c_nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_nationkey % 2 = 0) UNION ALL SELECT s_nationkey, 'extra' FROM (SELECT s_nationkey FROM supplier WHERE s_nationkey % 2 = 0 EXCEPT SELECT c_nationkey FROM customer WHERE true)")
def set_missing_extra(spark, sf_dir):
    left = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    right = table(spark, sf_dir, "supplier").filter("s_nationkey % 2 = 0").select(F.col("s_nationkey").alias("nation"))
    return lookups.differences(left, right, "nation")


@query("SELECT c_nationkey AS nation FROM customer WHERE c_acctbal > 9000 INTERSECT SELECT s_nationkey FROM supplier")
def set_intersect(spark, sf_dir):
    left = table(spark, sf_dir, "customer").filter("c_acctbal > 9000").select(F.col("c_nationkey").alias("nation"))
    return left.intersect(table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation")))


@query("SELECT user_id FROM events WHERE event_type = 'error' UNION SELECT user_id FROM events WHERE value > 50")
def union_distinct(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.filter("event_type = 'error'").select("user_id").unionAll(events.filter("value > 50").select("user_id")).distinct()


@query("SELECT doc_id AS id, source AS title, lang, CAST(NULL AS VARCHAR) AS url FROM documents UNION ALL SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1), NULL, url FROM pages")
def union_by_name(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("title"), "lang")
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), "url")
    return lookups.levels(docs, pages)
