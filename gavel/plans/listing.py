"""Listings of pages: sites are made from whole tables, written as a mirror, and read back page by page."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavel.functions import dates, urls
from gavel.operators import ordered, scans
from gavel.registry import query
from gavel.session import scratch, spread, table
from gavel.sources import files, html, listing, payloads

SINCE = "1995-06-01"


def _day() -> Column:
    return F.col("o_orderdate").cast("date")


def published(spark, pages: DataFrame) -> str:
    """Write pages (url, body) as a mirror; its transport."""
    listing.register(spark)
    root = scratch(spark, "mirror")
    name = F.regexp_replace("url", r"^[a-z]+://", "")
    pages.select(name.alias("file"), F.col("body").cast("binary").alias("body")).write.format("gavel-files").option("path", root).mode("append").save()
    return f"mirror:{root}"


#: Rows of the table behind a site that make a pack of it.
PACKED = 50_000


def packed(spark, pages: DataFrame, rows: int) -> str:
    """Write pages (url, body), made of so many rows, as packs; their transport. The packs grow in number, not in size."""
    packs, root = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // PACKED), scratch(spark, "packs")
    files.write_packs(pages, root, packs)
    return f"packs:{packs}:{root}"


def _units(orders: DataFrame) -> DataFrame:
    """Each customer's meetings, latest first, eight a page of JSON:API that names the next one; three hosts."""
    attributes = F.struct(F.date_format(_day(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("planned"))
    item = F.struct(F.lit("meeting").alias("type"), F.col("o_orderkey").cast("string").alias("id"), attributes.alias("attributes"))
    own = orders.groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct((-F.unix_date(_day())).alias("d"), F.col("o_orderkey").alias("k"), item.alias("item"))))["item"].alias("items"))
    last = F.floor((F.size("items") - 1) / 8).cast("int")
    page = own.withColumn("at", F.explode(F.sequence(F.lit(0), last))).withColumn("last", last)
    path = lambda at: F.concat(F.lit("/units/"), F.col("o_custkey").cast("string"), F.when(at > 0, F.concat(F.lit("?page="), at.cast("string"))).otherwise(""))
    links = F.struct(F.when(F.col("at") < F.col("last"), path(F.col("at") + 1)).alias("next"))
    body = F.to_json(F.struct(F.slice("items", F.col("at") * 8 + 1, 8).alias("data"), links.alias("links")))
    return page.select(F.concat(F.lit("https://h"), (F.col("o_custkey") % 3).cast("string"), F.lit(".be"), path(F.col("at"))).alias("url"), body.alias("body"))


def _followed(spark, sf_dir: str, bodies: bool = True) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    n = orders.count()
    cursor = listing.Cursor(transport=packed(spark, _units(spread(orders, n, "o_custkey")), n), since=listing.day_of(SINCE), spacing=0.0)
    starts = orders.select("o_custkey").distinct().select(F.concat(F.lit("https://h"), (F.col("o_custkey") % 3).cast("string"), F.lit(".be/units/"), F.col("o_custkey").cast("string")).alias("listing"))
    return listing.follow(starts, cursor, bodies=bodies)


@query(f"SELECT o_custkey, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderdate >= DATE '{SINCE}'")
def paged_meetings(spark, sf_dir):
    """Meetings since a day, from paged JSON:API listings that are left once they get older."""
    pages = _followed(spark, sf_dir).select(F.regexp_extract("listing", r"(\d+)$", 1).cast("long").alias("o_custkey"), F.col("body").alias("payload"))
    found = payloads.entries(pages).select("o_custkey", "id", F.col("start").try_cast("date").alias("day"))
    return found.filter(F.col("day") >= F.lit(SINCE).cast("date"))


@query(f"SELECT o_custkey, least((count(*) + 7) // 8, count(*) FILTER (WHERE o_orderdate >= DATE '{SINCE}') // 8 + 1) AS pages, 0 AS failed FROM orders GROUP BY 1")
def paged_requests(spark, sf_dir):
    """How many pages of each listing were asked for: none after the first that has something older."""
    pages = _followed(spark, sf_dir, bodies=False)
    return pages.groupBy(F.regexp_extract("listing", r"(\d+)$", 1).cast("long").alias("o_custkey")).agg(F.count("*").alias("pages"), F.count("error").alias("failed"))


#: Numbers of an offset, and orders that are dealt to three hosts and numbers.
STEP, DEALT = 20, 96
_OLDER = f"SELECT o_orderkey AS k, o_orderkey % 3 AS h, o_orderkey // {DEALT} AS p, DATE '2024-12-31' - CAST(o_orderkey // {DEALT} AS INT) * 3 - CAST(o_orderkey % 3 AS INT) AS d FROM orders"


def _offsets(orders: DataFrame) -> DataFrame:
    """Three hosts' listings in HTML, {STEP} numbers a page: documents that get older, a link to the page itself, one to elsewhere."""
    k = F.col("o_orderkey")
    day = F.date_sub(F.lit("2024-12-31").cast("date"), (F.floor(k / DEALT) * 3 + k % 3).cast("int"))
    entry = F.concat(F.lit('<a href="/z/'), k.cast("string"), F.lit('">Zitting '), F.date_format(day, "dd/MM/yyyy"), F.lit("</a>"))
    own = orders.groupBy((k % 3).alias("h"), F.floor(k / DEALT).alias("p")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(k.alias("k"), entry.alias("e")))), lambda x: x["e"]), "").alias("entries"))  # at most {DEALT}
    url = F.concat(F.lit("https://o"), F.col("h").cast("string"), F.lit(".be/zittingen?b_start="), (F.col("p") * STEP).cast("string"))
    return own.select(url.alias("url"), F.concat(F.lit('<a rel="self" href="/zittingen">x</a>'), "entries", F.lit('<a href="https://elders.be/z/0">elders</a>')).alias("body"))


@query(f"SELECT 'o' || h || '.be' AS host, k AS o_orderkey, d AS day FROM ({_OLDER}) WHERE d >= DATE '2024-10-01'")
def paged_offsets(spark, sf_dir):
    """Pages by offset until something is too old, the day read off the query's filter; links to the page itself and to other hosts go."""
    transport = published(spark, _offsets(table(spark, sf_dir, "orders")))
    options = {"listings": json.dumps([f"https://o{h}.be/zittingen" for h in range(3)]), "protocol": "offset", "parameter": "b_start", "step": str(STEP), "look": "gavel.sources.listing:html_page", "transport": transport, "spacing": "0"}
    pages = spark.read.format("gavel-listing").options(**options).load().filter("newest >= DATE '2024-10-01'")
    found = html.anchors(pages.select("listing", "page", "body"), "body", ["listing", "page"])
    found = found.withColumn("link", urls.absolute(F.col("href"), urls.origin(F.col("listing")))).filter((urls.host(F.col("link")) == urls.host(F.col("listing"))) & (F.col("link") != F.col("listing")))
    found = found.withColumn("day", dates.parsed(F.col("label"), "slash"))
    kept = found.filter(F.col("day") >= F.lit("2024-10-01").cast("date"))  # a page's items are as mixed as they come
    return ordered.first_occurrence(kept, ["link"], ["page", "pos"], ["listing"]).select(urls.host(F.col("listing")).alias("host"), urls.last_segment(F.col("link")).cast("long").alias("o_orderkey"), "day")


@query("SELECT strftime(o_orderdate, '%Y%m') AS month, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderdate >= DATE '1996-03-01' AND o_orderdate < DATE '1998-02-01'")
def calendar_stream(spark, sf_dir):
    """Months of three portals' calendars as a stream, a few requests a trigger, each run going on where the last one ended."""
    orders = table(spark, sf_dir, "orders")
    meeting = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("dateTime"))
    url = F.concat(F.lit("https://c"), (F.col("o_orderkey") % 3).cast("string"), F.lit(".be/calendar/"), F.date_format("o_orderdate", "yyyyMM"))
    calls = orders.groupBy(url.alias("url")).agg(F.to_json(F.struct(F.collect_list(meeting).alias("meetings"))).alias("body"))
    options = {"listings": json.dumps([f"https://c{h}.be/calendar/{{month}}" for h in range(3)]), "from": "1996-03", "until": "1998-01", "requests": "6", "spacing": "0", "transport": published(spark, calls)}
    out, checkpoint = scratch(spark, "calendar"), scratch(spark, "calendar-checkpoint")
    source = spark.readStream.format("gavel-listing").options(**options).load()
    found = payloads.meetings(source.select(F.regexp_extract("listing", r"(\d+)$", 1).alias("month"), F.col("body").alias("payload"))).select("month", "id", "day")
    while True:  # as a scheduler would run it again and again
        run = found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        run.awaitTermination()
        if not run.recentProgress or not any(p["sources"][0]["endOffset"] != p["sources"][0]["startOffset"] for p in run.recentProgress):
            break
    return spark.read.schema("month string, id string, day date").parquet(out)


@query("SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN false ELSE c_custkey % 4 <> 0 END AS reachable, CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 5 = 0 THEN 'invalid URL' END AS error FROM customer")
def reachability(spark, sf_dir):
    """Entities whose addresses are probed: what answers, what does not, what is no address, and what has none."""
    k, n = F.col("c_custkey"), F.col("c_custkey").cast("string")
    url = F.when(k % 7 == 0, None).when(k % 5 == 0, F.concat(F.lit("ftp://r.be/"), n)).otherwise(F.concat(F.lit("https://r"), (k % 3).cast("string"), F.lit(".be/c/"), n))
    rows = table(spark, sf_dir, "customer").select("c_custkey", url.alias("url"))
    there = rows.filter((k % 4 != 0) & F.col("url").startswith("https")).select("url", F.lit("x").alias("body"))
    results = listing.probes(rows, transport=published(spark, there), spacing=0.0)
    return scans.probed(rows, results, "url").select("c_custkey", "reachable", "error")
