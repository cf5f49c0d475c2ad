"""Crawls of folders, over pages that are made from whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.functions import dates
from gavel.operators import crawl
from gavel.plans import scans
from gavel.registry import query
from gavel.session import table
from gavel.sources import html

_K = "o_orderkey"
LIMIT = "1995-06-01"
# an order lies in the folder of an eighth of its number; every third is a folder, named by its year
_TREE = f"""WITH RECURSIVE t AS (SELECT {_K} AS k, {_K} // 8 AS up, {_K} % 3 = 0 AS folder, CAST(o_orderdate AS DATE) AS d FROM orders WHERE {_K} > 0),
r AS (SELECT CAST(0 AS BIGINT) AS k, 0 AS depth, true AS goes UNION ALL SELECT t.k, r.depth + 1, folder AND year(d) >= 1995 FROM t JOIN r ON t.up = r.k AND r.goes)"""


def _pages(orders):
    """key, html of each folder: its children by key, and itself, its parent and the root once more."""
    k = F.col(_K)
    said = F.when(k % 3 == 0, F.date_format("o_orderdate", "yyyy")).when(k % 11 == 0, "zonder datum").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    entry = F.concat(F.lit('<a data-key="'), k.cast("string"), F.lit('">'), said, F.lit("</a>"))
    listed = orders.filter(k > 0).groupBy(F.floor(k / 8).alias("up")).agg(F.array_join(F.sort_array(F.collect_list(entry)), "").alias("own"))  # eight at most
    again = lambda c: F.concat(F.lit('<a data-key="'), c.cast("string"), F.lit('">2000</a>'))
    up = F.col("up")
    return listed.select(up.cast("string").alias("key"), F.concat("own", again(up), again(F.floor(up / 8)), again(F.lit(0))).alias("html"))


def _crawled(spark, sf_dir):
    """key, text, depth of all that is found from the root on."""
    pages = _pages(table(spark, sf_dir, "orders"))

    def links(read):
        found = html.elements(read, "html", ["key"], ("a",), "data-key").filter("value is not null and text <> ''")
        return found.select(F.col("value").alias("key"), "text")

    deeper = crawl.through_pages(pages, links, "key")
    year = F.when(F.col("text").rlike(r"^\d{4}$"), F.col("text").cast("int"))
    return crawl.reached(spark.createDataFrame([("0", "2000")], "key string, text string"), lambda frontier: deeper(frontier.filter(year >= 1995)), ["key"])


@query(f"{_TREE} SELECT t.k AS o_orderkey, d AS day, depth FROM r JOIN t USING (k) WHERE NOT folder AND t.k % 11 <> 0 AND d >= DATE '{LIMIT}'")
def crawl_folders(spark, sf_dir):
    """Meetings in folders of any depth, with cycles: years that are too old are not entered."""
    found = _crawled(spark, sf_dir).withColumn("day", dates.parsed(F.col("text"), "folder_label"))
    return found.filter(F.col("day") >= F.lit(LIMIT).cast("date")).select(F.col("key").cast("long").alias("o_orderkey"), "day", "depth")


@query(f"{_TREE} SELECT depth, count(*) AS found, count(*) FILTER (WHERE goes) AS entered FROM r GROUP BY depth")
def crawl_rounds(spark, sf_dir):
    """What each round of the crawl found, and how many folders of it were entered."""
    goes = F.col("text").rlike(r"^\d{4}$") & (F.col("text").try_cast("int") >= 1995)
    return _crawled(spark, sf_dir).groupBy("depth").agg(F.count("*").alias("found"), F.count_if(goes).alias("entered"))


_YEARS = "(SELECT DISTINCT o_custkey AS c, year(o_orderdate) + 6 AS y FROM orders)"
_LINK = "'/c/' || c || '/' || y"


@query(
    f"SELECT 'year' AS how, c AS o_custkey, {_LINK} AS link FROM {_YEARS} WHERE y >= 2002 "
    f"UNION ALL SELECT 'last', c, {_LINK} FROM {_YEARS} QUALIFY row_number() OVER (PARTITION BY c ORDER BY y DESC) <= 3 "
    f"UNION ALL SELECT 'also', c, {_LINK} FROM {_YEARS} UNION ALL SELECT 'also', c, '/c/' || c FROM {_YEARS} GROUP BY c "
    f"UNION ALL SELECT 'instead', c, {_LINK} FROM {_YEARS} WHERE y = 2004 UNION ALL SELECT 'instead', c, '/c/' || c FROM {_YEARS} GROUP BY c HAVING count(*) FILTER (WHERE y = 2004) = 0"
)
def crawl_subfolders(spark, sf_dir):
    """Which sub-folders of a page are read: by year, the newest, all with the page itself, or the page where there is none."""
    root = scans._folders(spark, sf_dir)[1]
    links, keys = html.anchors(root, "html", ["o_custkey"]).withColumnRenamed("href", "link"), ["o_custkey"]
    index = root.select("o_custkey", F.concat(F.lit("/c/"), F.col("o_custkey").cast("string")).alias("link"))
    ways = {
        "year": crawl.subfolders(links, index, keys, r"/\d{4}$", "year", since=2002),
        "last": crawl.subfolders(links, index, keys, r"/\d{4}$", "last", months=24),
        "also": crawl.subfolders(links, index, keys, r"/\d{4}$", root="also"),
        "instead": crawl.subfolders(links, index, keys, r"/2004$", root="instead"),
    }
    out = [way.select(F.lit(how).alias("how"), "o_custkey", "link") for how, way in ways.items()]
    return out[0].unionAll(out[1]).unionAll(out[2]).unionAll(out[3])
