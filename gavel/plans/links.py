"""Link extraction from pages: anchors with their positions, absolute URLs, dedup scopes, titles, types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavel.functions import filters, urls
from gavel.operators import ordered
from gavel.registry import query
from gavel.session import table
from gavel.sources import html, tables

ANCHOR = r'<a href="([^"]*)"[^>]*>([^<]*)</a>'


def anchors(pages: DataFrame) -> DataFrame:
    """page_id, url, pos, href, label: well-formed anchors in document order, without leaving the JVM."""
    both = F.arrays_zip(F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(1)).alias("href"), F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(2)).alias("label"))
    return pages.select("page_id", "url", F.posexplode(both).alias("pos", "a")).select("page_id", "url", "pos", "a.href", "a.label")


ANCHORS = "(SELECT page_id, url, unnest(range(len(h))) AS pos, unnest(h) AS href, unnest(l) AS label FROM (SELECT page_id, url, regexp_extract_all(html, '<a href=\"([^\"]*)\"[^>]*>([^<]*)</a>', 1) AS h, regexp_extract_all(html, '<a href=\"([^\"]*)\"[^>]*>([^<]*)</a>', 2) AS l FROM pages))"
BASE = "'https://' || lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)', 2))"
ABSOLUTE = f"CASE WHEN starts_with(href, 'http') THEN href ELSE {BASE} || '/' || regexp_replace(href, '^/+', '') END"


def _links(spark, sf_dir) -> DataFrame:
    base = F.concat(F.lit("https://"), urls.host(F.col("url")))
    return anchors(table(spark, sf_dir, "pages")).withColumn("link", urls.absolute(F.col("href"), base))


@query(f"SELECT page_id, pos, href, label FROM {ANCHORS}")
def page_links(spark, sf_dir):
    return anchors(table(spark, sf_dir, "pages")).select("page_id", F.col("pos").cast("long").alias("pos"), "href", "label")


@query(f"SELECT page_id, pos, link, lower(regexp_extract(link, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)', 2)) = lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)', 2)) AS own FROM (SELECT *, {ABSOLUTE} AS link FROM {ANCHORS})")
def page_links_absolute(spark, sf_dir):
    return _links(spark, sf_dir).select("page_id", F.col("pos").cast("long").alias("pos"), "link", urls.same_site(urls.host(F.col("link")), urls.host(F.col("url"))).alias("own"))


@query(f"SELECT page_id, pos, href FROM {ANCHORS} QUALIFY row_number() OVER (PARTITION BY page_id, href ORDER BY pos) = 1")
def page_links_dedup(spark, sf_dir):
    return ordered.first_occurrence(anchors(table(spark, sf_dir, "pages")), ["href"], ["pos"], ["page_id"]).select("page_id", F.col("pos").cast("long").alias("pos"), "href")


@query(f"SELECT host, page_id, pos, href FROM (SELECT *, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)', 2)) AS host FROM {ANCHORS} WHERE length(href) > 4) QUALIFY row_number() OVER (PARTITION BY host, href ORDER BY page_id, pos) = 1")
def page_links_dedup_host(spark, sf_dir):
    """The filter goes first, so that what it drops does not hide a later link."""
    rows = anchors(table(spark, sf_dir, "pages")).filter("length(href) > 4").withColumn("host", urls.host(F.col("url")))
    return ordered.first_occurrence(rows, ["href"], ["page_id", "pos"], ["host"]).select("host", "page_id", F.col("pos").cast("long").alias("pos"), "href")


@query(f"SELECT page_id, min(pos) AS pos, href FROM (SELECT page_id, pos, regexp_replace(regexp_replace(href, '[?#].*$', ''), '/+$', '') AS href FROM {ANCHORS}) WHERE regexp_matches(href, '^/th') GROUP BY page_id, href")
def page_paths(spark, sf_dir):
    """Distinct paths of links that a pattern accepts, in order."""
    rows = anchors(table(spark, sf_dir, "pages")).withColumn("href", urls.path_key(F.col("href"))).filter(F.col("href").rlike("^/th"))
    return ordered.first_occurrence(rows, ["href"], ["pos"], ["page_id"]).select("page_id", F.col("pos").cast("long").alias("pos"), "href")


@query("SELECT page_id, substr(coalesce(nullif(trim(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), ' *[|-] *[^|-]*$', '')), ''), nullif(regexp_extract(html, '<h1>([^<]*)</h1>', 1), ''), '(onbekende titel)'), 1, 80) AS title FROM pages")
def page_titles(spark, sf_dir):
    title = F.trim(F.regexp_replace(F.regexp_extract("html", "<title>([^<]*)</title>", 1), r" *[|-] *[^|-]*$", ""))
    heading = F.regexp_extract("html", "<h1>([^<]*)</h1>", 1)
    return table(spark, sf_dir, "pages").select("page_id", F.substr(F.coalesce(F.nullif(title, F.lit("")), F.nullif(heading, F.lit("")), F.lit("(onbekende titel)")), F.lit(1), F.lit(80)).alias("title"))


KEYWORDS = ["the", "que", "nicht", "de"]
TYPE_SQL = "CASE " + " ".join(f"WHEN contains(lower({{0}}), '{k}') THEN '{k}'" for k in KEYWORDS) + " ELSE 'overig' END"


@query(f"SELECT kind, count(*) AS n FROM (SELECT {TYPE_SQL.format('label')} AS kind FROM {ANCHORS}) GROUP BY kind")
def doc_type_keywords(spark, sf_dir):
    return anchors(table(spark, sf_dir, "pages")).groupBy(filters.document_type(F.col("label"), KEYWORDS).alias("kind")).agg(F.count("*").alias("n"))


@query("SELECT page_id, unnest(['https://x.be/' || page_id, 'https://x.be/' || page_id || '/agenda', 'https://x.be/' || page_id || '/besluitenlijst']) AS link FROM pages")
def meeting_subpages(spark, sf_dir):
    """Each meeting page with its fixed sub-pages."""
    base = F.concat(F.lit("https://x.be/"), F.col("page_id").cast("string"))
    return table(spark, sf_dir, "pages").select("page_id", F.explode(F.array(base, F.concat(base, F.lit("/agenda")), F.concat(base, F.lit("/besluitenlijst")))).alias("link"))


@query("SELECT page_id, unnest(range(len(h))) AS pos, replace(replace(unnest(h), '&amp;', '&'), '&#39;', '''') AS href FROM (SELECT page_id, regexp_extract_all(html, '<a href=\"([^\"]*)\"[^>]*>', 1) AS h FROM pages)")
def html_anchor_udtf(spark, sf_dir):
    """The anchors that the parser finds; on well-formed pages the same as the pattern's."""
    found = html.anchors(table(spark, sf_dir, "pages"), "html", ["page_id"])
    return found.select("page_id", "pos", "href")


@query("SELECT page_id, text FROM (SELECT page_id, unnest(list_transform(regexp_extract_all(html, '<li>(.*?)</li>', 1), lambda x: regexp_replace(x, '<[^>]*>', '', 'g'))) AS text FROM pages)")
def html_list_items(spark, sf_dir):
    found = html.elements(table(spark, sf_dir, "pages"), "html", ["page_id"], ("li",))
    return found.select("page_id", "text")


_SPACE = r"[\p{Z}\x09-\x0D\x1C-\x1F\x{85}]+"
_SINGLE = f"trim(regexp_replace(text, '{_SPACE}', ' ', 'g'), ' ')"
_CELLS = f"(SELECT doc_id, replace(replace(t, '&', ''), '<', '') AS t FROM (SELECT doc_id, {_SINGLE} AS t FROM documents) WHERE t <> '')"


def _tabled(spark, sf_dir) -> DataFrame:
    """Pages with a table of one row, whose cells are the words of a document."""
    single = F.trim(F.regexp_replace("text", _SPACE, " "))
    words = F.split(F.replace(F.replace(single, F.lit("&"), F.lit("")), F.lit("<"), F.lit("")), " ")
    cells = F.array_join(F.transform(words, lambda w: F.concat(F.lit("<td>"), w, F.lit("</td>"))), "")
    docs = table(spark, sf_dir, "documents").filter(single != "")
    return docs.select("doc_id", F.concat(F.lit("<table><tr><th>x</th></tr><tr>"), cells, F.lit("</tr></table>")).alias("html"))


@query(f"SELECT doc_id, CAST(1 AS BIGINT) AS row_no, replace(t, ' ', '|') AS cells FROM {_CELLS}")
def html_rows_udtf(spark, sf_dir):
    """Cells of tables that are made of the words of all documents."""
    return html.table_rows(_tabled(spark, sf_dir), "html", ["doc_id"]).select("doc_id", "row_no", F.array_join("cells", "|").alias("cells"))


@query(f"SELECT doc_id, CAST(0 AS BIGINT) AS table_no, CAST(1 AS BIGINT) AS row_no, len(string_split(t, ' ')) AS n_cells, md5(replace(t, ' ', '|')) AS cells FROM {_CELLS}")
def html_rows_sql(spark, sf_dir):
    """The same as a table function in SQL; the key travels by itself."""
    tables.register(spark)
    _tabled(spark, sf_dir).createOrReplaceTempView("gavel_tabled")
    return spark.sql("SELECT doc_id, table_no, row_no, CAST(size(cells) AS BIGINT) AS n_cells, md5(array_join(cells, '|')) AS cells FROM html_rows(TABLE(SELECT doc_id, html FROM gavel_tabled), 'html')")


@query("SELECT host, count(*) AS n_links, count(DISTINCT href) AS n_targets FROM (SELECT lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)', 2)) AS host, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"[^>]*>', 1)) AS href FROM pages) GROUP BY host")
def html_links_sql(spark, sf_dir):
    """Links of each host, by a table function whose input is partitioned by host, grouped in the same SQL."""
    tables.register(spark)
    table(spark, sf_dir, "pages").select(urls.host(F.col("url")).alias("host"), "page_id", "html").createOrReplaceTempView("gavel_hosted")
    return spark.sql("SELECT host, count(*) AS n_links, count(DISTINCT href) AS n_targets FROM html_anchors(TABLE(gavel_hosted) PARTITION BY (host), 'html') GROUP BY host")


@query("SELECT page_id, unnest(list_transform(regexp_extract_all(html, '<li>(.*?)</li>', 1), lambda x: regexp_replace(x, '<[^>]*>', '', 'g'))) AS text, 'li' AS tag FROM pages")
def html_elements_sql(spark, sf_dir):
    """Elements by tag, with an attribute, as a table function."""
    tables.register(spark)
    table(spark, sf_dir, "pages").select("page_id", "html").createOrReplaceTempView("gavel_listed")
    return spark.sql("SELECT page_id, text, tag FROM html_elements(TABLE(gavel_listed), 'html', 'li, dt', 'id') WHERE tag = 'li'")
