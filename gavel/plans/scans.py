"""Structure scans over pages that are built from whole tables, so that SQL can say what must be found on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavel.functions import dates
from gavel.operators import ordered, reports, scans
from gavel.registry import query
from gavel.session import spread, table
from gavel.sources import html

O = "(SELECT o_orderkey AS k, o_custkey AS c, CAST(o_orderdate AS DATE) AS d FROM orders)"  # noqa: E741
UUID_SQL = "substr(md5({0}), 1, 8) || '-' || substr(md5({0}), 9, 4) || '-' || substr(md5({0}), 13, 4) || '-' || substr(md5({0}), 17, 4) || '-' || substr(md5({0}), 21, 12)"


def _limit() -> Column:
    return F.lit("1995-06-01").cast("date")


def _day() -> Column:
    return F.col("o_orderdate").cast("date")


def _k() -> Column:
    return F.col("o_orderkey").cast("string")


def _c() -> Column:
    return F.col("o_custkey").cast("string")


def _uuid(value: Column) -> Column:
    h = F.md5(value)
    return F.concat_ws("-", *(F.substr(h, F.lit(a), F.lit(n)) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))


def _text(*parts) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def _month(names: dict[str, int]) -> Column:
    return dates.month_name(F.month(_day()), names)


def _pages(rows: DataFrame, keys: list[str], fragment: Column, order: str = "o_orderkey", head: str = "", tail: str = "") -> DataFrame:
    """One page a key, of the fragments of its rows in order."""
    parts = F.sort_array(F.collect_list(F.struct(F.col(order).alias("k"), fragment.alias("h"))))
    return rows.groupBy(*keys).agg(F.concat(F.lit(head), F.array_join(F.transform(parts, lambda p: p["h"]), ""), F.lit(tail)).alias("html"))


def _customers(spark, sf_dir) -> tuple[DataFrame, int]:
    """Orders, a customer's in one task, and how many there are."""
    orders = table(spark, sf_dir, "orders")
    n = orders.count()
    return spread(orders, n, "o_custkey"), n


def _flow(spark, sf_dir, fragment: Column, attributes: tuple[str, ...] = ("href",), **options) -> DataFrame:
    """Elements of one page a customer, made of the orders, with the attributes that a scan looks at."""
    orders, n = _customers(spark, sf_dir)
    return spread(html.flow(_pages(orders, ["o_custkey"], fragment, **options), "html", ["o_custkey"], attributes=attributes), n, "o_custkey")


def _lines(spark, sf_dir) -> tuple[DataFrame, int]:
    """Order lines, an order's in one task, and how many there are."""
    lines = table(spark, sf_dir, "lineitem")
    n = lines.count()
    return spread(lines, n, "l_orderkey"), n


@query(f"SELECT c AS o_custkey, '/d/' || k || '.pdf' AS link, CASE WHEN k % 2 = 0 THEN CAST(k AS VARCHAR) ELSE 'Doc ' || k END AS name, d AS day FROM {O} WHERE k % 5 <> 0 AND d >= DATE '1995-06-01'")
def scan_date_first_rows(spark, sf_dir):
    """Table rows that begin with a date."""
    day = F.when(F.col("o_orderkey") % 5 == 0, "geen datum").otherwise(F.date_format(_day(), "dd/MM/yyyy"))
    label = F.when(F.col("o_orderkey") % 2 == 0, "PDF").otherwise(_text("Doc ", _k()))
    found = _flow(spark, sf_dir, _text(F.when(F.col("o_orderkey") % 3 == 0, _text("<tr><th>", day, "</th>")).otherwise(_text("<tr><td>", day, "</td>")), '<td><a href="/d/', _k(), '.pdf">', label, '</a> <a href="/d/x.html">x</a></td></tr>'), head="<table>", tail="</table>")
    return scans.date_first_rows(found, ["o_custkey"], _limit())


@query(f"SELECT c AS o_custkey, CAST(k AS VARCHAR) AS key, 'T' || k AS title, strftime(d, '%d-%m-%Y') AS date_text FROM {O} WHERE k % 7 <> 0")
def scan_positional_rows(spark, sf_dir):
    """Cells by place; rows with too few cells and later rows of a key are left out."""
    whole = _text("<tr><td>a</td><td>b</td><td>", '<a href="/p?x=1&amp;pubKey=', _k(), '">T', _k(), "</a></td><td>", F.date_format(_day(), "dd-MM-yyyy"), "</td></tr>")
    again = F.when(F.col("o_orderkey") % 3 == 0, _text("<tr><td>a</td><td>b</td><td>", '<a href="/p?pubKey=', _k(), '">later</a></td><td>later</td></tr>')).otherwise("")
    short = _text('<tr><td>a</td><td><a href="/p?pubKey=', _k(), '">T</a></td></tr>')
    found = _flow(spark, sf_dir, F.when(F.col("o_orderkey") % 7 == 0, short).otherwise(_text(whole, again)), head="<table>", tail="</table>")
    return scans.positional_rows(found, ["o_custkey"], "pubKey")


@query(f"SELECT c AS o_custkey, CASE WHEN k % 2 = 0 THEN '/one/' ELSE '/two/' END || k AS link, CAST(k % 4 AS VARCHAR) AS category, CAST(k % 3 AS VARCHAR) AS kind, d AS day FROM {O} WHERE d >= DATE '1995-06-01'")
def scan_attribute_rows(spark, sf_dir):
    """Rows whose time, category and type stand in an attribute."""
    said = _text("isShown(", F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).cast("string"), ", cat: ", (F.col("o_orderkey") % 4).cast("string"), ", type: ", (F.col("o_orderkey") % 3).cast("string"), ")")
    link = lambda n: _text('<td><a href="/', n, "/", _k(), '">x</a></td>')
    cells = F.when(F.col("o_orderkey") % 2 == 0, _text(link("one"), link("two"))).otherwise(_text("<td>-</td>", link("two")))
    found = _flow(spark, sf_dir, _text('<tr x-show="', said, '">', cells, "</tr><tr><td>plain</td></tr>"), ("x-show", "href"), head="<table>", tail="</table>")
    return scans.attribute_rows(found, ["o_custkey"], "x-show", {"stamp": r"isShown\((\d+)", "category": r"cat: (\d+)", "kind": r"type: (\d+)"}, _limit())


@query(f"SELECT c AS o_custkey, 'B ' || k AS title, '/b/' || k AS link, CASE WHEN k % 2 = 0 THEN 'projet' ELSE 'definitief' END AS status, CASE WHEN k % 3 <> 0 THEN d END AS day FROM {O}")
def scan_cards(spark, sf_dir):
    """Cards with a heading, a link, label and value pairs, and sometimes a machine date."""
    time = F.when(F.col("o_orderkey") % 3 != 0, _text('<time datetime="', F.date_format(_day(), "yyyy-MM-dd"), 'T10:00:00">x</time>')).otherwise("")
    card = _text('<div class="item card"><h3>B ', _k(), '</h3><a href="/b/', _k(), '">x</a>', time, "<dl><dt>Status</dt><dd>", F.when(F.col("o_orderkey") % 2 == 0, "projet").otherwise("definitief"), "</dd></dl></div><p>between</p>")
    found = html.cards(_pages(_customers(spark, sf_dir)[0], ["o_custkey"], card), "html", ["o_custkey"], "card")
    return found.select("o_custkey", "title", "link", F.col("fields")["Status"].alias("status"), dates.parsed(F.col("day"), "iso").alias("day"))


@query(f"SELECT c AS o_custkey, 'B ' || k AS title, '/b/' || k AS link, d AS day FROM {O} WHERE k % 3 <> 0")
def scan_dated_cards(spark, sf_dir):
    """Only cards with a machine date count."""
    return scan_cards(spark, sf_dir).filter("day is not null").select("o_custkey", "title", "link", "day")


@query(f"SELECT c AS o_custkey, d AS day, count(*) AS n_documents, string_agg('/a' || k || '.pdf', ', ' ORDER BY k) AS documents FROM {O} WHERE k % 4 <> 0 GROUP BY 1, 2")
def scan_first_link_of_heading(spark, sf_dir):
    """The first document below each dated heading, grouped by date; a heading without one does not take the next one's."""
    files = F.when(F.col("o_orderkey") % 4 == 0, "").otherwise(_text('<p><a href="/x.html">x</a><a href="/a', _k(), '.pdf">A</a></p><a href="/b', _k(), '.pdf">B</a>'))
    found = _flow(spark, sf_dir, _text("<h3>Séance du ", F.date_format(_day(), "d"), " ", _month(dates.FRENCH), " ", F.date_format(_day(), "yyyy"), "</h3>", files))
    found = scans.first_links(found, ["o_custkey"], "h3", "spoken_french")
    return reports.documents_by_meeting(found, ["o_custkey", "day"], ["section"], F.col("link"))


@query(f"SELECT c AS o_custkey, unnest(['/a' || k || '.pdf', '/b' || k || '.pdf']) AS link, d AS day FROM {O} WHERE d >= DATE '1995-01-01'")
def scan_year_lists(spark, sf_dir):
    """Lists below years, newest first; reading ends at the first year that is too old."""
    orders, n = _customers(spark, sf_dir)
    rows = orders.withColumn("year", F.year(_day()))
    item = _text("<li>", F.date_format(_day(), "d"), " ", _month(dates.FRENCH), ': <a href="/a', _k(), '.pdf">A</a> <a href="/b', _k(), '.pdf">B</a></li>')
    lists = _pages(rows, ["o_custkey", "year"], item).withColumn("newest", -F.col("year"))
    pages = _pages(lists, ["o_custkey"], _text("<h3>", F.col("year").cast("string"), "</h3><ul>", F.col("html"), "</ul>"), "newest")
    return scans.year_lists(spread(html.flow(pages, "html", ["o_custkey"], attributes=("href",)), n, "o_custkey"), ["o_custkey"], F.lit("1995-01-01").cast("date"))


@query(f"SELECT c AS o_custkey, '/pub/n-' || strftime(d, '%Y-%m-%d') || '-' || k || '.pdf' AS link, 'Notulen ' || k AS name, coalesce(last_value(CASE WHEN k % 4 = 0 THEN d END IGNORE NULLS) OVER (PARTITION BY c ORDER BY k ROWS UNBOUNDED PRECEDING), d) AS day, 'notulen' AS doc_type FROM {O}")
def scan_inherited_dates(spark, sf_dir):
    """Links take the date of the heading above them, and their own where there is none yet."""
    tag = F.when(F.col("o_orderkey") % 8 == 0, "h4").otherwise("h2")
    heading = F.when(F.col("o_orderkey") % 4 == 0, _text("<", tag, ">", F.date_format(_day(), "d"), " ", _month(dates.DUTCH), " ", F.date_format(_day(), "yyyy"), "</", tag, ">")).otherwise("<b>geen datum</b>")
    links = _text('<a href="/pub/n-', F.date_format(_day(), "yyyy-MM-dd"), "-", _k(), '.pdf">Notulen ', _k(), '</a><a href="/pub/x.pdf">HTML</a><a href="/pub/', _k(), '.html">Notulen</a><a href="/other/x.pdf">x</a>')
    return scans.inherited_dates(_flow(spark, sf_dir, _text(heading, links)), ["o_custkey"], "/pub/")


@query(f"SELECT c AS o_custkey, '/in/' || k AS link, day FROM (SELECT *, last_value(CASE WHEN k % 2 = 0 THEN d END IGNORE NULLS) OVER (PARTITION BY c ORDER BY k ROWS UNBOUNDED PRECEDING) AS day FROM {O}) WHERE day >= DATE '1995-06-01'")
def scan_containers(spark, sf_dir):
    """The first container that a page has, of three; links outside it, and links without a date above them, are left out."""
    heading = F.when(F.col("o_orderkey") % 2 == 0, _text("<h3>", F.date_format(_day(), "dd/MM/yyyy"), "</h3>")).otherwise("")
    pages = _pages(table(spark, sf_dir, "orders"), ["o_custkey"], _text(heading, '<a href="/in/', _k(), '">x</a>'))
    box = F.element_at(F.lit(["content", "main", "field"]), (F.col("o_custkey") % 3 + 1).cast("int"))
    later = F.when(F.col("o_custkey") % 3 == 0, '<div id="main"><h3>01/01/2020</h3><a href="/no">n</a></div>').otherwise("")
    page = _text('<h3>01/01/2020</h3><a href="/out">o</a>', later, '<div id="', box, '">', F.col("html"), '</div><h3>01/01/2020</h3><a href="/out">o</a>')
    return scans.in_container(html.flow(pages.select("o_custkey", page.alias("html")), "html", ["o_custkey"]), ["o_custkey"], ["content", "main", "field"], _limit())


@query("SELECT n_regionkey, n_name AS label, CAST(n_nationkey AS VARCHAR) AS value FROM nation")
def scan_options(spark, sf_dir):
    """Options of one select field, without the empty one and those of other fields."""
    option = _text('<option value="', F.col("n_nationkey").cast("string"), '">', F.col("n_name"), "</option>")
    pages = _pages(table(spark, sf_dir, "nation"), ["n_regionkey"], option, "n_nationkey", '<select name="other"><option value="9">x</option></select><select name="organId"><option value="">kies</option>', "</select>")
    return html.options(pages, "html", ["n_regionkey"], "organId").select("n_regionkey", "label", "value")


def _organ_links(spark, sf_dir) -> DataFrame:
    """Links of organ pages, one page a customer: meetings of two organs, a static page, another host and an unknown form."""
    slug = F.element_at(F.lit(["raad", "college", "nieuws"]), (F.col("o_orderkey") % 3 + 1).cast("int"))
    links = _text('<a href="https://h.be/', slug, "/", _uuid(_k()), '">Zitting ', slug, " ", F.date_format(_day(), "d/M/yyyy"), '</a><a href="https://x.be/', slug, "/", _uuid(_k()), '">other</a><a href="https://h.be/raad/', _k(), '">no id</a><a href="https://h.be/raad/', _uuid(_k()), '/deel">deep</a>')
    orders, n = _customers(spark, sf_dir)
    found = html.anchors(_pages(orders, ["o_custkey"], links), "html", ["o_custkey"]).withColumnRenamed("href", "link")
    return spread(scans.two_part_links(found, F.lit("h.be"), ("nieuws",)), n, "o_custkey")


@query("SELECT c AS o_custkey, slug, 'Zitting ' || slug AS name FROM (SELECT DISTINCT o_custkey AS c, CASE o_orderkey % 3 WHEN 0 THEN 'raad' ELSE 'college' END AS slug FROM orders WHERE o_orderkey % 3 < 2)")
def scan_organs_from_links(spark, sf_dir):
    """Organs from the first meeting link of each; the name is the link's, without its date."""
    first = ordered.first_occurrence(_organ_links(spark, sf_dir), ["slug"], ["pos"], ["o_custkey"])
    return first.select("o_custkey", "slug", scans.without_date(F.col("label")).alias("name"))


@query(f"SELECT o_custkey, {UUID_SQL.format('CAST(o_orderkey AS VARCHAR)')} AS uuid, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS nr FROM orders WHERE o_orderkey % 3 = 0")
def scan_meeting_links(spark, sf_dir):
    """Meetings of one organ in page order, each once."""
    from pyspark.sql import Window

    own = ordered.first_occurrence(_organ_links(spark, sf_dir).filter("slug = 'raad'"), ["uuid"], ["pos"], ["o_custkey"])
    return own.select("o_custkey", "uuid", F.row_number().over(Window.partitionBy("o_custkey").orderBy("pos")).alias("nr"))


@query("SELECT c_nationkey, '/units/nation-' || c_nationkey || '/organ-' || c_custkey AS organ FROM customer")
def scan_unit_tree(spark, sf_dir):
    """Organs lie one level below their unit; navigation, and what lies deeper, is no organ."""
    link = lambda *p: _text('<a href="/units/nation-', F.col("c_nationkey").cast("string"), *p, '">x</a>')
    k = F.col("c_custkey").cast("string")
    pages = _pages(table(spark, sf_dir, "customer"), ["c_nationkey"], _text(link("/organ-", k), link("/organ-", k, "/zitting-1"), '<a href="/units/disclaimer">d</a><a href="/about">a</a>'), "c_custkey", '<a href="/units">up</a>')
    found = html.anchors(pages, "html", ["c_nationkey"]).filter(F.col("href").startswith("/units/") & ~F.col("href").contains("disclaimer"))
    return found.filter(F.size(F.split("href", "/")) == 4).select("c_nationkey", F.col("href").alias("organ"))


# years of folders are six later, so that they lie on both sides of 2000
YEARS_SQL = "(SELECT DISTINCT o_custkey AS c, year(o_orderdate) + 6 AS y FROM orders)"


def _folders(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Root pages (o_custkey, html), year pages (path, html) and a folder of each order in its year's page."""
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year(_day()) + 6)
    years = orders.select("o_custkey", "year").distinct()
    y = F.col("year").cast("string")
    root = _pages(years, ["o_custkey"], _text('<a href="/c/', _c(), "/", y, '" data-key="', _c(), "-", y, '">', y, '</a><a href="/c/', _c(), "/", y, '/again">', y, "</a>"), "year", '<a href="/c/x">archief</a>')
    label = F.when(F.col("o_orderkey") % 6 == 0, "zonder datum").otherwise(_text(F.date_format(_day(), "yyyy-MM-dd")))
    listing = _pages(orders, ["o_custkey", "year"], _text('<a href="/m/', _k(), '" data-key="', _k(), '">', label, "</a>"))
    return orders, root, listing.select(_text("/c/", _c(), "/", y).alias("path"), "html")


@query("SELECT c AS o_custkey, y AS year FROM " + YEARS_SQL)
def scan_year_list(spark, sf_dir):
    """Links whose text is a year, each once, newest first."""
    found = html.anchors(_folders(spark, sf_dir)[1], "html", ["o_custkey"]).filter(F.col("label").rlike(r"^(19|20)\d{2}$"))
    return found.select("o_custkey", F.col("label").cast("long").alias("year")).distinct().orderBy("o_custkey", F.desc("year"))


@query(f"SELECT c AS o_custkey, '/m/' || k AS link, CASE WHEN k % 6 <> 0 THEN d END AS day FROM {O} WHERE year(d) >= 1995")
def scan_folder_tree(spark, sf_dir):
    """From the root to year folders to meetings; folders without a date stay."""
    _, root, listing = _folders(spark, sf_dir)
    found = html.anchors(root, "html", ["o_custkey"]).withColumnRenamed("href", "link")
    years = scans.year_pages(found, ["o_custkey"], F.lit(2001), root.select("o_custkey", F.lit("/").alias("link")))
    below = html.anchors(scans.children(listing, years.select("o_custkey", "link")), "html", ["o_custkey"])
    return below.select("o_custkey", F.col("href").alias("link"), dates.parsed(F.col("label"), "folder_label").alias("day"))


@query(f"SELECT c AS o_custkey, CAST(k AS VARCHAR) AS key, d AS day FROM {O} WHERE k % 6 <> 0 AND d >= DATE '1995-06-01'")
def scan_recursive_folders(spark, sf_dir):
    """Keyed elements: a year is a folder to read if it is not too old, anything else a meeting if it has a date that counts."""
    orders, root, listing = _folders(spark, sf_dir)
    keyed = lambda pages: html.elements(pages, "html", ["o_custkey"], ("a",), "data-key").filter("value is not null and text <> ''")
    level = keyed(root)
    years = ordered.first_occurrence(level.filter(F.col("text").rlike(r"^\d{4}$") & (F.col("text").try_cast("int") >= F.year(_limit()) + 6)), ["value"], ["pos"], ["o_custkey"])
    below = keyed(scans.children(listing, years.select("o_custkey", _text("/c/", F.replace("value", F.lit("-"), F.lit("/"))).alias("link"))))
    found = level.filter(~F.col("text").rlike(r"^\d{4}$")).unionByName(below).withColumn("day", dates.parsed(F.col("text"), "folder_label"))
    return found.filter(F.col("day") >= _limit()).select("o_custkey", F.col("value").alias("key"), "day")


@query("SELECT c AS o_custkey, CAST(c AS VARCHAR) || '-' || y AS key FROM " + YEARS_SQL)
def scan_keyed_elements(spark, sf_dir):
    """Distinct keys of elements with text, the page's own key left out."""
    found = html.elements(_folders(spark, sf_dir)[1], "html", ["o_custkey"], ("a",), "data-key").filter("value is not null and text <> ''")
    return found.filter(F.col("value") != _c()).select("o_custkey", F.col("value").alias("key")).distinct()


@query("SELECT c AS o_custkey, y AS year, '/c/' || c || '/' || y AS link FROM " + YEARS_SQL + " WHERE y >= 2004 UNION ALL SELECT c, NULL, '/' FROM (SELECT DISTINCT o_custkey AS c FROM orders) WHERE c NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) >= 1998)")
def scan_year_navigation(spark, sf_dir):
    """The first link of each year that counts; where there is none, the index page is the listing."""
    root = _folders(spark, sf_dir)[1]
    found = html.anchors(root, "html", ["o_custkey"]).withColumnRenamed("href", "link")
    return scans.year_pages(found, ["o_custkey"], F.lit(2004), root.select("o_custkey", F.lit("/").alias("link")))


@query("SELECT k AS o_orderkey, '/c/' || c || '/' || (year(d) + 6) AS path FROM " + O + " WHERE year(d) BETWEEN 1995 AND 1998")
def scan_year_parameter(spark, sf_dir):
    """Pages of all years from the limit's to the current one, whether a page links to them or not."""
    orders, _, listing = _folders(spark, sf_dir)
    asked = orders.select("o_custkey").distinct().select("o_custkey", F.explode(F.sequence(F.lit(2001), F.lit(2004))).alias("y"))
    pages = scans.children(listing.withColumn("at", F.col("path")), asked.select(_text("/c/", _c(), "/", F.col("y").cast("string")).alias("link")), "path")
    return html.anchors(pages, "html", ["at"]).select(F.regexp_extract("href", r"(\d+)$", 1).cast("long").alias("o_orderkey"), F.col("at").alias("path"))


@query("SELECT c AS o_custkey, m AS month FROM (SELECT DISTINCT o_custkey AS c, date_trunc('month', o_orderdate)::DATE AS m FROM orders) WHERE (c, m) NOT IN (SELECT (o_custkey, date_trunc('month', o_orderdate)::DATE) FROM orders WHERE o_orderkey % 4 = 0)")
def scan_calendar_walk(spark, sf_dir):
    """All months from the first meeting's to the last one's, each with its calendar page, less those that an earlier run has seen."""
    pages = table(spark, sf_dir, "orders").select("o_custkey", F.trunc(_day(), "month").alias("month"), "o_orderkey")
    months = pages.agg(F.min("month").alias("a"), F.max("month").alias("b")).select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month"))
    walked = pages.select("o_custkey", "month").distinct().join(F.broadcast(months), "month")  # a row a month
    return walked.join(pages.filter("o_orderkey % 4 = 0").select("o_custkey", "month").distinct(), ["o_custkey", "month"], "left_anti").select("o_custkey", "month")


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS old FROM events) WHERE old = 0")
def scan_offset_paging(spark, sf_dir):
    """Pages of twenty, read until the first link that is too old; what follows on later pages is not read."""
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    paged = table(spark, sf_dir, "events").withColumn("page_no", F.floor(nth / 20)).withColumn("pos", nth % 20)
    return ordered.until_first_old(paged, F.col("event_type") == "error", ["user_id"], ["page_no", "pos"]).select("user_id", "event_id")


@query("SELECT c_custkey, min(id) AS unit_id FROM (SELECT c_custkey, n_nationkey AS id FROM customer LEFT JOIN nation ON n_name = CASE WHEN c_custkey % 5 = 0 THEN 'nowhere' ELSE 'NATION_' || c_nationkey END AND n_regionkey = c_custkey % 5) GROUP BY 1")
def scan_unit_lookup(spark, sf_dir):
    """The first unit with just this name and class, or none."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 5 == 0, "nowhere").otherwise(_text("NATION_", F.col("c_nationkey").cast("string"))).alias("name"), (F.col("c_custkey") % 5).alias("class"))
    units = table(spark, sf_dir, "nation").groupBy(F.col("n_name").alias("name"), F.col("n_regionkey").cast("long").alias("class")).agg(F.min("n_nationkey").alias("unit_id"))
    return rows.join(units, ["name", "class"], "left").select("c_custkey", "unit_id")


@query(f"SELECT k AS o_orderkey, d AS day FROM {O} WHERE k % 3 <> 2 AND k % 7 <> 0 AND d >= DATE '1995-06-01'")
def scan_category_meetings(spark, sf_dir):
    """Categories that matter, their agenda links, and the meetings' pages, whose titles must hold a date that counts."""
    category = F.element_at(F.lit(["Gemeenteraad", "Raad voor maatschappelijk welzijn", "Feesten"]), (F.col("o_orderkey") % 3 + 1).cast("int"))
    orders = table(spark, sf_dir, "orders")
    listing = _pages(orders.withColumn("category", category), ["o_custkey", "category"], _text('<a href="https://h.be/agenda/', _uuid(_k()), '">x</a><a href="https://h.be/agenda/overzicht">y</a>'))
    pages = orders.select("o_orderkey", _text("https://h.be/agenda/", _uuid(_k())).alias("path"), _text("<title>Raad ", F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(_text(F.date_format(_day(), "d"), " ", _month(dates.DUTCH), " ", F.date_format(_day(), "yyyy"))), "</title>").alias("html"))
    wanted = listing.filter(F.lower("category").contains("raad"))
    links = scans.two_part_links(html.anchors(wanted, "html", ["o_custkey"]).withColumnRenamed("href", "link"), F.lit("h.be")).select("link").distinct()
    found = html.elements(scans.children(pages, links), "html", ["o_orderkey"], ("title",))
    return found.select("o_orderkey", dates.parsed(F.col("text"), "dutch_title").alias("day")).filter(F.col("day") >= _limit())


@query("SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS nr, 'Punt ' || l_linenumber AS item FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) WHERE l_linenumber % 3 <> 0")
def scan_agenda_items(spark, sf_dir):
    """Items between the agenda's heading and the marker after it; very short ones are none."""
    n = F.col("l_linenumber").cast("string")
    item = F.when(F.col("l_linenumber") % 3 == 0, "<li>x</li>").otherwise(_text("<li>Punt ", n, "</li>"))
    lines, of = _lines(spark, sf_dir)
    rows = lines.groupBy("l_orderkey", "l_linenumber").agg(F.first(item).alias("item"))
    pages = _pages(rows, ["l_orderkey"], F.col("item"), "l_linenumber", "<ul><li>Menu</li></ul><h2>Agenda van de zitting</h2><ol>", "</ol><h2>Bijlagen</h2><ul><li>Bijlage</li></ul>")
    return scans.items_under_heading(spread(html.flow(pages, "html", ["l_orderkey"], attributes=()), of, "l_orderkey"), ["l_orderkey"], "agenda", "bijlagen")


SITES = [("www.h0.be", "Nul", r"/files/.*\.pdf"), ("h1.be", "Een", r"(?i)/PV/[0-9]+"), ("h2.be", "Twee", r"\?id=\d*7$")]


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Nul' WHEN 1 THEN 'Een' ELSE 'Twee' END AS name FROM orders WHERE (o_orderkey % 4 = 0 AND o_orderkey % 3 = 0) OR (o_orderkey % 4 = 1 AND o_orderkey % 3 = 1) OR (o_orderkey % 4 = 2 AND o_orderkey % 3 = 2 AND o_orderkey % 10 = 7)")
def site_patterns(spark, sf_dir):
    """Each site's own pattern for its links; sites without settings bring nothing."""
    path = F.when(F.col("o_orderkey") % 3 == 0, _text("/files/", _k(), ".pdf")).when(F.col("o_orderkey") % 3 == 1, _text("/pv/", _k())).otherwise(_text("/x?id=", _k()))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", _text("www.h", (F.col("o_orderkey") % 4).cast("string"), ".be").alias("host"), path.alias("link"))
    return scans.for_sites(rows, spark.createDataFrame(SITES, "host string, name string, pattern string")).select("o_orderkey", "name")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 4 = 3")
def link_skip_rules(spark, sf_dir):
    """Downloads of players, videos and links without an id are no documents."""
    k = F.col("o_orderkey") % 4
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k == 0, "Download de app").otherwise("Notulen").alias("label"), _text(F.when(k == 1, "https://video.example").otherwise("https://h.be"), "/f", F.when(k == 2, "").otherwise(_text("?id=", _k()))).alias("link"))
    return scans.without_noise(rows, ("video.example",)).select("o_orderkey")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN c_custkey % 2 = 0 ELSE false END AS reachable FROM customer")
def probe_results(spark, sf_dir):
    """What a probe said of each entity; those that were not probed stay unknown."""
    rows, k = table(spark, sf_dir, "customer").select("c_custkey"), F.col("c_custkey")
    results = rows.filter("c_custkey % 3 <> 0").select("c_custkey", F.when(k % 3 == 1, F.when(k % 2 == 0, 200).otherwise(404)).alias("status"), F.when(k % 3 == 2, "timeout").alias("error"))
    return scans.probed(rows, results, "c_custkey").select("c_custkey", "reachable")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '/f/' || o_orderkey END AS target, CASE WHEN o_orderkey % 3 = 1 THEN 'text ' || o_orderkey END AS inline FROM orders WHERE o_orderkey % 3 < 2")
def file_references(spark, sf_dir):
    """Minutes by their file, else by what they hold themselves; with neither there is nothing to store."""
    orders, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    rows = orders.select("o_orderkey", F.when(k % 3 != 1, k).alias("file_id"), F.when(k % 3 < 2, _text("text ", _k())).alias("inline"))
    files = orders.filter("o_orderkey % 3 = 0").select(k.alias("id"), _text("/f/", _k()).alias("link"))
    return scans.with_bodies(rows, files).select("o_orderkey", "target", "inline")


@query(f"SELECT c AS o_custkey, string_agg('<section><h2>' || kind || '</h2>' || cards || '</section>', '' ORDER BY first) AS html FROM (SELECT c, coalesce(kind, 'Overig') AS kind, min(k) AS first, string_agg('<div class=\"card\"><a href=\"' || link || '\">' || k || '</a> ' || strftime(d, '%Y-%m-%d') || '</div>', '' ORDER BY d DESC, k DESC) AS cards FROM (SELECT *, CASE k % 3 WHEN 0 THEN 'Raad' WHEN 1 THEN 'College' END AS kind, CASE WHEN k % 2 = 0 THEN 'out/' || k ELSE '/u/' || k END AS link FROM {O}) GROUP BY 1, 2) GROUP BY 1")
def card_report(spark, sf_dir):
    """Cards by group in the order in which groups come up, newest first; local files before links."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "Raad").when(F.col("o_orderkey") % 3 == 1, "College").alias("kind"), F.date_format(_day(), "yyyy-MM-dd").alias("day"), _text("/u/", _k()).alias("url"), F.when(F.col("o_orderkey") % 2 == 0, _text("out/", _k())).alias("local"), _k().alias("name"))
    return reports.card_report(rows, ["o_custkey"], "kind", "day", "o_orderkey", F.col("name"), F.coalesce("local", "url"))


@query(f"SELECT c AS o_custkey, '<h1>' || c || '</h1>' || coalesce(string_agg(CASE WHEN k % 2 = 0 THEN '<p class=\"' || CASE k % 3 WHEN 0 THEN 'projet' WHEN 1 THEN 'definitif' ELSE 'unknown' END || '\">' || k || '</p>' END, '' ORDER BY k), '<p>geen</p>') || '<h2>' || count(*) FILTER (WHERE k % 2 = 0) || ' besluiten, ' || count(*) FILTER (WHERE k % 2 = 1) || ' publicaties</h2>' || coalesce(string_agg(CASE WHEN k % 2 = 1 THEN '<p>' || k || '</p>' END, '' ORDER BY k), '<p>geen</p>') AS html FROM {O} GROUP BY 1")
def entity_report(spark, sf_dir):
    """Decisions with the class of their status, publications, and their counts; an empty section says so."""
    status = F.element_at(F.lit(["projet", "definitif", "voorlopig"]), (F.col("o_orderkey") % 3 + 1).cast("int"))
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", status.alias("status"), (F.col("o_orderkey") % 2 == 0).alias("decision"), _k().alias("name"))
    return reports.entity_report(rows, "o_custkey", "decision", "status", "name", "o_orderkey")
