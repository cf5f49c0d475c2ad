"""Details of pages and reports: cards, agendas, attachments, titles, orders; over pages that are made from whole tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gavel.functions import dates, filters, names
from gavel.operators import reports, scans
from gavel.plans.scans import O, _c, _customers, _day, _flow, _k, _limit, _lines, _month, _pages, _text
from gavel.registry import query
from gavel.session import spread, table
from gavel.sources import html

KEYS = ["o_custkey"]


@query(f"SELECT c AS o_custkey, '/d/' || k || '.pdf' AS link, CASE WHEN k % 2 = 0 THEN CAST(k AS VARCHAR) ELSE 'PV ' || k END AS name, d AS day FROM {O} WHERE k % 3 <> 0 AND k % 5 <> 0 AND d >= DATE '1995-06-01' AND (k % 2 = 1 OR contains(CAST(k AS VARCHAR), '4'))")
def scan_classed_cards(spark, sf_dir):
    """Documents in cards of several classes with a machine date; by name or link, each once."""
    k = F.col("o_orderkey")
    css = F.when(k % 3 == 0, "card wide").otherwise("node card meeting-card")
    time = F.when(k % 5 == 0, '<time class="datetime" datetime="soon">x</time>').otherwise(_text('<time datetime="1999-09-09">x</time><time class="datetime" datetime="', F.date_format(_day(), "yyyy-MM-dd"), 'T10:00:00Z">x</time>'))
    file = _text('<a href="/d/', _k(), '.pdf">', F.when(k % 2 == 0, "").otherwise(_text("PV ", _k())), "</a>")
    card = _text('<div class="', css, '">', time, "<p>", file, file, '<a href="/page">PV page</a></p></div><a href="/outside.pdf">PV</a>')
    return scans.dated_cards(_flow(spark, sf_dir, card, ("class", "href", "datetime")), KEYS, ["card", "meeting-card"], _limit(), ["pv", "4"])


@query(f"SELECT 'decision' AS kind, c AS o_custkey, 'B ' || k AS title, '/b/' || k AS link, CASE WHEN k % 2 = 0 THEN 'projet' ELSE 'definitief' END AS status FROM {O} WHERE k % 3 = 0 UNION ALL SELECT 'publication', c, 'P ' || k, '/p/' || k, NULL FROM {O} WHERE k % 3 = 1")
def scan_item_cards(spark, sf_dir):
    """Decisions and publications in one table: publications have a title and a link only; cards without a link go."""
    k = F.col("o_orderkey")
    orders, n = _customers(spark, sf_dir)
    status = F.when(k % 2 == 0, "projet").otherwise("definitief")
    decision = F.when(k % 3 == 0, _text('<div class="item-card"><h3>B ', _k(), '</h3><a href="/b/', _k(), '">x</a><dl><dt>Status</dt><dd>', status, "</dd></dl></div>")).otherwise("")
    publication = F.when(k % 3 == 1, _text('<div class="item-card x"><a href="/p/', _k(), '">P ', _k(), '</a><a href="/q">q</a></div>')).otherwise('<div class="item-card">none</div>')
    one = html.cards(_pages(orders, KEYS, decision), "html", KEYS, "item-card").select(F.lit("decision").alias("kind"), *KEYS, "title", "link", F.col("fields")["Status"].alias("status"))
    two = scans.publication_cards(spread(html.flow(_pages(orders, KEYS, publication), "html", KEYS, attributes=("class", "href")), n, *KEYS), KEYS).withColumn("kind", F.lit("publication"))
    return one.unionByName(two, allowMissingColumns=True)


@query("SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS nr, 'Punt ' || l_linenumber AS item FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber % 3 <> 0)")
def scan_agenda_forms(spark, sf_dir):
    """Agendas as lists, and for every second page as lines between two markers; short lines are none."""
    n = F.col("l_linenumber").cast("string")
    said = F.when(F.col("l_linenumber") % 3 == 0, "x").otherwise(_text("Punt ", n))
    own, of = _lines(spark, sf_dir)
    rows = own.groupBy("l_orderkey", "l_linenumber").agg(F.first(said).alias("said"))
    listed = _pages(rows.filter("l_orderkey % 2 = 0"), ["l_orderkey"], _text("<li>", F.col("said"), "</li>"), "l_linenumber", "<h2>Agendapunten</h2><ol>", "</ol><h2>Bijlagen</h2><ul><li>Bijlage</li></ul>")
    lines = _pages(rows.filter("l_orderkey % 2 = 1"), ["l_orderkey"], _text("<p>", F.col("said"), "</p>"), "l_linenumber", "<p>Welkom op deze site</p><b>Agendapunten</b>", "<b>Inloggen</b><p>Contacteer ons</p>")
    flow = spread(html.flow(listed.unionByName(lines), "html", ["l_orderkey"]), of, "l_orderkey")
    return scans.agenda_items(flow, ["l_orderkey"], "agendapunten", ["Bijlagen", "iBabs", "Inloggen"])


@query(f"SELECT k AS o_orderkey, 'Nota ' || k AS label, CASE WHEN k % 3 = 0 THEN 'https://h.be/Agenda/Document/9?documentId=' || k ELSE 'https://h.be/Document/LoadAgendaItemDocument/' || k || '?agendaItemId=' || c END AS target FROM {O} WHERE k % 4 <> 0")
def agenda_attachments(spark, sf_dir):
    """Attachments by the ids in their links; without both ids the link itself is kept."""
    item = F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(_text("&amp;agendaItemId=", _c()))
    label = F.when(F.col("o_orderkey") % 4 == 0, "").otherwise(_text("Nota ", _k()))
    pages = table(spark, sf_dir, "orders").select("o_orderkey", _text('<a href="/Agenda/Document/9?documentId=', _k(), item, '">', label, '</a><a href="/Agenda/9">Agenda</a>').alias("html"))
    found = html.anchors(pages, "html", ["o_orderkey"]).withColumnRenamed("href", "link")
    return scans.attachments(found, F.lit("https://h.be")).select("o_orderkey", "label", "target")


@query(f"SELECT c AS o_custkey, CASE WHEN k % 3 = 0 THEN '' WHEN k % 3 = 1 THEN k || '.' ELSE k || 'a' END AS nr, substr(CASE WHEN k % 3 = 0 THEN 'Punt zonder nummer ' || k ELSE 'Titel ' || k || repeat(' lang', CAST(k % 90 AS INT)) END, 1, 300) AS title FROM {O}")
def semantic_agenda(spark, sf_dir):
    """Agenda items as typed nodes, with a number, a letter after it or none; long titles are cut."""
    k = F.col("o_orderkey")
    title = _text("Titel ", _k(), F.repeat(F.lit(" lang"), (k % 90).cast("int")))
    said = F.when(k % 3 == 0, _text("Punt zonder nummer ", _k())).when(k % 3 == 1, _text(_k(), ". ", title)).otherwise(_text(_k(), "a ", title))
    value = F.when(k % 2 == 0, _text('<dd content="', said, '">anders</dd>')).otherwise(_text("<dd>", said, "</dd>"))
    flow = _flow(spark, sf_dir, _text('<dl typeof="besluit:Agendapunt"><dt>Titel</dt>', value, "<dd>meer</dd></dl><dl><dd>1. anders</dd></dl>"), ("typeof", "content"))
    return scans.semantic_items(flow, KEYS).select("o_custkey", "nr", "title")


@query(f"SELECT k AS o_orderkey, CASE k % 5 WHEN 0 THEN 'pdf' WHEN 1 THEN 'word' WHEN 2 THEN 'word' ELSE 'unknown' END AS kind, CASE WHEN k % 2 = 0 THEN 'Stuk ' || k ELSE CASE k % 5 WHEN 0 THEN 'document.pdf' WHEN 1 THEN 'document.docx' WHEN 2 THEN 'document.doc' ELSE 'document' END END AS name, 'https://h.be/' || k || CASE k % 5 WHEN 0 THEN '.PDF?x' WHEN 1 THEN '.docx' WHEN 2 THEN '.doc' ELSE '/download' END AS target FROM {O} WHERE k % 5 <> 4")
def document_finder(spark, sf_dir):
    """Links to documents by what their addresses hold, with usual names where they have no text."""
    k = F.col("o_orderkey")
    ending = F.when(k % 5 == 0, ".PDF?x").when(k % 5 == 1, ".docx").when(k % 5 == 2, ".doc").when(k % 5 == 3, "/download").otherwise("/page")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", _text("/", _k(), ending).alias("link"), F.when(k % 2 == 0, _text("Stuk ", _k())).otherwise(" ").alias("label"))
    return scans.found_documents(rows, F.lit("https://h.be/map/pagina")).select("o_orderkey", "kind", "name", "target")


@query(f"SELECT c AS o_custkey, 'https://h.be/download.ashx?id=' || k AS link, CASE WHEN k % 4 <> 0 THEN d END AS day FROM {O} WHERE k % 3 <> 0 AND (k % 4 = 0 OR d >= DATE '1995-06-01')")
def static_downloads(spark, sf_dir):
    """A static list: downloads once each, dated by their text, undated ones kept."""
    said = F.when(F.col("o_orderkey") % 4 == 0, "zonder datum").otherwise(_text("notulen-", F.date_format(_day(), "d"), "-", _month(dates.DUTCH), "-", F.date_format(_day(), "yyyy")))
    path = F.when(F.col("o_orderkey") % 3 == 0, "/page?id=").otherwise("/download.ashx?id=")
    link = _text('<a href="https://h.be', path, _k(), '">', said, "</a>")
    found = html.anchors(_pages(table(spark, sf_dir, "orders"), KEYS, _text(link, link)), "html", KEYS).withColumnRenamed("href", "link")
    return scans.direct_downloads(found, KEYS, _limit(), "dutch_tail").select("o_custkey", "link", "day")


@query(
    "SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'Raad ' || page_id WHEN 1 THEN 'Kop ' || page_id ELSE 'm' || page_id END AS title, 'Zitting ' || page_id AS bare, 'Agenda ' || page_id AS undated, CASE WHEN page_id % 4 < 2 THEN 'Kop ' || page_id END AS heading FROM pages"
)
def title_forms(spark, sf_dir):
    """Titles without the site's name, else the heading without its links, else the last segment; without remarks and dates."""
    k, n = F.col("page_id"), F.col("page_id").cast("string")
    title = F.when(k % 4 == 0, _text("Raad ", n, " | Town op Portal.NET")).when(k % 4 == 1, " - portal").otherwise("")
    page = F.when(k % 4 < 2, _text('<h1 class="x"><a href="/">Terug</a> Kop <b>', n, "</b></h1>")).otherwise("<p>x</p>")
    rows = table(spark, sf_dir, "pages").select("page_id", title.alias("t"), page.alias("h"), _text("https://h.be/v/m", n, "/").alias("u"), n.alias("n"))
    heading = names.heading_text(F.col("h"))
    return rows.select("page_id", names.page_title(F.col("t"), heading, F.col("u"), "portal").alias("title"), names.without_remark(_text("Zitting ", F.col("n"), " (openbaar) ")).alias("bare"), scans.without_date(_text("Agenda ", F.col("n"), " 12/03/2024")).alias("undated"), heading.alias("heading"))


@query(
    f"SELECT k AS o_orderkey, CASE WHEN k % 3 = 0 THEN d END AS first, CASE WHEN k % 3 = 1 THEN d END AS meeting, CASE WHEN k % 4 < 2 THEN d WHEN k % 4 = 2 THEN DATE '2001-02-03' END AS text_first, CASE WHEN k % 4 = 0 THEN d WHEN k % 4 <> 3 THEN CASE WHEN k % 4 = 1 THEN d ELSE DATE '2001-02-03' END END AS file_first FROM (SELECT o_orderkey AS k, CAST(CAST(o_orderdate AS DATE) + INTERVAL 10 YEAR AS DATE) AS d FROM orders)"
)
def date_forms(spark, sf_dir):
    """Slash dates that must come first, or after "séance du"; French text before or after the file name's date."""
    k, day = F.col("o_orderkey"), F.add_months(_day(), 120)
    slash = F.date_format(day, "dd/MM/yyyy")
    said = F.when(k % 3 == 0, slash).when(k % 3 == 1, _text("Séance du ", slash)).otherwise(_text("le ", slash))
    spoken = F.concat(F.date_format(day, "d "), dates.month_name(F.month(day), dates.FRENCH), F.date_format(day, " yyyy"))
    text = F.when(k % 4 < 2, spoken).otherwise("sans date")
    stem = F.when(k % 4 == 0, F.date_format(day, "'pv-'yyyy-MM-dd")).when(k % 4 == 1, F.date_format(day, "'pv-'yyyy-MM-dd")).when(k % 4 == 2, "pv-2001-02-03").otherwise("pv")
    p = lambda c, rules: dates.parsed(c, rules)
    return table(spark, sf_dir, "orders").select("o_orderkey", p(said, "slash_first").alias("first"), p(said, "slash_meeting").alias("meeting"), F.coalesce(p(text, "french_text"), p(stem, "file_stem")).alias("text_first"), F.coalesce(p(stem, "file_stem"), p(text, "french_text")).alias("file_first"))


@query(f"SELECT c AS o_custkey, k AS o_orderkey, row_number() OVER (PARTITION BY c ORDER BY CASE WHEN k % 4 <> 0 THEN d END DESC NULLS LAST, k) AS nth, row_number() OVER (PARTITION BY c ORDER BY ['Zee', 'Écluse', 'abdij', 'Abdij', 'École'][k % 5 + 1], k) AS by_name FROM {O}")
def listing_orders(spark, sf_dir):
    """Newest first with undated ones last and ties as they came; names by code point, so that marks come after z."""
    k = F.col("o_orderkey")
    day, name = F.when(k % 4 != 0, _day()), F.element_at(F.lit(["Zee", "Écluse", "abdij", "Abdij", "École"]), (k % 5 + 1).cast("int"))
    nth = lambda *order: F.row_number().over(Window.partitionBy("o_custkey").orderBy(*order))
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", nth(day.desc_nulls_last(), k).alias("nth"), nth(name, k).alias("by_name"))


_AGENDA = """'<li>' || CASE WHEN {n} AND l_linenumber % 2 = 1 THEN '<strong>' || l_linenumber || '.</strong> ' ELSE '' END || 'Punt &lt;' || l_linenumber || '&gt;</li>'"""


@query(f"SELECT l_orderkey, '<ol class=\"agenda\">' || string_agg({_AGENDA.format(n='true')}, '' ORDER BY l_linenumber) || '</ol>' AS numbered, '<ul class=\"agenda\">' || string_agg({_AGENDA.format(n='false')}, '' ORDER BY l_linenumber) || '</ul>' AS plain FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) GROUP BY 1")
def agenda_lists(spark, sf_dir):
    """Agenda items as HTML lists, with their numbers or without."""
    n = F.col("l_linenumber").cast("string")
    item = F.struct(F.col("l_linenumber").alias("at"), F.when(F.col("l_linenumber") % 2 == 1, _text(n, ".")).alias("nr"), _text("Punt <", n, ">").alias("title"))
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_set(item)).alias("items"))
    return rows.select("l_orderkey", reports.agenda_html(F.col("items"), True).alias("numbered"), reports.agenda_html(F.col("items")).alias("plain"))


@query(
    """SELECT o_orderkey, '<article><h3 class="' || CASE o_orderstatus WHEN 'F' THEN 'projet' WHEN 'O' THEN 'unknown' ELSE 'definitif' END || '">Besluit ' || o_orderkey || '</h3><table><tr><th>Nr</th><td>' || o_orderkey || '</td></tr>' || CASE WHEN o_orderkey % 2 = 0 THEN '<tr><th>Orgaan</th><td>' || o_orderpriority || '</td></tr>' ELSE '' END || '</table>' || CASE WHEN o_orderkey % 3 = 0 THEN '<p>geen documenten</p>' ELSE '<div><a class="' || CASE WHEN o_orderkey % 3 = 1 THEN 'local" href="f/' || o_orderkey ELSE 'external" href="https://h.be/' || o_orderkey END || '.pdf">PV &amp; nota</a></div>' END || '</article>' AS html FROM orders"""
)
def decision_cards(spark, sf_dir):
    """Decisions with a class for their status, rows for the values that are not empty, and document links or a word that there are none."""
    k, n = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    status = F.when(F.col("o_orderstatus") == "F", "projet").when(F.col("o_orderstatus") == "O", "definitief").otherwise("definitif")
    document = F.struct(F.lit("PV & nota").alias("name"), _text("https://h.be/", n, ".pdf").alias("url"), F.when(k % 3 == 1, _text("f/", n, ".pdf")).alias("local"))
    documents = F.filter(F.array(document), lambda d: k % 3 != 0)
    fields = {"Nr": n, "Orgaan": F.when(k % 2 == 0, F.col("o_orderpriority")), "Leeg": F.lit("")}
    return table(spark, sf_dir, "orders").select("o_orderkey", reports.decision_card(_text("Besluit ", n), status, fields, documents).alias("html"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'CON' WHEN p_partkey % 4 = 1 THEN 'a_b_' || p_partkey WHEN p_partkey % 4 = 2 THEN 'document' ELSE p_name END AS name FROM part")
def sanitize_weakly(spark, sf_dir):
    """The older sink's names: reserved ones stay."""
    k = F.col("p_partkey")
    raw = F.when(k % 4 == 0, "CON").when(k % 4 == 1, _text(" ._a<>/b|", k.cast("string"), "_. ")).when(k % 4 == 2, "...").otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", names.sanitise_weakly(raw).alias("name"))


@query("SELECT c_custkey, list_contains(['gemeenteraad', 'vast bureau', 'verslag'], lower(said)) AS relevant, contains('conseil communal de x cpas', term) AS matched FROM (SELECT c_custkey, ['Gemeenteraad', 'Vast Bureau', 'Feest', 'Verslag', 'Markt'][c_custkey % 5 + 1] AS said, ['conseil communal', 'collège', 'cpas', 'onbekend'][c_custkey % 4 + 1] AS term FROM customer)")
def fixed_terms(spark, sf_dir):
    """Categories that a listing must name, and organs by their names in another language."""
    k = F.col("c_custkey")
    said = F.element_at(F.lit(["Gemeenteraad", "Vast Bureau", "Feest", "Verslag", "Markt"]), (k % 5 + 1).cast("int"))
    organ = lambda term: filters.organ_translated(F.lit("Conseil communal de X CPAS"), term, filters.DUTCH_TO_FRENCH)
    matched = F.when(k % 4 == 0, organ("Gemeenteraad")).when(k % 4 == 1, organ("college")).when(k % 4 == 2, organ("OCMW")).otherwise(organ("onbekend"))
    return table(spark, sf_dir, "customer").select("c_custkey", filters.any_term([said], filters.CATEGORIES).alias("relevant"), matched.alias("matched"))
