"""Scans of page structure: rows, headings, lists and containers, on the elements that `html.flow` gives.

All take elements (keys, pos, last, tag, attrs, text) and return links with what their place on the page says about
them. Scopes are pages, so windows are as small as a page; nothing is collected over a table. Elements that a scan does
not look at go first, so that they are neither shuffled nor sorted, and windows are in one order where that is possible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavel.functions import dates, filters, urls
from gavel.operators import lookups, ordered


# fixed values: where a portal's attachments are named and where they lie, a path of downloads, the type of an agenda item
ATTACHMENT, ATTACHED = "/Agenda/Document/", "/Document/LoadAgendaItemDocument/"
DOWNLOAD = "/download.ashx"
AGENDA_ITEM = "besluit:Agendapunt"


def _href() -> Column:
    return F.col("attrs")["href"]


def _first_link(of: Column | None = None) -> Column:
    """The first link of a group, of the rows that `of` holds for."""
    counts = F.col("link").isNotNull() if of is None else F.col("link").isNotNull() & of
    return F.min_by("link", F.when(counts, F.col("pos")))


def is_link(ending: str = "") -> Column:
    """Anchors with a target, whose path ends in `ending`."""
    any_path = (F.col("tag") == "a") & _href().isNotNull()
    return any_path & F.lower(urls.path_key(_href())).endswith(ending) if ending else any_path


def _told(flow: DataFrame, ending: str = "", **more: Column) -> DataFrame:
    """flow with `link`, the target of what is_link holds for, and more columns in place of its attributes: windows copy
    whole rows, and a map is most of one."""
    return flow.withColumns({"link": F.when(is_link(ending), _href()), **more}).drop("attrs")


def _whole(keys: list[str]):
    return Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def rows_of_tables(flow: DataFrame, keys: list[str], cells: tuple[str, ...] = ("td",)) -> DataFrame:
    """Rows, cells and anchors of flow with `row` (number of the table row that an element lies in, from 1) and `cell` (of
    the cell in it). A cell's number is told from the cells before its row, so that all is in the order of pages."""
    is_row = F.col("tag") == "tr"
    rows = ordered.counted(flow.filter(F.col("tag").isin("tr", "a", *cells)), {"row": is_row, "__cells": F.col("tag").isin(*cells)}, keys, ["pos"])
    rows = ordered.carried_forward(rows, F.when(is_row, F.col("__cells")), keys, ["pos"], "__before")
    return rows.filter("row > 0").withColumn("cell", F.col("__cells") - F.col("__before")).drop("__cells", "__before")


def date_first_rows(flow: DataFrame, keys: list[str], limit: Column, ending: str = ".pdf") -> DataFrame:
    """link, name, day: documents in rows whose first cell, a heading or not, is a date at or after limit.

    A link that is called nothing or "pdf" is named after its file.
    """
    is_first = F.col("tag").isin("td", "th") & (F.col("cell") == 1)
    rows = rows_of_tables(_told(flow, ending), keys, ("td", "th")).filter(is_first | F.col("link").isNotNull())
    first = F.first(F.when(is_first, F.col("text")), ignorenulls=True).over(_whole([*keys, "row"]))
    found = rows.withColumn("__said", first).filter("link is not null").withColumn("day", dates.parsed(F.col("__said"), "slash")).filter(F.col("day") >= limit)
    name = F.when(F.lower("text").isin("", "pdf"), urls.stem(F.col("link"))).otherwise(F.col("text"))
    return found.select(*keys, "link", name.alias("name"), "day")


def positional_rows(flow: DataFrame, keys: list[str], parameter: str, title: int = 3, day: int = 4) -> DataFrame:
    """key, title, date_text of rows that have enough cells; the first row of each key (a query parameter of its link) counts."""
    is_cell = F.col("tag") == "td"
    rows = rows_of_tables(_told(flow), keys).filter((is_cell & F.col("cell").isin(title, day)) | F.col("link").isNotNull())
    text = lambda n: F.max(F.when(is_cell & (F.col("cell") == n), F.col("text")))
    own = rows.groupBy(*keys, "row").agg(F.max("cell").alias("cells"), _first_link().alias("link"), text(title).alias("title"), text(day).alias("date_text"))
    own = own.filter(F.col("cells") >= max(title, day)).withColumn("key", urls.query_parameter(F.col("link"), parameter)).filter("key is not null")
    return ordered.first_occurrence(own, ["key"], ["row"], keys).select(*keys, "key", "title", "date_text")


def attribute_rows(flow: DataFrame, keys: list[str], attribute: str, patterns: dict[str, str], limit: Column, cells: tuple[int, ...] = (1, 2)) -> DataFrame:
    """link, day and the parts that patterns read from an attribute of the row; one part, `stamp`, holds Unix seconds.

    The link is that of the first of `cells` that has one. Rows before limit, or without a stamp, go.
    """
    rows = rows_of_tables(_told(flow, said=F.when(F.col("tag") == "tr", F.col("attrs")[attribute])), keys)
    rows = rows.filter(F.col("said").isNotNull() | (F.col("link").isNotNull() & F.col("cell").isin(*cells)))
    link = F.coalesce(*(_first_link(F.col("cell") == c) for c in cells))
    own = rows.groupBy(*keys, "row").agg(F.max("said").alias("said"), link.alias("link")).filter("said is not null and link is not null")
    parts = own.select(*keys, "row", "link", *(F.nullif(F.regexp_extract("said", p, 1), F.lit("")).alias(n) for n, p in patterns.items()))
    return parts.withColumn("day", F.timestamp_seconds(F.col("stamp").cast("long")).cast("date")).filter(F.col("day") >= limit).drop("stamp", "row")


def first_links(flow: DataFrame, keys: list[str], heading: str, rules: str, ending: str = ".pdf") -> DataFrame:
    """day, link: for each heading with a date the first document before the next heading."""
    is_heading = F.col("tag") == heading
    rows = ordered.sections(_told(flow, ending).filter(is_heading | F.col("link").isNotNull()), is_heading, keys, ["pos"]).filter("section > 0")
    own = rows.groupBy(*keys, "section").agg(F.max(F.when(is_heading, F.col("text"))).alias("said"), _first_link().alias("link"))
    return own.withColumn("day", dates.parsed(F.col("said"), rules)).filter("day is not null and link is not null").select(*keys, "section", "day", "link")


def year_lists(flow: DataFrame, keys: list[str], limit: Column, ending: str = ".pdf") -> DataFrame:
    """link, day: documents in list items "D month ..." below headings that are years; it ends with the first year before limit."""
    year = F.when(F.col("tag") == "h3", F.regexp_extract("text", r"^\s*(\d{4})\s*$", 1))
    told = _told(flow).filter(F.col("tag").isin("h3", "li") | F.col("link").isNotNull())  # paths are looked at once, last
    rows = ordered.carried_forward(told, year, keys, ["pos"], "year").filter("year <> ''")
    rows = ordered.until_first_old(rows, F.make_date(F.col("year").cast("int"), F.lit(12), F.lit(31)) < limit, keys, ["pos"])
    item = F.struct(F.col("last").alias("end"), F.col("text").alias("said"))
    rows = ordered.carried_forward(rows, F.when(F.col("tag") == "li", item), keys, ["pos"], "item").filter((F.col("pos") <= F.col("item.end")) & F.lower(urls.path_key(F.col("link"))).endswith(ending))
    said = F.concat_ws(" ", F.regexp_extract("item.said", r"^\s*(\d{1,2})", 1), F.regexp_extract("item.said", r"^\s*\d{1,2}(?:er)?\s+(\p{L}+)", 1), "year")
    return rows.withColumn("day", dates.parsed(said, "spoken_french")).filter(F.col("day") >= limit).select(*keys, "link", "day")


def inherited_dates(flow: DataFrame, keys: list[str], prefix: str, headings: tuple[str, ...] = ("h2", "h3", "h4", "strong", "b")) -> DataFrame:
    """link, name, day, doc_type: links below prefix, with the date of the heading above them, else that of their file name.

    Links to pages, and those called nothing or HTML, are left out.
    """
    day = F.when(F.col("tag").isin(*headings), dates.parsed(F.col("text"), "dutch_heading"))
    wanted = is_link() & _href().startswith(prefix) & ~F.upper("text").isin("", "HTML") & ~is_link(".html")
    told = _told(flow.filter(F.col("tag").isin(*headings) | wanted), wanted=wanted)
    rows = ordered.carried_forward(told, day, keys, ["pos"], "above").filter("wanted")
    own = F.coalesce("above", dates.parsed(urls.last_segment(F.col("link")), "iso"))
    return rows.select(*keys, "link", F.col("text").alias("name"), own.alias("day"), filters.document_type(F.col("text")).alias("doc_type"))


def in_container(flow: DataFrame, keys: list[str], containers: list[str], limit: Column, heading: str = "h3") -> DataFrame:
    """link, day: links with a date heading above them, in the first of the containers (ids) that a page has."""
    rank = F.array_position(F.lit(containers), F.col("attrs")["id"])
    best = F.first(F.when(rank > 0, F.struct(rank.alias("rank"), F.col("pos").alias("from"), F.col("last").alias("to"))), ignorenulls=True)
    ordered_by_rank = Window.partitionBy(*keys).orderBy(F.when(rank > 0, rank).asc_nulls_last(), "pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = flow.withColumn("box", best.over(ordered_by_rank)).filter("pos > box.from and pos <= box.to")
    rows = ordered.carried_forward(rows, F.when(F.col("tag") == heading, dates.parsed(F.col("text"), "slash")), keys, ["pos"], "day")
    return rows.filter(is_link() & (F.col("day") >= limit)).select(*keys, _href().alias("link"), "day")


def items_under_heading(flow: DataFrame, keys: list[str], title: str, end: str, least: int = 3) -> DataFrame:
    """nr, item: what the list after a heading holds, up to an end marker; texts of `least` characters or fewer are no items."""
    begins, ends = F.col("tag").isin("h2", "h3") & F.lower("text").contains(title), F.lower("text").contains(end) & (F.col("tag") != "body")
    is_item = (F.col("tag") == "li") & (F.length("text") > least)
    rows = ordered.counted(flow.filter(begins | ends | is_item).drop("attrs"), {"begun": begins, "ended": ends}, keys, ["pos"])
    rows = rows.filter("begun > 0 and ended = 0").filter(is_item)
    return rows.select(*keys, F.row_number().over(Window.partitionBy(*keys).orderBy("pos")).alias("nr"), F.col("text").alias("item"))


def two_part_links(links: DataFrame, site: Column, skip: tuple[str, ...] = ()) -> DataFrame:
    """links (link, ...) of the site whose path is a slug and a UUID, with slug and uuid; slugs in skip go."""
    parts = F.split(F.regexp_replace(urls.path_key(F.col("link")), r"^[a-z]+://[^/]*/?", ""), "/")
    two = links.filter((urls.host(F.col("link")) == site) & (F.size(parts) == 2)).withColumns({"slug": parts[0], "uuid": F.get(parts, 1)})
    return two.filter(urls.is_uuid(F.col("uuid")) & ~F.col("slug").isin("", *skip))


def without_date(label: Column) -> Column:
    """A label without the date at its end."""
    return F.regexp_replace(label, r"\s*\d{1,2}[/.-]\d{1,2}[/.-]\d{4}\s*$", "")


def children(pages: DataFrame, found: DataFrame, path: str = "path") -> DataFrame:
    """The pages (path, ...) that links (link, ...) lead to, each with its link's columns; pages that are not there go."""
    return found.join(pages, F.col("link") == F.col(path)).drop(path)


def year_pages(links: DataFrame, keys: list[str], since: Column, index: DataFrame) -> DataFrame:
    """link: the first link of each year from `since` on; a page without any is a listing itself (index: keys, link)."""
    years = links.filter(F.col("label").rlike(r"^20\d{2}$")).withColumn("year", F.col("label").cast("int")).filter(F.col("year") >= since)
    first = ordered.first_occurrence(years, ["year"], ["pos"], keys)
    return first.select(*keys, "year", "link").unionByName(index.join(first.select(*keys).distinct(), keys, "left_anti").select(*keys, F.lit(None).cast("int").alias("year"), "link"))


def for_sites(links: DataFrame, sites: DataFrame, host: str = "host", within: bool = False) -> DataFrame:
    """links that fit the pattern of their site (host, name, pattern), on the whole link; "www." aside. Others go.

    within: a site's host need only occur in a link's; where several do, the longest counts.
    """
    if within:
        pairs = lookups.contained(sites.select(F.col("host").alias("__part")), "__part", links, host)
        longest = pairs.groupBy(host).agg(F.max_by("__part", F.struct(F.length("__part"), F.col("__part"))).alias("__part"))
        own = sites.withColumnRenamed("host", "__part")
        return links.join(longest, host).join(own, "__part").filter("link rlike pattern").drop("__part", "pattern")
    own = sites.withColumn("__h", urls.bare_host(F.col("host"))).drop("host")
    return links.join(own, urls.bare_host(F.col(host)) == F.col("__h")).filter("link rlike pattern").drop("__h", "pattern")


def without_noise(links: DataFrame, hosts: tuple[str, ...], label: str = "label") -> DataFrame:
    """links but those that say download, go to one of the hosts (videos), or have no id."""
    return links.filter(~F.lower(label).contains("download") & ~urls.host(F.col("link")).isin(*hosts) & urls.query_parameter(F.col("link"), "id").isNotNull())


def probed(rows: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """rows with what a probe of their key said (key, status, error), and `reachable`; without a probe it is null."""
    return rows.join(results, key, "left").withColumn("reachable", F.when(F.col("status").isNotNull() | F.col("error").isNotNull(), F.coalesce(F.col("status").between(200, 399), F.lit(False))))


def with_bodies(documents: DataFrame, files: DataFrame) -> DataFrame:
    """documents (file_id, inline, ...) with `target` (the file's link, if there is one) and `inline` only where it is needed."""
    joined = documents.join(files.select(F.col("id").alias("__id"), F.col("link").alias("target")), F.col("file_id") == F.col("__id"), "left").drop("__id")
    return joined.withColumn("inline", F.when(F.col("target").isNull(), F.col("inline"))).filter("target is not null or inline is not null")


def _within(flow: DataFrame, keys: list[str], is_outer: Column, into: str = "outer") -> DataFrame:
    """Elements inside the last element that is_outer held for, with `into`: its pos and last."""
    rows = ordered.carried_forward(flow, F.when(is_outer, F.struct("pos", "last")), keys, ["pos"], into)
    return rows.filter((F.col("pos") > F.col(f"{into}.pos")) & (F.col("pos") <= F.col(f"{into}.last")))


def of_classes(classes: list[str]) -> Column:
    """Blocks that have all of some classes."""
    own = F.split(F.coalesce(F.col("attrs")["class"], F.lit("")), r"\s+")
    return (F.col("tag") == "div") & F.forall(F.lit(classes), lambda c: F.array_contains(own, c))


def dated_cards(flow: DataFrame, keys: list[str], classes: list[str], limit: Column, terms: list[str] | None = None) -> DataFrame:
    """link, name, day: documents in cards with all of the classes and a machine date at or after limit.

    Each document counts once a page; one without a text is named after its file; terms are looked for in name and link.
    """
    is_file = is_link() & F.lower(_href()).contains(".pdf")
    rows = _within(flow.filter(of_classes(classes) | (F.col("tag") == "time") | is_file), keys, of_classes(classes), "card")
    stamp = F.when((F.col("tag") == "time") & F.array_contains(F.split(F.col("attrs")["class"], r"\s+"), "datetime"), F.col("attrs")["datetime"])
    rows = rows.withColumn("stamp", F.first(stamp, ignorenulls=True).over(Window.partitionBy(*keys, "card.pos").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    found = rows.withColumn("day", F.try_to_date(F.substr("stamp", F.lit(1), F.lit(10)), "yyyy-MM-dd"))
    found = found.filter(is_file & (F.col("day") >= limit))
    found = found.select(*keys, "pos", _href().alias("link"), F.coalesce(F.nullif("text", F.lit("")), urls.stem(_href())).alias("name"), "day")
    once = ordered.first_occurrence(found, ["link"], ["pos"], keys)
    return once.filter(filters.any_term([F.col("name"), F.col("link")], terms)).drop("pos")


def publication_cards(flow: DataFrame, keys: list[str], css_class: str = "item-card") -> DataFrame:
    """title, link: the first link of each card; cards without one go."""
    told = _told(flow, is_card=of_classes([css_class])).filter(F.col("is_card") | F.col("link").isNotNull())
    rows = _within(told, keys, F.col("is_card"), "card").filter("link is not null")
    return ordered.first_of_runs(rows, F.col("card.pos"), keys, ["pos"]).select(*keys, F.col("text").alias("title"), "link")


def agenda_lines(flow: DataFrame, keys: list[str], start: str, ends: list[str], least: int = 5, longest: int = 300) -> DataFrame:
    """nr, item: texts between one that begins with `start` and the next that begins with one of `ends`, for pages whose
    agenda is no list. The texts are those of elements without others inside; up to `least` characters are none."""
    leaves = flow.filter((F.col("pos") == F.col("last")) & (F.col("text") != ""))
    rows = ordered.sections(leaves, F.col("text").rlike(f"(?i)^{start}"), keys, ["pos"], "begun").filter("begun > 0")
    rows = ordered.sections(rows, F.col("text").rlike(f"(?i)^(?:{'|'.join(ends)})"), keys, ["pos"], "ended").filter("ended = 0")
    rows = rows.filter(~F.col("text").rlike(f"(?i)^{start}") & (F.length("text") > least))
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("pos"))
    return rows.select(*keys, nth.alias("nr"), F.substr("text", F.lit(1), F.lit(longest)).alias("item"))


def agenda_items(flow: DataFrame, keys: list[str], title: str, ends: list[str], least: int = 3, shortest: int = 5, longest: int = 300) -> DataFrame:
    """nr, item: the list below the agenda's heading (`items_under_heading`), and for pages without one the texts after it
    (`agenda_lines`). Both are told in one pass over the elements, by windows of one order."""
    said, low = F.col("text"), F.lower("text")
    rows = ordered.sections(flow.select(*keys, "pos", "last", "tag", "text"), F.col("tag").isin("h2", "h3") & low.contains(title), keys, ["pos"], "__b")
    rows = ordered.sections(rows, low.contains(ends[0].lower()) & (F.col("tag") != "body"), keys, ["pos"], "__e")
    leaf, starts = (F.col("pos") == F.col("last")) & (said != ""), said.rlike(f"(?i)^{title}")
    rows = ordered.sections(rows, leaf & starts, keys, ["pos"], "__s")
    rows = ordered.sections(rows, leaf & (F.col("__s") > 0) & said.rlike(f"(?i)^(?:{'|'.join(ends)})"), keys, ["pos"], "__t")
    item = (F.col("__b") > 0) & (F.col("__e") == 0) & (F.col("tag") == "li") & (F.length("text") > least)
    line = leaf & (F.col("__s") > 0) & (F.col("__t") == 0) & ~starts & (F.length("text") > shortest)
    rows = rows.withColumns({"__item": item, "__line": line}).filter("__item or __line").withColumn("__listed", F.max("__item").over(_whole(keys)))
    rows = rows.filter(F.when(F.col("__listed"), F.col("__item")).otherwise(F.col("__line")))
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("pos"))
    return rows.select(*keys, nth.alias("nr"), F.when(F.col("__listed"), said).otherwise(F.substr("text", F.lit(1), F.lit(longest))).alias("item"))


def attachments(links: DataFrame, base: Column, path: str = ATTACHMENT, download: str = ATTACHED) -> DataFrame:
    """links (link, label, ...) to attachments, with `target`: the download that the ids in the link stand for, else the link itself."""
    document, item = (urls.query_parameter(F.col("link"), p) for p in ("documentId", "agendaItemId"))
    rebuilt = F.concat(base, F.lit(download), document, F.lit("?agendaItemId="), item)
    return links.filter(F.contains("link", F.lit(path)) & (F.trim("label") != "")).withColumn("target", F.coalesce(rebuilt, urls.absolute(F.col("link"), base)))


def semantic_items(flow: DataFrame, keys: list[str], kind: str = AGENDA_ITEM, longest: int = 300) -> DataFrame:
    """pos, nr, title of the agenda items that `dl` elements of a type hold: what their first value says."""
    is_node = F.coalesce((F.col("tag") == "dl") & (F.col("attrs")["typeof"] == kind), F.lit(False))
    rows = _within(flow.filter(is_node | (F.col("tag") == "dd")), keys, is_node, "node").filter("tag = 'dd'")
    first = ordered.first_of_runs(rows, F.col("node.pos"), keys, ["pos"])
    said = F.trim(F.coalesce(F.nullif(F.col("attrs")["content"], F.lit("")), F.col("text")))
    pattern = r"(?s)^(\d+[\w.]*\.?)\s+(.*)"
    numbered = said.rlike(pattern)
    title = F.trim(F.when(numbered, F.regexp_extract(said, pattern, 2)).otherwise(said))
    return first.filter(said != "").select(*keys, F.col("node.pos").alias("pos"), F.when(numbered, F.regexp_extract(said, pattern, 1)).otherwise("").alias("nr"), F.substr(title, F.lit(1), F.lit(longest)).alias("title"))


def found_documents(links: DataFrame, page: Column) -> DataFrame:
    """links (link, label, ...) to documents, with kind (pdf, word, unknown), name (a usual one where the label is empty) and target."""
    low = F.lower("link")
    kind = F.when(low.contains(".pdf"), "pdf").when(low.contains(".doc"), "word").when(low.contains("download"), "unknown")
    usual = F.when(low.contains(".pdf"), "document.pdf").when(low.contains(".docx"), "document.docx").when(low.contains(".doc"), "document.doc").otherwise("document")
    return links.withColumn("kind", kind).filter("kind is not null").withColumns({"name": F.coalesce(F.nullif(F.trim("label"), F.lit("")), usual), "target": urls.absolute(F.col("link"), urls.origin(page))})


def direct_downloads(links: DataFrame, keys: list[str], limit: Column, rules: str, path: str = DOWNLOAD) -> DataFrame:
    """link, label, day of a static list's downloads, each once; the day is read off the label, undated ones stay."""
    found = ordered.first_occurrence(links.filter(F.contains("link", F.lit(path))), ["link"], ["pos"], keys)
    return found.withColumn("day", dates.parsed(F.col("label"), rules)).filter(dates.since(F.col("day"), limit, True)).select(*keys, "link", "label", "day")
