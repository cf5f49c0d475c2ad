"""All source types as one plan: a protocol of adapters, a registry of their settings, and a harvest over all of them.

A setting becomes a CASE over the column `type`, with one branch for each value that some types share. So rows of all
types lie in one DataFrame, are dated, bounded, filtered and freed of repeats in one job, and a further type is a
further row of settings. Listings differ more: types that share a listing are read together, each listing once.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavel.functions import dates, filters, names, urls
from gavel.operators import ordered, reports, scans, sinks
from gavel.sources import html

KEYS = ["type", "entity", "page_id"]


@dataclass(frozen=True)
class Source:
    """Settings of a source type: date rules in order, look-back, undated documents, dedup scope, filter, sink."""

    rules: tuple[str, ...] = ("cms_path",)
    cutoff: str = "days31"
    months: int = 12
    keep_undated: bool = True
    stop_early: bool = False
    scope: tuple[str, ...] = ("page_id",)
    filter_on: tuple[str, ...] = ("label", "link")
    sink: sinks.Policy = sinks.Policy()
    organs: bool = True


# fixed values: the settings by source type; types not listed have the defaults
SOURCES = {
    "meetingburger": Source(("dutch_title",), "days30", stop_early=True, scope=("entity",), filter_on=("label",), sink=sinks.LEGACY_ANY),
    "lblod": Source(("dutch_heading",), scope=(), filter_on=("label", "link"), sink=sinks.LEGACY_PDF),
    "imio": Source(("french_text", "file_stem"), scope=("entity",), organs=False),
    "wordpress": Source(("link_text", "cms_path")),
    "drupal": Source(("folder_path",)),
    "icordis": Source(("dutch_url",), filter_on=("link",)),
    "linkebeek": Source(("dutch_tail",), scope=("entity",), filter_on=("label",)),
    "docodis": Source(("iso",), filter_on=("label",)),
    "pubcon": Source(("slash_first",), scope=("entity",)),
    "irisnet": Source(("folder_label",), "days30", keep_undated=False, filter_on=("label",), sink=sinks.LEGACY_ANY),
    "idelibe": Source(("iso",), "days30", sink=sinks.LEGACY_ANY),
    "ibabs": Source(("dutch_title",), "clamped_next", 3, keep_undated=False, scope=("entity",)),
    "gelinktnotuleren": Source(("iso",)),
    "provantwerpen": Source(("path_folder",), "calendar", 6, keep_undated=False),
    "vlaamsbrabant": Source(("iso",), "clamped", 3, keep_undated=False),
    "hainaut": Source(("french_du",), "calendar", 6, keep_undated=False),
    "brussel": Source(("slash",), keep_undated=False),
    "molenbeek": Source(("slash",), keep_undated=False),
    "schaerbeek": Source(("slug",), keep_undated=False),
    "ixelles": Source(("slash_meeting",)),
}


def by_type(kind: Column, value: Callable[[Source], Hashable], column: Callable[[Hashable], Column] = F.lit, sources: dict[str, Source] | None = None) -> Column:
    """A CASE over the type: what `column` makes of the setting's value, one branch for all types that share it."""
    groups: dict[Hashable, list[str]] = {}
    for name, source in (SOURCES if sources is None else sources).items():
        groups.setdefault(value(source), []).append(name)
    usual = value(Source())
    groups.pop(usual, None)
    out = F.when(F.lit(False), column(usual))
    for own, types in groups.items():
        out = out.when(kind.isin(*types), column(own))
    return out.otherwise(column(usual))


def _day(rules: tuple[str, ...]) -> Column:
    return F.coalesce(*(d for r in rules for d in (dates.parsed(F.col("label"), r), dates.parsed(F.col("link"), r))))


def policies(kind: Column, sources: dict[str, Source] | None = None) -> sinks.Policy:
    """The sink policy of each row's type."""
    of = lambda name: by_type(kind, lambda s: getattr(s.sink, name), sources=sources)
    return sinks.Policy(of("require_magic"), of("least_bytes"), of("existing_succeeds"), of("force_extension").cast("string"))


def select_documents(found: DataFrame, as_of: Column, terms: list[str] | None = None, months: int | None = None, sources: dict[str, Source] | None = None) -> DataFrame:
    """Links (type, entity, page_id, pos, link, label) that their types would download, with day, doc_type and file.

    Each type's rules date a link by its label or its address; then the type's look-back (or `months` for all of them)
    and its way with undated links, the filter on the columns that it looks at, and the first occurrence within its
    scope: page, entity, or none. Types that list the newest first end with the first old one. Types without settings
    have the usual ones; rows of a null type have them too.
    """
    kind = F.coalesce("type", F.lit(""))
    case = lambda value, column=F.lit: by_type(kind, value, column, sources)
    limit = case(lambda s: (s.cutoff, s.months if months is None else months), lambda v: dates.cutoff(as_of, v[1], v[0]))
    rows = found.withColumn("day", case(lambda s: s.rules, _day)).withColumn("__limit", limit)
    old = case(lambda s: s.stop_early) & (F.col("day") < F.col("__limit"))
    rows = ordered.until_first_old(rows, old, ["type", "entity"], ["page_id", "pos"])
    kept = F.coalesce(F.col("day") >= F.col("__limit"), case(lambda s: s.keep_undated))
    wanted = case(lambda s: s.filter_on, lambda columns: filters.any_term([F.col(c) for c in columns], terms))
    scope = case(lambda s: s.scope, lambda columns: F.concat_ws("/", *(F.col(c).cast("string") for c in columns or ("page_id", "pos"))))
    rows = rows.filter(kept & wanted).withColumn("__scope", scope)
    rows = ordered.first_occurrence(rows, ["link"], ["page_id", "pos"], ["type", "__scope"]).drop("__limit", "__scope")
    return rows.withColumns({"doc_type": filters.document_type(F.col("label")), "file": names.sanitise(names.hint(F.date_format("day", "yyyy-MM-dd"), urls.last_segment(F.col("link"))))})


def outcomes(results: DataFrame) -> DataFrame:
    """entities, total, new, skipped, failed of each type: the tally of a batch, from what `sinks.stored` says."""
    counted = reports.outcomes(results, ["type", "entity"], F.col("success"), F.col("skipped"))
    return counted.groupBy("type").agg(F.count("*").alias("entities"), F.count_if(F.col("failed") > 0).alias("with_failures"), *(F.sum(c).alias(c) for c in ("total", "new", "skipped", "failed")))


class SourceAdapter:
    """What a source type does beside its settings. Subclasses change what differs.

    organs: the organs of entities, or None where they are not known, and an empty table where the type has none.
    listing: links (type, entity, page_id, pos, link, label) on pages (type, entity, page_id, url, html).
    extract: the links to download.
    """

    def __init__(self, name: str) -> None:
        self.name, self.settings = name, SOURCES.get(name, Source())

    def organs(self, pages: DataFrame) -> DataFrame | None:
        """entity, organ by the options of a select field; none for a type without organs."""
        if not self.settings.organs:
            return pages.select("entity", F.lit("").alias("organ")).limit(0)
        found = html.options(pages.filter(F.col("type") == self.name), "html", KEYS, "organ")
        return found.select("entity", F.col("label").alias("organ")).distinct()

    def listing(self, pages: DataFrame) -> DataFrame:
        """All anchors, made absolute."""
        found = html.anchors(pages.select(*KEYS, "url", "html"), "html", [*KEYS, "url"])
        return found.select(*KEYS, "pos", urls.absolute(F.col("href"), F.col("url")).alias("link"), "label")

    def extract(self, found: DataFrame, as_of: Column, terms: list[str] | None = None) -> DataFrame:
        return select_documents(found.filter(F.col("type") == self.name), as_of, terms)


class HeadedAdapter(SourceAdapter):
    """The first document below each heading that is a date; the heading is its label."""

    def listing(self, pages: DataFrame) -> DataFrame:
        flow = html.flow(pages.select(*KEYS, "html"), "html", KEYS)
        found = scans.first_links(flow, KEYS, "h3", self.settings.rules[0])
        return found.select(*KEYS, F.col("section").alias("pos"), "link", F.concat(F.lit("du "), F.date_format("day", "d "), french_month(F.col("day")), F.date_format("day", " yyyy")).alias("label"))


class DateFirstAdapter(SourceAdapter):
    """Documents in table rows whose first cell is their date."""

    def listing(self, pages: DataFrame) -> DataFrame:
        flow = html.flow(pages.select(*KEYS, "html"), "html", KEYS)
        found = scans.date_first_rows(flow, KEYS, F.lit("0001-01-01").cast("date"))
        nth = F.row_number().over(Window.partitionBy(*KEYS).orderBy("link"))
        return found.select(*KEYS, nth.cast("long").alias("pos"), "link", F.concat_ws(" ", F.date_format("day", "dd/MM/yyyy"), "name").alias("label"))


def french_month(day: Column) -> Column:
    return dates.month_name(F.month(day), dates.FRENCH)


#: Adapters of the types whose listings are not plain anchors; the others share one.
ADAPTERS: dict[str, type[SourceAdapter]] = {"hainaut": HeadedAdapter, "molenbeek": DateFirstAdapter}


def adapter(name: str) -> SourceAdapter:
    return ADAPTERS.get(name, SourceAdapter)(name)


def listings(pages: DataFrame) -> DataFrame:
    """Links of pages of all types: one listing for each kind of adapter, over the pages of its types alone."""
    special = F.coalesce(F.col("type").isin(*ADAPTERS), F.lit(False))
    out = SourceAdapter("").listing(pages.filter(~special))
    for name in ADAPTERS:
        out = out.unionByName(adapter(name).listing(pages.filter(F.col("type") == name)))
    return out


class Gate(ValueError):
    """Arguments that do not say what to harvest."""


def selected(entities: DataFrame, name: str | None = None, kind: str | None = None, organ: str | None = None, everything: bool = False) -> DataFrame:
    """The entities (name, type, has_handler, has_organs) that arguments choose, with `organ`: null for all.

    One name or type must fit something; an organ or all of them must be asked for unless the type has none. Types
    without a handler stay, to be counted as left out, only where they were asked for by name.
    """
    if organ and everything:
        raise Gate("one organ or all of them, not both")
    if not (name or kind or organ or everything):
        raise Gate("name an entity, a type, an organ, or all")
    chosen = entities
    if name:
        chosen = chosen.filter(filters.has(F.col("name"), name)).orderBy("name").limit(1)
    if kind:
        chosen = chosen.filter(F.col("type") == kind)
    if not name:
        chosen = chosen.filter("has_handler")
    if name or kind:
        seen = chosen.select("has_organs").limit(1).collect()
        if not seen:
            raise Gate(f"nothing fits {name or kind!r}")
        if not organ and not everything and seen[0]["has_organs"]:
            raise Gate("name an organ, or all")
    return chosen.withColumn("organ", F.when(F.col("has_organs"), F.lit(organ)).cast("string"))
