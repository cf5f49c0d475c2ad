"""Counts, groupings and rendered reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counts_with_total(rows: DataFrame, key: str, total: str = "TOTAL") -> DataFrame:
    """key, n: rows of each key and of all, in one rollup."""
    counted = rows.rollup(key).agg(F.count("*").alias("n"), F.grouping(key).alias("__all"))
    return counted.select(F.when(F.col("__all") == 1, total).otherwise(F.col(key)).alias(key), "n")


def outcomes(results: DataFrame, keys: list[str], success: Column, skipped: Column) -> DataFrame:
    """total, new, skipped, failed of each key."""
    return results.groupBy(*keys).agg(
        F.count("*").alias("total"),
        F.count_if(success & ~skipped).alias("new"),
        F.count_if(skipped).alias("skipped"),
        F.count_if(~success & ~skipped).alias("failed"),
    )


def documents_by_meeting(documents: DataFrame, keys: list[str], order: list[str], text: Column, sep: str = ", ") -> DataFrame:
    """Documents of each meeting in their order, joined: n_documents, documents."""
    ordered = F.sort_array(F.collect_list(F.struct(*order, text.alias("__text"))))
    return documents.groupBy(*keys).agg(F.count("*").alias("n_documents"), F.array_join(F.transform(ordered, lambda d: d["__text"]), sep).alias("documents"))


def escaped(text: Column) -> Column:
    """Text that is safe in HTML."""
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("&"), F.lit("&amp;"))
    for mark, name in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(mark), F.lit(name))
    return out


def table_row(*cells: Column) -> Column:
    """A row of an HTML table."""
    return F.concat(F.lit("<tr>"), *(F.concat(F.lit("<td>"), escaped(c.cast("string")), F.lit("</td>")) for c in cells), F.lit("</tr>"))


def table_report(rows: DataFrame, keys: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """One HTML table a key, with a heading row and a footer that counts rows."""
    body = F.sort_array(F.collect_list(F.struct(*order, table_row(*map(F.col, columns)).alias("__row"))))
    head = "<tr>" + "".join(f"<th>{c}</th>" for c in columns) + "</tr>"
    made = rows.groupBy(*keys).agg(body.alias("__body"))
    foot = F.concat(F.size("__body").cast("string"), F.when(F.size("__body") == 1, " rij").otherwise(" rijen"))
    return made.select(*keys, F.concat(F.lit(f"<table>{head}"), F.array_join(F.transform("__body", lambda r: r["__row"]), ""), F.lit("</table><p>"), foot, F.lit("</p>")).alias("html"))


def badge(name: Column, url: Column, local: Column) -> Column:
    """Link to a document: to the local file where there is one."""
    return F.concat(F.lit('<a class="'), F.when(local.isNotNull(), "local").otherwise("external"), F.lit('" href="'), escaped(F.coalesce(local, url)), F.lit('">'), escaped(name), F.lit("</a>"))


def card_report(rows: DataFrame, keys: list[str], group: str, day: str, order: str, name: Column, target: Column, missing: str = "Overig") -> DataFrame:
    """One page a key: a section for each group, in the order in which groups come up, its cards by day, newest first."""
    card = F.concat(F.lit('<div class="card"><a href="'), escaped(target), F.lit('">'), escaped(name), F.lit("</a> "), escaped(F.col(day)), F.lit("</div>"))
    cards = F.sort_array(F.collect_list(F.struct(day, order, card.alias("__card"))), asc=False)
    groups = rows.groupBy(*keys, F.coalesce(F.col(group), F.lit(missing)).alias("__group")).agg(F.min(order).alias("__first"), F.array_join(F.transform(cards, lambda c: c["__card"]), "").alias("__cards"))
    section = F.concat(F.lit("<section><h2>"), escaped(F.col("__group")), F.lit("</h2>"), F.col("__cards"), F.lit("</section>"))
    sections = F.sort_array(F.collect_list(F.struct("__first", section.alias("__section"))))
    return groups.groupBy(*keys).agg(F.array_join(F.transform(sections, lambda s: s["__section"]), "").alias("html"))


def entity_report(rows: DataFrame, key: str, decision: str, status: str, name: str, order: str) -> DataFrame:
    """One page an entity: decisions with a class for their status, then counts, then publications."""
    css = F.when(F.col(status).isin("projet", "definitif"), F.col(status)).otherwise("unknown")
    line = F.when(F.col(decision), F.concat(F.lit('<p class="'), css, F.lit('">'), escaped(F.col(name)), F.lit("</p>"))).otherwise(F.concat(F.lit("<p>"), escaped(F.col(name)), F.lit("</p>")))
    part = lambda own: F.sort_array(F.collect_list(F.when(own, F.struct(order, line.alias("__line")))))
    made = rows.groupBy(key).agg(part(F.col(decision)).alias("__one"), part(~F.col(decision)).alias("__two"))
    shown = lambda c: F.when(F.size(c) == 0, "<p>geen</p>").otherwise(F.array_join(F.transform(c, lambda x: x["__line"]), ""))
    counts = F.concat(F.lit("<h2>"), F.size("__one").cast("string"), F.lit(" besluiten, "), F.size("__two").cast("string"), F.lit(" publicaties</h2>"))
    return made.select(key, F.concat(F.lit("<h1>"), escaped(F.col(key).cast("string")), F.lit("</h1>"), shown("__one"), counts, shown("__two")).alias("html"))


def agenda_html(items: Column, numbered: bool = False) -> Column:
    """A list of agenda items (array of nr, title), with their numbers or without; nothing for none."""
    tag = "ol" if numbered else "ul"
    number = lambda x: F.when(F.lit(numbered) & (F.coalesce(x["nr"], F.lit("")) != ""), F.concat(F.lit("<strong>"), escaped(x["nr"]), F.lit("</strong> "))).otherwise("")
    made = F.array_join(F.transform(items, lambda x: F.concat(F.lit("<li>"), number(x), escaped(x["title"]), F.lit("</li>"))), "")
    return F.when(F.size(items) > 0, F.concat(F.lit(f'<{tag} class="agenda">'), made, F.lit(f"</{tag}>"))).otherwise("")


def metadata_html(fields: dict[str, Column]) -> Column:
    """A table of names and values; empty values have no row."""
    row = lambda name, value: F.when(F.coalesce(value.cast("string"), F.lit("")) != "", F.concat(F.lit(f"<tr><th>{name}</th><td>"), escaped(value.cast("string")), F.lit("</td></tr>"))).otherwise("")
    return F.concat(F.lit("<table>"), *(row(n, v) for n, v in fields.items()), F.lit("</table>"))


def decision_card(title: Column, status: Column, fields: dict[str, Column], documents: Column) -> Column:
    """A decision with its status, metadata and links to its documents (array of name, url, local)."""
    css = F.when(status.isin("projet", "definitif"), status).otherwise("unknown")
    links = F.array_join(F.transform(documents, lambda d: badge(d["name"], d["url"], d["local"])), "")
    shown = F.when(F.size(documents) > 0, F.concat(F.lit("<div>"), links, F.lit("</div>"))).otherwise("<p>geen documenten</p>")
    return F.concat(F.lit('<article><h3 class="'), css, F.lit('">'), escaped(title), F.lit("</h3>"), metadata_html(fields), shown, F.lit("</article>"))
