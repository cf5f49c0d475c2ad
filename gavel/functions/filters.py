"""Predicates on documents, organs, statuses and outcomes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: what a filter for minutes means, by source family
MINUTES = {
    "default": ["notulen"],
    "synonyms": ["notulen", "verslag", "zittingsverslag", "besluitenlijst", "uittreksel", "dagorde"],
    "aliases": ["notulen", "zittingsverslag", "zittingsnotulen", "verslag"],
    "german": ["protokoll"],
    "french": ["pv"],
}
# fixed values: categories that a portal's listing must name, and organ names in two languages
CATEGORIES = ["gemeenteraad", "raad voor maatschappelijk welzijn", "besluitenlijst", "verslag", "agenda", "vast bureau", "college"]
DUTCH_TO_FRENCH = {
    "gemeenteraad": "conseil communal",
    "college van burgemeester en schepenen": "collège des bourgmestre",
    "college": "collège",
    "ocmw": "cpas",
    "raad voor maatschappelijk welzijn": "cpas",
}
# fixed values: document types, in the order in which they are tried
DOCUMENT_TYPES = ["notulen", "agenda", "besluitenlijst", "uittreksel", "verslag", "dagorde"]
#: Type of a document that no keyword names.
OTHER = "overig"


def has(text: Column, term: str) -> Column:
    """Case-insensitive substring; false for null."""
    return F.coalesce(F.lower(text).contains(term.lower()), F.lit(False))


def any_term(texts: list[Column], terms: list[str] | None) -> Column:
    """Whether any term occurs in any text; no terms: everything passes."""
    terms = [t.strip() for t in terms or [] if t.strip()]
    out = F.lit(not terms)
    for text in texts:
        for term in terms:
            out = out | has(text, term)
    return out


def aliased(term: str) -> list[str]:
    """The terms that a filter stands for."""
    return MINUTES["aliases"] if term.strip().lower() == "notulen" else [term]


def include_exclude(title: Column, file: Column, skip: list[str], take: list[str], prefix: str = "pv") -> Column:
    """Skip words rule out; then words to take, or a file name that starts with the prefix, rule in; else no."""
    text = F.coalesce(F.nullif(title, F.lit("")), file)
    return F.when(any_term([text], skip), False).when(any_term([text], take), True).otherwise(F.coalesce(F.lower(file).rlike(rf"^{prefix}\w"), F.lit(False)))


def document_type(name: Column, keywords: list[str] | None = None) -> Column:
    """First keyword that the name holds, else `overig`."""
    out, keywords = F.when(F.lit(False), ""), keywords or DOCUMENT_TYPES
    for k in keywords:
        out = out.when(has(name, k), k)
    return out.otherwise(OTHER)


def status(text: Column, marker: str = "projet") -> Column:
    """projet if the marker occurs, else definitief."""
    return F.when(has(text, marker), "projet").otherwise("definitief")


def organ_one_way(name: Column, term: Column) -> Column:
    """Trimmed term within the name; an empty term or "all" matches everything."""
    t = F.lower(F.trim(F.coalesce(term, F.lit(""))))
    return (t == "") | (t == "all") | F.coalesce(F.lower(name).contains(t), F.lit(False))


def organ_two_way(name: Column, term: Column) -> Column:
    """Either within the other, so that an empty name matches everything."""
    a, b = F.lower(name), F.lower(term)
    return a.contains(b) | b.contains(a)


def organ_word(name: Column, term: str) -> Column:
    """Term, taken literally, as a whole word, bounded by start, white space or end."""
    return name.rlike(rf"(?i)(^|\s){re.escape(term)}(\s|$)")


def organ_code(code: Column, term: str) -> Column:
    """Exact code, in capitals."""
    return code == term.upper()


def organ_translated(name: Column, term: str, table: dict[str, str]) -> Column:
    """Term, translated where the table has it, within the name."""
    return has(name, table.get(term.lower(), term))


def is_published(hidden: Column) -> Column:
    """Published unless marked as not; unmarked counts as published."""
    return ~F.coalesce(hidden, F.lit(False))


def body_ok(content: Column, magic: str = "%PDF") -> Column:
    """Non-empty and begins with the magic bytes."""
    return F.coalesce(F.substr(content, F.lit(1), F.lit(len(magic))) == magic, F.lit(False))


def probe_outcome(code: Column, error: Column, kind: Column, guarded: list[str]) -> Column:
    """fout on errors and codes from 400 on, ok else; 403 is fine for the guarded kinds."""
    return F.when(error.isNotNull(), "fout").when((code == 403) & kind.isin(*guarded), "ok").when(code >= 400, "fout").otherwise("ok")


def probe_class(code: Column) -> Column:
    """Colour class of a code in reports."""
    return F.when(code < 300, "green").when(code < 400, "yellow").otherwise("red")


def default_months(organ: Column) -> Column:
    """36 months for municipal councils, 12 for others."""
    return F.when(has(organ, "gemeenteraad"), 36).otherwise(12)


def item_budget(limit: Column, months: Column, untouched: int = 100) -> Column:
    """Items to read: the limit, or if that is the default at least 50 and 8 a month."""
    return F.when(limit == untouched, F.greatest(F.lit(50), months * 8)).otherwise(limit)
