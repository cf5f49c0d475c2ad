"""File names, slugs and name keys as column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from gavel.functions import urls

# fixed values: names that one file system reserves
RESERVED = ["CON", "PRN", "AUX", "NUL", *(f"COM{i}" for i in range(1, 10)), *(f"LPT{i}" for i in range(1, 10))]


def nfkc(value: Column) -> Column:
    """Compatibility composition; Spark has no such function, so this one leaves the JVM. Use it on names only."""

    @F.pandas_udf("string")
    def compose(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))

    return compose(value)


def sanitise(name: Column, longest: int = 180, unicode: bool = True) -> Column:
    """A name that any file system takes: no separators, control characters, reserved stems or leading dots.

    Empty or null gives `document`. Too long names keep a short extension. Characters are composed first, unless
    unicode is off, which keeps names in ASCII in the JVM.
    """
    value = F.coalesce(nfkc(name) if unicode else name, F.lit(""))
    value = F.regexp_replace(value, r"\.{2,}", "_")
    value = F.regexp_replace(value, r'[<>:"/\\|?*\x00-\x1F]', "_")
    value = F.regexp_replace(F.regexp_replace(value, r"^[. \t\n\r]+", ""), r"[. \t\n\r]+$", "")
    value = F.regexp_replace(F.regexp_replace(value, r"_+", "_"), r"^_+|_+$", "")
    value = F.when(F.upper(F.substring_index(value, ".", 1)).isin(*RESERVED), F.concat(F.lit("_"), value)).otherwise(value)
    ending = F.regexp_extract(value, r"(\.[^.]{1,9})$", 1)
    cut = F.concat(F.substr(value, F.lit(1), F.lit(longest) - F.length(ending)), ending)
    value = F.when(F.length(value) > longest, cut).otherwise(value)
    return F.when(value == "", F.lit("document")).otherwise(value)


def sanitise_weakly(name: Column, longest: int = 180) -> Column:
    """An older sink's names: separators and control characters only; reserved stems and marks stay as they are."""
    value = F.regexp_replace(F.regexp_replace(F.coalesce(name, F.lit("")), r'[<>:"/\\|?*\x00-\x1F]', "_"), r"_+", "_")
    value = F.substr(F.regexp_replace(value, r"^[_. ]+|[_. ]+$", ""), F.lit(1), F.lit(longest))
    return F.when(value == "", F.lit("document")).otherwise(value)


def page_title(title: Column, heading: Column, url: Column, site: str) -> Column:
    """Title of a page without the site's name at its end; else its heading; else the last segment of its URL."""
    short = F.trim(F.regexp_replace(title, rf"(?i)\s*[|–-].*{site}.*$", ""))
    return F.coalesce(F.nullif(short, F.lit("")), F.nullif(F.trim(heading), F.lit("")), urls.last_segment(url))


def without_remark(title: Column) -> Column:
    """A title without the remark in brackets at its end."""
    return F.regexp_replace(title, r"\s*\([^()]*\)\s*$", "")


def heading_text(html: Column, tag: str = "h1") -> Column:
    """Text of a page's first heading without that of links in it; null where there is none."""
    inner = F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1)
    bare = F.regexp_replace(F.regexp_replace(inner, r"(?is)<a\b.*?</a>", ""), r"<[^>]*>", "")
    return F.nullif(F.trim(F.regexp_replace(bare, r"\s+", " ")), F.lit(""))


def safe_path(base: Column, parts: list[Column], name: Column) -> Column:
    """A path below base, whatever the parts hold: each is sanitised, so none can climb."""
    return F.concat_ws("/", base, *(sanitise(p) for p in parts), sanitise(name))


def slug(name: Column, longest: int = 60, default: str = "gemeente") -> Column:
    """ASCII folder name of an entity."""
    value = F.regexp_replace(F.regexp_replace(F.coalesce(name, F.lit("")), "'", ""), r"[ /]", "_")
    value = F.regexp_replace(F.regexp_replace(value, r"[^A-Za-z0-9_-]", "_"), "_+", "_")
    value = F.substr(F.regexp_replace(value, "^_+|_+$", ""), F.lit(1), F.lit(longest))
    return F.when(value == "", F.lit(default)).otherwise(value)


def folder(name: Column, longest: int = 30) -> Column:
    """Short lower-case folder name."""
    return F.substr(F.translate(F.lower(name), " /", "__"), F.lit(1), F.lit(longest))


def _bare_letters() -> tuple[str, str]:
    """Lower-case letters that decompose to one letter and marks, and that letter of each."""
    marked, plain = [], []
    for c in map(chr, range(0xA0, 0x10000)):
        base = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if len(base) == 1 and base != c:
            marked.append(c)
            plain.append(base)
    return "".join(marked), "".join(plain)


MARKED, PLAIN = _bare_letters()


def without_marks(text: Column) -> Column:
    """Text without the marks of letters, composed or not, of any script; letters that are no base and mark (ø, ł, æ) stay."""
    return F.regexp_replace(F.translate(text, MARKED, PLAIN), r"\p{Mn}+", "")


def folded(name: Column) -> Column:
    """Key for comparing names: lower case, no marks, spaces or hyphens."""
    return F.translate(without_marks(F.lower(name)), " -", "")


def alike(name: Column) -> Column:
    """The name in a collation that ignores case and marks: a join or group key that keeps the spelling.

    Wider than folded(): it also takes ø for o and œ for oe. Spaces and hyphens count.
    """
    return F.collate(name, "UNICODE_CI_AI")


def name_key(name: Column) -> Column:
    """Weaker key: lower case, u marks folded, no spaces or hyphens."""
    return F.translate(F.lower(name), "üû- ", "uu")


def extension_for(content_type: Column) -> Column:
    """Extension that a content type stands for; null for pages, which are no documents."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    return F.when(kind.contains("pdf"), ".pdf").when(kind.contains("html"), F.lit(None).cast("string")).otherwise(".bin")


def resolved(disposition: Column, hint: Column, url: Column) -> Column:
    """File name of a download: encoded name, plain name, hint, last segment of the URL, `document`."""
    encoded = F.nullif(F.regexp_extract(disposition, r"(?i)filename\*\s*=\s*(?:UTF-8'')?([^;\s]+)", 1), F.lit(""))
    plain = F.nullif(F.regexp_extract(disposition, r'(?i)filename\s*=\s*"?([^";]+)"?', 1), F.lit(""))
    tail = F.nullif(F.regexp_extract(url, r"/([^/?#]+)/?(?:[?#].*)?$", 1), F.lit(""))
    return F.coalesce(F.try_url_decode(encoded), plain, F.nullif(hint, F.lit("")), tail, F.lit("document"))


def hint(*parts: Column) -> Column:
    """Parts that are not null, joined by underscores."""
    return F.concat_ws("_", *parts)


def number_and_title(text: Column) -> tuple[Column, Column]:
    """A leading number such as 12a. and the rest; the number is empty where there is none."""
    return F.regexp_extract(text, r"^(\d+[a-z]?)\.\s", 1), F.regexp_replace(text, r"^\d+[a-z]?\.\s+", "")


def without_ordinal(text: Column) -> Column:
    """1er and 1 er become 1."""
    return F.regexp_replace(text, r"\b1\s?er\b", "1")
