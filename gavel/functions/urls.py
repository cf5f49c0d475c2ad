"""URL predicates and parts as column expressions; none raises on malformed input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that is trimmed.
BLANK = " \t\n\r\x0b\x0c"
_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)"


def is_valid(url: Column, trimmed: bool = True) -> Column:
    """http or https with a host; null is not. Some sources do not trim first."""
    value = F.btrim(url, F.lit(BLANK)) if trimmed else url
    return F.coalesce(value.rlike(r"^(?i:https?)://[^/?#]+"), F.lit(False))


def host(url: Column) -> Column:
    """Lower-cased authority; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _ORIGIN, 2))


def origin(url: Column) -> Column:
    """scheme://authority; empty unless the URL is valid."""
    value = F.btrim(url, F.lit(BLANK))
    return F.when(is_valid(url), F.concat(F.lower(F.regexp_extract(value, _ORIGIN, 1)), F.lit("://"), F.regexp_extract(value, _ORIGIN, 2))).otherwise("")


def path_key(url: Column) -> Column:
    """URL without query, fragment and closing slashes."""
    return F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"/+$", "")


def absolute(href: Column, base: Column) -> Column:
    """href as it is if absolute, else joined to the site's root (not to the page)."""
    return F.when(href.startswith("http"), href).otherwise(F.concat(base, F.lit("/"), F.regexp_replace(href, r"^/+", "")))


def bare_host(name: Column, faithful: bool = False) -> Column:
    """Host without a leading "www."; faithful: without any leading w and dot characters, as sources once did."""
    return F.regexp_replace(name, r"^[w.]+", "") if faithful else F.regexp_replace(name, r"^www\.", "")


def same_site(link_host: Column, site_host: Column, also: tuple[str, ...] = ()) -> Column:
    """Whether a link stays on a site, "www." aside, or goes to one of the hosts named."""
    return (bare_host(link_host) == bare_host(site_host)) | link_host.isin(*also) if also else bare_host(link_host) == bare_host(site_host)


def query_parameter(url: Column, name: str) -> Column:
    """Value of a query parameter; null where it is missing or empty."""
    return F.nullif(F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1), F.lit(""))


def without_view(url: Column) -> Column:
    """file.pdf/view points to a page about the file; the file itself lies one level up."""
    return F.regexp_replace(url, r"(?i)(\.pdf)/view$", "$1")


def last_segment(url: Column) -> Column:
    """What follows the last slash of the path."""
    return F.element_at(F.split(path_key(url), "/"), -1)


def extension(url: Column) -> Column:
    """Lower-cased extension of the last segment, without dot; empty if none."""
    return F.lower(F.regexp_extract(last_segment(url), r"\.([A-Za-z0-9]+)$", 1))


def stem(url: Column) -> Column:
    """Last segment without its extension."""
    return F.regexp_replace(last_segment(url), r"\.[A-Za-z0-9]+$", "")


def without_size(label: Column) -> Column:
    """Label of a download without a closing size such as 12.3 KB."""
    return F.regexp_replace(label, r"(?i)\s*\(?\d+(?:[.,]\d+)?\s*[KM]B\)?\s*$", "")


def is_uuid(value: Column) -> Column:
    """Canonical 8-4-4-4-12 form."""
    return value.rlike(r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")
