"""All registered catalogue and harvest queries."""

from gavel.plans import catalogue, crawl, dates, details, filters, harvest, links, listing, lookups, ordered, payloads, reports, scans  # noqa: F401  each registers its own
from gavel.registry import ORACLE, QUERIES  # noqa: F401
