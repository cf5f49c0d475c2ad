"""Pages over HTTP as a Spark data source: one partition a host, spaced requests, retries, errors as rows."""

from __future__ import annotations

import importlib
import json
import time
import urllib.error
import urllib.request
from collections import defaultdict
from urllib.parse import urlsplit

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition

SCHEMA = "host string, url string, status int, content_type string, disposition string, body string, error string"
#: Codes that are tried again, attempts, seconds before the second one (times the attempt), between requests, time-out.
AGAIN, ATTEMPTS, DELAY, SPACING, TIMEOUT = (429, 500, 502, 503, 504), 3, 1.5, 0.2, 60.0


def request(url: str, timeout: float = TIMEOUT, method: str = "GET") -> tuple[int, dict, str]:
    """Status, headers and body of one request."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, method=method), timeout=timeout) as r:  # noqa: S310  http and https only, see fetch
            return r.status, dict(r.headers), r.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers or {}), ""


def kind_of(error: Exception) -> str:
    """Short name of a failure."""
    text = f"{type(error).__name__}: {error}"
    for sign, name in (("SSL", "SSL"), ("CERTIFICATE", "SSL"), ("Name or service", "DNS"), ("getaddrinfo", "DNS"), ("refused", "refused"), ("timed out", "timeout"), ("Timeout", "timeout")):
        if sign in text:
            return name
    return text[:60]


def fetch(url: str, ask=request, attempts: int = ATTEMPTS, delay: float = DELAY, sleep=time.sleep) -> tuple[int | None, dict, str, str | None]:
    """Status, headers, body, error of a URL; failures and passing errors are tried again after a growing pause."""
    parts = urlsplit(url)
    if parts.scheme not in ("http", "https") or not parts.netloc:
        return None, {}, "", "invalid URL"
    for n in range(1, attempts + 1):
        try:
            status, headers, body = ask(url)
            if status not in AGAIN or n == attempts:
                return status, headers, body, None if status < 400 else f"HTTP {status}"
        except Exception as e:  # noqa: BLE001  any failure of a transport becomes a row
            if n == attempts:
                return None, {}, "", kind_of(e)
        sleep(delay * n)
    return None, {}, "", "no attempt"


def probe(url: str, ask=request) -> tuple[int | None, str | None]:
    """Status by HEAD, and by GET where HEAD is not answered properly."""
    try:
        status = ask(url, method="HEAD")[0]
        return (ask(url)[0] if status in (404, 405) else status), None
    except Exception as e:  # noqa: BLE001
        return None, kind_of(e)


class _Host(InputPartition):
    def __init__(self, host: str, urls: list[str]) -> None:
        self.host, self.urls = host, urls


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options, self.host = options, None

    def pushFilters(self, filters):  # noqa: N802  Spark's name
        """Hosts that a query leaves out are never asked."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("host",):
                self.host = f.value
            yield f

    def partitions(self):
        by_host = defaultdict(list)
        for url in json.loads(self.options["urls"]):
            by_host[urlsplit(url).netloc.lower()].append(url)
        return [_Host(h, u) for h, u in sorted(by_host.items()) if self.host in (None, h)]

    def read(self, partition):
        module, _, name = self.options.get("transport", "gavel.sources.fetch:request").partition(":")
        ask, spacing = getattr(importlib.import_module(module), name), float(self.options.get("spacing", SPACING))
        delay = float(self.options.get("delay", DELAY))
        for i, url in enumerate(partition.urls):
            if i:
                time.sleep(spacing)
            status, headers, body, error = fetch(url, ask, delay=delay)
            low = {k.lower(): v for k, v in headers.items()}
            yield partition.host, url, status, low.get("content-type"), low.get("content-disposition"), body, error


class PageSource(DataSource):
    """format("gavel-pages") with options urls (a JSON list), transport (module:function), spacing, delay."""

    @classmethod
    def name(cls):
        return "gavel-pages"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)


def register(spark) -> None:
    """Make the source known to a session, and let queries push their filters to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PageSource)
