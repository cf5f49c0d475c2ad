"""Listings of many pages as tables: a row a page, read along a cursor until it ends or is too old.

A cursor starts at a listing's URL and goes on by what the protocol says: the link to the next page that a page holds
(`next`), or a number in the query string that grows (`offset` until a page is empty, `page` likewise). Where a start
date is known, it is sent along if the site takes one, and the cursor stops at the first page with something older
(`first`), or at the first on which all that has a date is older (`all`; a page without any date goes on). Pages are
only looked at for that; what they hold is for Spark to extract.

`follow` takes the listings from a table and needs no list in the driver; the data source `gavel-listing` takes a few
listings as options, one partition a host, and reads the start date off a query's filter; the stream source of that
name reads calendars month by month.
"""

from __future__ import annotations

import importlib
import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import date
from urllib.parse import urljoin, urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, GreaterThan, GreaterThanOrEqual, InputPartition

from gavel.sources import fetch, files

SCHEMA = "listing string, page int, url string, status int, newest date, oldest date, body string, error string"
PROTOCOLS, STOPS = ("next", "offset", "page"), ("first", "all")
_DAY = re.compile(r"\b(\d{4})-(\d{2})-(\d{2})|\b(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})\b")
_ISO = re.compile(r"\d{4}-\d{2}-\d{2}(?:[T ]|$)")


@dataclass(frozen=True)
class Seen:
    """What a look at a page says: how many items it has, the days of those with a date, the link to the next page."""

    items: int
    days: list[date] = field(default_factory=list)
    more: str | None = None


def day_of(text: str) -> date | None:
    """The first day, year first or last, in a text; days that do not exist are none."""
    m = _DAY.search(text)
    try:
        return m and (date(int(m[1]), int(m[2]), int(m[3])) if m[1] else date(int(m[6]), int(m[5]), int(m[4])))
    except ValueError:
        return None


def _iso_day(text: str) -> date | None:
    """The day that a text begins with."""
    try:
        return date(int(text[:4]), int(text[5:7]), int(text[8:10]))
    except ValueError:
        return None


def json_page(body: str) -> Seen:
    """A JSON page with `data` or `items`, whose attributes hold ISO dates, and perhaps `links.next`. A broken one is empty."""
    try:
        page = json.loads(body)
    except ValueError:
        return Seen(0)
    if not isinstance(page, dict):
        return Seen(0)
    items, links = page.get("data") or page.get("items") or [], page.get("links") or {}
    values = [v for x in items if isinstance(x, dict) for v in (x.get("attributes") or x).values() if isinstance(v, str) and _ISO.match(v)]
    return Seen(len(items), [d for d in map(_iso_day, values) if d], links.get("next") or page.get("next"))


def html_page(body: str) -> Seen:
    """An HTML page: its links are the items, days stand in their texts, and rel=next names the next page."""
    anchors = re.findall(r"<a\b([^>]*)>(.*?)</a>", body, re.S | re.I)
    href = lambda a: (re.search(r'href\s*=\s*"([^"]*)"', a, re.I) or [None, None])[1]
    after = [href(a) for a, _ in anchors if re.search(r'rel\s*=\s*"?next', a, re.I)]
    items = [t for a, t in anchors if href(a) and not re.search(r'rel\s*=\s*"?(next|self)', a, re.I)]
    return Seen(len(items), [d for d in map(day_of, items) if d], after[0] if after else None)


@dataclass(frozen=True)
class Cursor:
    """How listings are walked; look, transport: "module:function", or "mirror:<folder>" or "packs:<number>:<folder>" for a transport."""

    protocol: str = "next"
    parameter: str = "page"
    first: int = 0
    step: int = 1
    stop: str = "first"
    since: date | None = None
    since_parameter: str | None = None
    look: str = "gavel.sources.listing:json_page"
    transport: str = "gavel.sources.fetch:request"
    spacing: float = fetch.SPACING
    delay: float = fetch.DELAY
    limit: int | None = None

    @classmethod
    def of(cls, options: dict) -> Cursor:
        """From a data source's options, all of which are strings."""
        kinds = {"first": int, "step": int, "limit": int, "spacing": float, "delay": float, "since": date.fromisoformat}
        return cls(**{k: kinds.get(k, str)(options[k]) for k in cls.__dataclass_fields__ if options.get(k) is not None})

    def __post_init__(self) -> None:
        if self.protocol not in PROTOCOLS or self.stop not in STOPS:
            raise ValueError(f"a protocol is one of {', '.join(PROTOCOLS)}, a stop one of {', '.join(STOPS)}")


def named(spec: str) -> Callable:
    """The function that "module:function" names, or a transport from a mirror or from packs."""
    module, _, name = spec.partition(":")
    if module == "packs":
        return files.unpacked(name)
    return files.mirror(name) if module == "mirror" else getattr(importlib.import_module(module), name)


def with_parameter(url: str, name: str, value: object) -> str:
    return f"{url}{'&' if '?' in url else '?'}{name}={value}"


def walk(listing: str, cursor: Cursor, pause: Callable[[], None] = lambda: None, ask: Callable | None = None) -> Iterator[tuple]:
    """Rows of SCHEMA for one listing. A page that fails for good, or repeats the one before, is a row with an error, and the last."""
    ask, look = ask or named(cursor.transport), named(cursor.look)
    begun = with_parameter(listing, cursor.since_parameter, cursor.since.isoformat()) if cursor.since and cursor.since_parameter else listing
    at, page, before = cursor.first, 0, None
    url = begun if cursor.protocol == "next" else with_parameter(begun, cursor.parameter, at)
    while True:
        if cursor.limit is not None and page >= cursor.limit:
            yield listing, page, url, None, None, None, None, f"more than {cursor.limit} pages"
            return
        pause()
        status, _, body, error = fetch.fetch(url, ask, delay=cursor.delay)
        if not error and body == before:
            error = "repeats the page before"
        if error:
            ended = cursor.protocol != "next" and page and status == 404  # numbers go on until there is no such page
            if not ended:
                yield listing, page, url, status, None, None, None, error
            return
        seen = look(body)
        if seen.items or not page:
            yield listing, page, url, status, max(seen.days, default=None), min(seen.days, default=None), body, None
        old = [d < cursor.since for d in seen.days] if cursor.since else []
        if not seen.items or (old and (any(old) if cursor.stop == "first" else all(old))):
            return
        if cursor.protocol == "next":
            if not seen.more:
                return
            url = urljoin(url, seen.more)
        else:
            at += cursor.step
            url = with_parameter(begun, cursor.parameter, at)
        before, page = body, page + 1


class Spaced:
    """Waits between the requests of a task, but not before the first."""

    def __init__(self, seconds: float) -> None:
        self.seconds, self.last = seconds, None

    def __call__(self) -> None:
        if self.seconds <= 0:
            return  # even a sleep of no seconds takes as long as reading a page
        if self.last is not None:
            time.sleep(max(0.0, self.last + self.seconds - time.monotonic()))
        self.last = time.monotonic()


#: Rows that are passed on together, and characters of their pages.
TOGETHER, LONG = 500, 1 << 22


def _dealt(urls: DataFrame, column: str, name: str, tasks: int | None, transport: str, spacing: float) -> DataFrame:
    """Distinct URLs that are not null, as `name`, with their host; all of a host's in one task if requests are spaced.

    Without spacing they are dealt evenly, and by packs where the transport has them. The number of tasks is given, for
    one that is not would let small partitions be read one after the other.
    """
    wanted = urls.select(F.col(column).alias(name)).filter(F.col(name).isNotNull()).distinct()
    wanted = wanted.withColumn("host", F.lower(F.regexp_extract(name, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)))
    tasks = tasks or int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if spacing > 0:
        return wanted.repartition(tasks, "host")
    if not transport.startswith("packs:"):
        return wanted.repartition(tasks, name)
    packs = int(transport.split(":")[1])
    return wanted.withColumn("pack", files.pack_of(F.col(name), packs)).repartitionById(packs, "pack")


_TYPES = {"string": pa.string(), "int": pa.int32(), "date": pa.date32()}


def follow(listings: DataFrame, cursor: Cursor, column: str = "listing", tasks: int | None = None, bodies: bool = True) -> DataFrame:
    """The pages (SCHEMA) of the listings, each distinct URL once; with spacing a host's are read by one task.

    Null URLs bring nothing. Pages are passed on a few at a time; no task holds more. Without bodies the same pages are
    read, but what they hold is not passed on.
    """
    fields = [c.split() for c in SCHEMA.split(", ") if bodies or not c.startswith("body ")]
    kept = [i for i, c in enumerate(SCHEMA.split(", ")) if bodies or not c.startswith("body ")]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        values = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(values[i], _TYPES[kind]) for i, (_, kind) in zip(kept, fields, strict=True)], names=[n for n, _ in fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaced: dict[str, Spaced] = {}
        ask = named(cursor.transport)
        found, size = [], 0
        for batch in batches:
            for listing, host in zip(batch.column("listing").to_pylist(), batch.column("host").to_pylist(), strict=True):
                for row in walk(listing, cursor, spaced.setdefault(host, Spaced(cursor.spacing)), ask):
                    found.append(row)
                    size += len(row[6] or "")
                    if cursor.spacing > 0 or len(found) >= TOGETHER or size >= LONG:
                        yield made(found)
                        found, size = [], 0
        if found:
            yield made(found)

    return _dealt(listings, column, "listing", tasks, cursor.transport, cursor.spacing).mapInArrow(read, ", ".join(" ".join(f) for f in fields))


def probes(urls: DataFrame, column: str = "url", transport: str = Cursor.transport, spacing: float = fetch.SPACING, tasks: int | None = None) -> DataFrame:
    """url, status, error of each distinct URL that is not null: by HEAD, and by GET where that is not answered properly.

    With spacing a host's URLs are asked for by one task, one after the other.
    """

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        send, spaced = named(transport), {}
        for batch in batches:
            found = []
            for url, host in zip(batch["url"], batch["host"], strict=True):
                spaced.setdefault(host, Spaced(spacing))()
                found.append((url, *(fetch.probe(url, send) if urlsplit(url).scheme in ("http", "https") else (None, "invalid URL"))))
            yield pd.DataFrame({"url": [f[0] for f in found], "status": pd.array([f[1] for f in found], dtype="Int32"), "error": pd.Series([f[2] for f in found], dtype=object)})

    return _dealt(urls, column, "url", tasks, transport, spacing).mapInPandas(ask, "url string, status int, error string")


class _Host(InputPartition):
    def __init__(self, listings: list[str], cursor: Cursor) -> None:
        self.listings, self.cursor = listings, cursor


def _by_host(listings: list[str], cursor: Cursor) -> list[_Host]:
    hosts: dict[str, list[str]] = {}
    for x in listings:
        hosts.setdefault(urlsplit(x).netloc.lower(), []).append(x)
    return [_Host(own, cursor) for _, own in sorted(hosts.items())]


def _read(partition: _Host) -> Iterator[tuple]:
    spaced = Spaced(partition.cursor.spacing)
    for listing in partition.listings:
        yield from walk(listing, partition.cursor, spaced)


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.listings, self.cursor = json.loads(options["listings"]), Cursor.of(options)

    def pushFilters(self, filters):  # noqa: N802  Spark's name
        """A bound from below on `newest` is the start date: what is older is not asked for. Spark still filters the pages."""
        for f in filters:
            if isinstance(f, (GreaterThan, GreaterThanOrEqual)) and f.attribute == ("newest",):
                since = f.value if isinstance(f.value, date) else date.fromisoformat(str(f.value))
                if self.cursor.since is None or since > self.cursor.since:
                    self.cursor = Cursor(**{**self.cursor.__dict__, "since": since})
            yield f

    def partitions(self):
        return _by_host(self.listings, self.cursor)

    def read(self, partition):
        return _read(partition)


class MonthReader(DataSourceStreamReader):
    """Calendars month by month. An offset is the number of months that are done; a trigger admits the next ones.

    A month of a listing is one cursor from the URL with {month} filled in (YYYYMM). As many months are admitted at once
    as `requests` allows for the host with most listings, one at least. The offset of a batch says which months it has,
    so a batch that is run again reads the same ones, and after a restart the next month follows.
    """

    def __init__(self, options: dict) -> None:
        self.listings, self.cursor = json.loads(options["listings"]), Cursor.of({k: v for k, v in options.items() if k != "first"})
        first, last = (int(options[k][:4]) * 12 + int(options[k][5:7]) - 1 for k in ("from", "until"))
        self.first, self.count = first, max(0, last - first + 1)
        most = max((len(h.listings) for h in _by_host(self.listings, self.cursor)), default=1)
        self.admitted, self.at = max(1, int(options.get("requests", most)) // most), None

    def initialOffset(self):  # noqa: N802
        return {"months": 0}

    def latestOffset(self):  # noqa: N802
        """The next months after those that were planned last."""
        self.at = min(self.count, (self.at or 0) + self.admitted)
        return {"months": self.at}

    def partitions(self, start, end):
        self.at = max(self.at or 0, end["months"])  # a restart plans the last batch before it asks for the next offset
        months = [f"{m // 12:04d}{m % 12 + 1:02d}" for m in range(self.first + start["months"], self.first + end["months"])]
        return _by_host([x.replace("{month}", m) for m in months for x in self.listings], self.cursor)

    def read(self, partition):
        return _read(partition)

    def commit(self, end):
        """Nothing to let go: the checkpoint holds the offsets."""


class ListingSource(DataSource):
    """format("gavel-listing"): option listings (a JSON list of URLs), and those of Cursor; as a stream also from, until (YYYY-MM), requests."""

    @classmethod
    def name(cls) -> str:
        return "gavel-listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(dict(self.options))

    def streamReader(self, schema) -> MonthReader:  # noqa: N802
        return MonthReader(dict(self.options))


def register(spark) -> None:
    """Make the sources known to a session, and let queries push their filters to them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ListingSource)
    files.register(spark)
