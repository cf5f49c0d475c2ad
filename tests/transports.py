"""Transports without a network, which tests name by module and function."""

import json
import re
from datetime import date, timedelta
from urllib.parse import parse_qs, urlsplit


def canned(url: str, method: str = "GET") -> tuple[int, dict, str]:
    """Answers by what the URL says."""
    if "/fails" in url:
        raise TimeoutError("timed out")
    if "/busy" in url:
        return 503, {}, ""
    return (404, {}, "") if "/gone" in url else (200, {"Content-Type": "text/html"}, f"<a href='{url}/a.pdf'>a</a>")


def portal(url: str, method: str = "GET") -> tuple[int, dict, str]:
    """https://<n>.be/<kind>/...: n pages of five items that get two days older each, from the end of 2024.

    Kinds: next (JSON with links), numbers (HTML), mixed (HTML of which each page has something new), stuck (one page
    over and over), broken (fails on its third page), honest (heeds ?since), calendar (one item a month).
    """
    parts, asked = urlsplit(url), parse_qs(urlsplit(url).query)
    pages, kind = int(parts.netloc.split(".")[0].removeprefix("p")), parts.path.split("/")[1]
    at = int(asked.get("page", asked.get("start", ["0"]))[0]) // (5 if "start" in asked else 1)
    if kind == "calendar":
        month = parts.path.split("/")[2]
        return 200, {}, json.dumps({"meetings": [{"id": f"{parts.netloc}-{month}", "dateTime": f"{month[:4]}-{month[4:]}-05T10:00:00"}]})
    if kind == "stuck":
        return 200, {}, json.dumps({"data": [{"id": "1"}], "links": {"next": "/stuck?page=1"}})
    if kind == "broken" and at == 2:
        raise ConnectionRefusedError("refused")
    days = [date(2024, 12, 31) - timedelta(days=2 * (5 * at + i)) for i in range(5)] if at < pages else []
    if kind == "mixed" and days:
        days[2] = date(2024, 12, 30)
    if kind == "honest":
        days = [d for d in days if d.isoformat() >= asked.get("since", ["0"])[0]]
    if kind in ("numbers", "mixed"):
        return (200, {}, "".join(f'<a href="/d/{at}-{i}">Zitting {d:%d/%m/%Y}</a>' for i, d in enumerate(days))) if days else (404, {}, "")
    more = re.sub(r"page=\d+", "", parts.query).strip("&")
    items = [{"id": f"{at}-{i}", "attributes": {"planned": f"{d.isoformat()}T10:00:00", "title": "of 1999-01-01"}} for i, d in enumerate(days)]
    return 200, {}, json.dumps({"data": items, "links": {"next": f"/{kind}?page={at + 1}" + (f"&{more}" if more else "") if at + 1 < pages else None}})

