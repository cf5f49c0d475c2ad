"""HTML extraction by the standard library's parser, in Arrow batches.

Patterns on the JVM side cover well-formed links (see plans.links); these cover nesting, cells, cards and options.
Each function takes a table with HTML and gives its key columns, positions in document order and what was found.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterator
from html import unescape
from html.parser import HTMLParser
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame

#: Elements that have no end tag.
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Elements that hold others: what they say is said by those.
CONTAINERS = {"html", "body", "main", "header", "footer", "nav", "aside", "section", "article", "form", "fieldset", "div", "table", "thead", "tbody", "tfoot", "tr", "ul", "ol", "dl"}


class _Collector(HTMLParser):
    """Elements in document order: tag, attributes, where their text begins and ends in `said`, depth, position of the last
    one inside. What is said inside an element counts for all around it, so texts are cut out of the page's once it is read."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[list] = []
        self.open: list[list] = []
        self.said: list[str] = []
        self.length = 0
        self.raw = False

    def handle_starttag(self, tag, attrs):
        self.begin(tag, {k: v or "" for k, v in attrs})

    def begin(self, tag: str, attrs: dict[str, str]) -> None:
        element = [tag, attrs, self.length, self.length, len(self.open), len(self.found)]
        self.found.append(element)
        if tag in ("script", "style"):
            self.raw = True
        if tag not in _VOID:
            self.open.append(element)

    def handle_endtag(self, tag):
        self.raw = self.raw and tag not in ("script", "style")
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self.end(i)
                break

    def handle_data(self, data):
        if not self.raw:
            self.said.append(data)
            self.length += len(data)

    def end(self, i: int) -> None:
        """End the open elements from the i-th on."""
        last = len(self.found) - 1
        for element in self.open[i:]:
            element[3], element[5] = self.length, last
        del self.open[i:]

    def read(self) -> tuple[list[list], str]:
        """The elements and the page's text."""
        self.end(0)
        return self.found, "".join(self.said)

    def elements(self) -> list[tuple]:
        return _cut(*self.read())


def _cut(found: list[list], whole: str) -> list[tuple]:
    """tag, attributes, text, depth of elements."""
    return [(tag, attrs, whole[start:end], depth) for tag, attrs, start, end, depth, _ in found]


#: Text and a plain tag: lower case, attributes in double quotes; with the text and the end tag that follow, if no other
#: tag comes between. A page of these alone needs no parser.
_PLAIN = re.compile(r'([^<]*)<(/?)([a-z][a-z0-9]*)((?: [a-z][a-z0-9-]*="[^"<>]*")*)>(?:([^<]*)(</)\3>)?')
#: The same, with elements of the tag that follow at once and hold text only (cells of a row, items of a list), up to 200:
#: one match then reads many elements.
_RUNS = re.compile(_PLAIN.pattern.replace("(?:([^<]*)(</)", r"(?:([^<]*(?:</\3><\3>[^<]*){0,200})(</)"))
_ATTRIBUTE = re.compile(r' ([a-z][a-z0-9-]*)="([^"]*)"')
#: Elements whose content is no markup, and references in attributes that are more than plain ones.
_TEXTUAL = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}
_REFERENCE = re.compile(r"&(?!(?:amp|lt|gt|quot|#39);)")


def _attributes(said: str) -> dict[str, str]:
    """Attributes of a plain tag; most tags have one."""
    if said.count('"') == 2:
        name, _, value = said[1:-1].partition('="')
        return {name: value}
    return dict(_ATTRIBUTE.findall(said))


def _plain(page: str) -> tuple[list[list], str] | None:
    """What the parser reads in a page of plain tags; None if it has others."""
    if "<!" in page:
        return None
    marks = page.count("<")  # every tag begins with one, and none is inside another
    alike = page.count("</td><td>") + page.count("</li><li>")
    tokens = (_RUNS if 3 * alike > marks else _PLAIN).findall(page)  # the longer pattern is worth it in long runs only
    collector = _Collector()
    found, open_, said, length, tags = collector.found, collector.open, collector.said, 0, len(tokens)
    escaped = "&" in page
    for text, closing, tag, attributes, inner, ended in tokens:  # as the collector's methods, mostly without calls
        if text:
            if escaped and "&" in text:
                text = unescape(text)
            said.append(text)
            length += len(text)
        if closing:
            if attributes:
                return None
            if open_ and open_[-1][0] == tag:
                element = open_.pop()
                element[3], element[5] = length, len(found) - 1
            else:
                collector.length = length
                collector.handle_endtag(tag)
        elif tag in _TEXTUAL:
            return None
        else:
            own = _attributes(attributes) if attributes else {}
            if escaped and "&" in attributes:
                if _REFERENCE.search(attributes):
                    return None
                own = {k: unescape(v) for k, v in own.items()}
            element = [tag, own, length, length, len(open_), len(found)]
            found.append(element)
            if not ended and tag not in _VOID:
                open_.append(element)
        if ended:
            tags += 1
            more = ()
            if inner:
                if alike and "<" in inner:
                    inner, *more = inner.split(f"</{tag}><{tag}>")
                if escaped and "&" in inner:
                    inner = unescape(inner)
                said.append(inner)
                length += len(inner)
            if closing:
                collector.length = length
                collector.handle_endtag(tag)
            elif tag not in _VOID:
                element[3] = length
            if more:
                tags += 2 * len(more)
                depth, n, void = len(open_), len(found), tag in _VOID
                for inner in more:
                    if escaped:
                        inner = unescape(inner)
                    begin, length = length, length + len(inner)
                    said.append(inner)
                    found.append([tag, {}, begin, begin if void else length, depth, n])
                    n += 1
    if tags != marks:
        return None
    collector.length = length
    tail = page[page.find(">", page.rfind("<")) + 1 :] if tokens else page
    if tail:
        collector.handle_data(unescape(tail))
    return collector.read()


def _read(text: str | None) -> tuple[list[list], str]:
    """The collector's elements of a page, and the page's text; a broken page gives what was read of it."""
    found = _plain(text or "")
    if found is None:
        collector = _Collector()
        collector.feed(text or "")
        collector.close()
        found = collector.read()
    return found


def parsed(text: str | None) -> list[tuple]:
    """Elements of a page (tag, attributes, text, depth); a broken page gives what was read of it."""
    return _cut(*_read(text))


#: Rows that are passed on together, and characters of the pages that they come from.
TOGETHER, LONG = 4000, 1 << 22
_TYPES = {"long": pa.int64(), "string": pa.string(), "array<string>": pa.list_(pa.string()), "map<string,string>": pa.map_(pa.string(), pa.string())}


def _array(values: tuple, kind: str) -> pa.Array:
    """Values of a kind; maps are laid out here, which takes a fraction of the time of a conversion pair by pair."""
    if not kind.startswith("map"):
        return pa.array(values, _TYPES[kind])
    at, keys, items = [], [], []
    for v in values:
        at.append(None if v is None else len(keys))
        if v:
            keys.extend(v)
            items.extend(v.values())
    return pa.MapArray.from_arrays(pa.array([*at, len(keys)], pa.int32()), pa.array(keys, pa.string()), pa.array(items, pa.string()))


def _extract(pages: DataFrame, column: str, keys: list[str], schema: str, rows: Callable[[str | None], Iterator[tuple]]) -> DataFrame:
    types = dict(pages.dtypes)
    fields = [tuple(c.split(" ")) for c in schema.split(", ")]

    def made(batch: pa.RecordBatch, of: list[int], found: list[tuple]) -> pa.RecordBatch:
        own = [batch.column(k).take(pa.array(of, pa.int64())) for k in range(len(keys))]
        values = list(zip(*found, strict=True)) or [()] * len(fields)
        return pa.RecordBatch.from_arrays([*own, *(_array(v, kind) for (_, kind), v in zip(fields, values, strict=True))], names=[*keys, *(n for n, _ in fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # elements hold no cycles, but so many of them that looking for some takes a third of the time
        try:
            yield from read(batches)
        finally:
            gc.enable()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, found, size = [], [], 0
            for i, page in enumerate(batch.column(len(keys))):
                text = page.as_py()
                own = iter(rows(text))
                while some := list(islice(own, TOGETHER - len(found))):
                    of += [i] * len(some)
                    found += some
                    if len(found) >= TOGETHER:
                        yield made(batch, of, found)
                        of, found, size = [], [], 0
                size += len(text or "")
                if size >= LONG:
                    yield made(batch, of, found)
                    of, found, size = [], [], 0
            if found:
                yield made(batch, of, found)

    return pages.select(*keys, column).mapInArrow(run, ", ".join([*(f"{k} {types[k]}" for k in keys), schema]))


ANCHORS = "pos long, href string, label string"
ELEMENTS = "pos long, tag string, value string, text string"
OPTIONS = "pos long, value string, label string"
ROWS = "table_no long, row_no long, cells array<string>, links array<string>"
CARDS = "pos long, title string, link string, day string, fields map<string,string>"


def anchors_of(text: str | None) -> Iterator[tuple]:
    """ANCHORS of a page: anchors with a target."""
    found, whole = _read(text)
    return ((i, e[1]["href"], whole[e[2] : e[3]].strip()) for i, e in enumerate(e for e in found if e[0] == "a" and "href" in e[1]))


def elements_of(text: str | None, tags: tuple[str, ...], attribute: str = "id") -> Iterator[tuple]:
    """ELEMENTS of a page: elements with one of the tags, and one attribute of each."""
    found, whole = _read(text)
    return ((i, e[0], e[1].get(attribute), whole[e[2] : e[3]].strip()) for i, e in enumerate(e for e in found if e[0] in tags))


def anchors(pages: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """pos, href, label of each anchor with a target."""
    return _extract(pages, column, keys, ANCHORS, anchors_of)


def elements(pages: DataFrame, column: str, keys: list[str], tags: tuple[str, ...], attribute: str = "id") -> DataFrame:
    """pos, tag, value (of one attribute), text of each element with one of the tags."""
    return _extract(pages, column, keys, ELEMENTS, lambda text: elements_of(text, tags, attribute))


def flow(pages: DataFrame, column: str, keys: list[str], tags: tuple[str, ...] = (), attributes: tuple[str, ...] | None = None) -> DataFrame:
    """pos, last, tag, attrs, text of each element (with one of the tags, if given), in document order.

    attrs are all attributes, or those of the names given; a scan should name what it looks at, since maps are most of a row.

    last is the position of the last element inside it, so that what an element holds lies between pos and last. The
    text of an element is that of all inside it; containers have none, so that no page is passed on once a level.
    """

    wanted = frozenset(attributes or ())

    def rows(text):
        found, whole = _read(text)
        if attributes is not None:
            for e in found:
                if e[1] and not e[1].keys() <= wanted:
                    e[1] = {k: v for k, v in e[1].items() if k in wanted}
        return ((i, e[5], e[0], e[1], "" if e[0] in CONTAINERS else whole[e[2] : e[3]].strip()) for i, e in enumerate(found) if not tags or e[0] in tags)

    return _extract(pages, column, keys, "pos long, last long, tag string, attrs map<string,string>, text string", rows)


def options_of(text: str | None, select: str) -> Iterator[tuple]:
    """OPTIONS of one select field of a page; options without a value are left out."""
    inside, depth, n = False, 0, 0
    found, whole = _read(text)
    for tag, attrs, start, end, level, _ in found:
        if inside and level <= depth:
            inside = False
        if tag == "select" and attrs.get("name") == select:
            inside, depth = True, level
        elif inside and tag == "option" and attrs.get("value"):
            yield n, attrs["value"], whole[start:end].strip()
            n += 1


def options(pages: DataFrame, column: str, keys: list[str], select: str) -> DataFrame:
    """pos, value, label of the options of one select field; options without a value are left out."""
    return _extract(pages, column, keys, OPTIONS, lambda text: options_of(text, select))


def rows_of(text: str | None) -> Iterator[tuple]:
    """ROWS of the tables of a page that have cells; header cells are none."""
    table, row, own, depth = -1, -1, None, 0
    found, whole = _read(text)
    for tag, attrs, start, end, level, _ in found:
        if own and (level <= depth or tag == "tr" or tag == "table"):
            if own[2]:
                yield own
            own = None
        if tag == "table":
            table, row = table + 1, -1
        elif tag == "tr":
            row, depth = row + 1, level
            own = (table, row, [], [])
        elif tag == "td" and own:
            own[2].append(whole[start:end].strip())
        elif tag == "a" and own and "href" in attrs:
            own[3].append(attrs["href"])
    if own and own[2]:
        yield own


def table_rows(pages: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """table_no, row_no, cells, links of each row that has cells; a heading row counts, but has none."""
    return _extract(pages, column, keys, ROWS, rows_of)


def cards_of(text: str | None, css_class: str) -> Iterator[tuple]:
    """CARDS of a page: of each element with the class the heading, first link, machine date and label/value pairs."""
    out, card = [], None
    found, whole = _read(text)
    for tag, attrs, start, end, level, _ in found:
        if card and level <= card[0]:
            card = None
        if attrs and css_class in attrs.get("class", "").split():
            card = [level, None, None, None, {}, None]
            out.append(card)
        elif card:
            if tag in ("h2", "h3", "h4") and card[1] is None:
                card[1] = whole[start:end].strip()
            elif tag == "a" and card[2] is None and "href" in attrs:
                card[2] = attrs["href"]
            elif tag == "time" and card[3] is None:
                card[3] = attrs.get("datetime")
            elif tag == "dt":
                card[5] = whole[start:end].strip()
            elif tag == "dd" and card[5]:
                card[4][card[5]] = whole[start:end].strip()
    return ((i, c[1], c[2], c[3], c[4]) for i, c in enumerate(out))


def cards(pages: DataFrame, column: str, keys: list[str], css_class: str) -> DataFrame:
    """pos, title, link, day, fields of each element with the class: its heading, first link, machine date and label/value pairs."""
    return _extract(pages, column, keys, CARDS, lambda text: cards_of(text, css_class))
