"""HTML as table functions: what pages hold, in SQL.

    SELECT * FROM html_rows(TABLE(SELECT page_id, html FROM pages), 'html')
    SELECT * FROM html_elements(TABLE(pages) PARTITION BY (host), 'html', 'h2,h3', 'id')

The first argument is any table, the second names its column of HTML. All other columns are keys: they come first in
the result, as they are, so the result's schema is made from the table's when a query is analysed. A page is read when
its rows are asked for, and rows are handed on one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql.types import ArrayType, LongType, MapType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from gavel.sources import html


_TYPES = {"long": LongType(), "string": StringType(), "array<string>": ArrayType(StringType()), "map<string,string>": MapType(StringType(), StringType())}


def _fields(schema: str) -> list[StructField]:
    """Fields of a schema in words; a table function is analysed where there is no session to ask."""
    return [StructField(name, _TYPES[kind]) for name, kind in (c.split(" ") for c in schema.split(", "))]


def _handler(schema: str, read: Callable[..., Iterator[tuple]], arguments: int) -> type:
    """The handler of a table function: `arguments` strings besides the table and its column."""

    class Handler:
        @staticmethod
        def analyze(table: AnalyzeArgument, column: AnalyzeArgument, *more: AnalyzeArgument) -> AnalyzeResult:
            if not table.isTable:
                raise ValueError("the first argument is a table: TABLE(...)")
            if not column.isConstantExpression or not isinstance(column.value, str) or column.value not in table.dataType.names:
                raise ValueError(f"the second argument names a column of the table: one of {', '.join(table.dataType.names)}")
            if len(more) != arguments or not all(x.isConstantExpression and isinstance(x.value, str) for x in more):
                raise ValueError(f"{arguments} constant strings must follow the column")
            keys = [f for f in table.dataType.fields if f.name != column.value]
            fields = _fields(schema)
            clash = {f.name.lower() for f in keys} & {f.name.lower() for f in fields}
            if clash:
                raise ValueError(f"columns of the table and of the result have the same names: {', '.join(sorted(clash))}")
            return AnalyzeResult(StructType([*keys, *fields]))

        def eval(self, row, column: str, *more: str) -> Iterator[tuple]:
            keys = tuple(v for n, v in row.asDict(recursive=False).items() if n != column)
            for found in read(row[column], *more):
                yield (*keys, *found)

    return Handler


FUNCTIONS: dict[str, type] = {
    "html_anchors": _handler(html.ANCHORS, html.anchors_of, 0),
    "html_rows": _handler(html.ROWS, html.rows_of, 0),
    "html_elements": _handler(html.ELEMENTS, lambda text, tags, attribute: html.elements_of(text, tuple(t.strip() for t in tags.split(",")), attribute), 2),
    "html_options": _handler(html.OPTIONS, html.options_of, 1),
    "html_cards": _handler(html.CARDS, html.cards_of, 1),
}


def register(spark) -> None:
    """Make the functions known to a session's SQL."""
    from pyspark.sql.functions import udtf

    for name, handler in FUNCTIONS.items():
        spark.udtf.register(name, udtf(handler))
