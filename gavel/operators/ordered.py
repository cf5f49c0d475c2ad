"""Operations that hang on document order, given by an explicit position column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _until(scope: list[str], order: list[str]):
    return Window.partitionBy(*scope).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def first_occurrence(rows: DataFrame, keys: list[str], order: list[str], scope: list[str] = ()) -> DataFrame:
    """The first row of each key within its scope; deterministic, unlike dropDuplicates."""
    nth = F.row_number().over(Window.partitionBy(*scope, *keys).orderBy(*order))
    return rows.withColumn("__n", nth).filter("__n = 1").drop("__n")


def first_of_runs(rows: DataFrame, value: Column, scope: list[str], order: list[str]) -> DataFrame:
    """The first row of each run of equal values, which are never null, in its scope; no sort but the scope's own order."""
    before = F.lag(value).over(Window.partitionBy(*scope).orderBy(*order))
    return rows.withColumn("__before", before).filter(~F.col("__before").eqNullSafe(value)).drop("__before")


def carried_forward(rows: DataFrame, value: Column, scope: list[str], order: list[str], into: str) -> DataFrame:
    """The last value that is not null at or before each row of its scope."""
    return rows.withColumn(into, F.last(value, ignorenulls=True).over(_until(scope, order)))


def sections(rows: DataFrame, is_marker: Column, scope: list[str], order: list[str], into: str = "section") -> DataFrame:
    """Number of markers at or before each row; rows before the first marker have 0."""
    return counted(rows, {into: is_marker}, scope, order)


def counted(rows: DataFrame, markers: dict[str, Column], scope: list[str], order: list[str]) -> DataFrame:
    """Numbers of several kinds of markers at or before each row, told in one pass."""
    return rows.withColumns({into: F.sum(m.cast("int")).over(_until(scope, order)).cast("long") for into, m in markers.items()})


def until_first_old(rows: DataFrame, is_old: Column, scope: list[str], order: list[str]) -> DataFrame:
    """Rows before the first old one, in order; rows of unknown age do not stop the scan."""
    seen = F.max(F.coalesce(is_old, F.lit(False)).cast("int")).over(_until(scope, order))
    return rows.withColumn("__old", seen).filter("__old = 0").drop("__old")


def ends(rows: DataFrame, n: int, scope: list[str], order: list[str], last: bool = False) -> DataFrame:
    """The first n rows of each scope, or the last; Spark limits groups before it shuffles."""
    by = [F.col(o).desc() if last else F.col(o).asc() for o in order]
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*scope).orderBy(*by))).filter(F.col("__n") <= n).drop("__n")


def distinct_names(rows: DataFrame, name: str, identity: str, scope: list[str], order: list[str], into: str) -> DataFrame:
    """Names made distinct: from the second on, equal names get the id's first eight characters before the extension."""
    nth = F.row_number().over(Window.partitionBy(*scope, name).orderBy(*order))
    ending, mark = F.regexp_extract(name, r"(\.[^.]*)$", 1), F.substr(F.col(identity).cast("string"), F.lit(1), F.lit(8))
    base = F.substr(name, F.lit(1), F.length(name) - F.length(ending))
    return rows.withColumn("__n", nth).withColumn(into, F.when(F.col("__n") == 1, F.col(name)).otherwise(F.concat(base, F.lit("_"), mark, ending))).drop("__n")


def folders_to_read(months: int) -> int:
    """How many of the newest folders hold so many months."""
    return max(2, months // 12 + 1)
