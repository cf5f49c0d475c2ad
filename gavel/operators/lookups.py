"""Joins with defaults, fallbacks and priorities; set comparisons; expansion of trees."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_default(rows: DataFrame, dimension: DataFrame, key: str, values: dict[str, Column]) -> DataFrame:
    """Left join on key; where the dimension has no row, each value takes its default."""
    joined = rows.join(dimension, key, "left")
    return joined.select(*rows.columns, *(F.coalesce(F.col(v), default).alias(v) for v, default in values.items()))


def nearest_ancestor(rows: DataFrame, parents: DataFrame, hops: int, default: Column) -> DataFrame:
    """`ancestor`: name reached by following `parent` a fixed number of times; a missing hop gives the default.

    rows has id; parents has id, parent, name.
    """
    out = rows.withColumn("__at", F.col("id"))
    for i in range(hops):
        hop = parents.select(F.col("id").alias("__id"), F.col("parent").alias(f"__parent{i}"))
        out = out.join(hop, F.col("__at") == F.col("__id"), "left").withColumn("__at", F.col(f"__parent{i}")).drop("__id", f"__parent{i}")
    names = parents.select(F.col("id").alias("__id"), F.col("name").alias("__name"))
    return out.join(names, F.col("__at") == F.col("__id"), "left").withColumn("ancestor", F.coalesce("__name", default)).drop("__at", "__id", "__name")


def mapped(rows: DataFrame, name: str, mappings: DataFrame, into: str) -> DataFrame:
    """The name's replacement of the lowest priority among mappings (priority, from_name, to_name), else the name."""
    best = mappings.groupBy("from_name").agg(F.min_by("to_name", "priority").alias("__to"))
    return rows.join(best, F.col(name) == F.col("from_name"), "left").withColumn(into, F.coalesce("__to", name)).drop("from_name", "__to")


def differences(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """column, side: values of left only (missing) and of right only (extra), as sets."""
    a, b = left.select(column), right.select(column)
    return a.subtract(b).withColumn("side", F.lit("missing")).unionAll(b.subtract(a).withColumn("side", F.lit("extra")))


def unseen(rows: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key no earlier run has."""
    return rows.join(seen.select(key).distinct(), key, "left_anti")


#: Characters of a gram; shorter texts are looked up whole.
GRAM = 3


def _grams(text: Column, size: Column) -> Column:
    """Distinct substrings of a size."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substr(text, i, size)))


def contained(inner: DataFrame, a: str, outer: DataFrame, b: str) -> DataFrame:
    """Distinct (a, b) where a occurs in b, whatever their case; neither is empty. No text meets all others.

    The outer texts are indexed by their grams of up to three characters. An inner text is looked up by that of its
    grams which fewest outer texts have, and only those are compared; a gram that none has rules it out.
    """
    texts = outer.select(F.col(b).alias("__b")).filter(F.length("__b") > 0).distinct().withColumn("__l", F.lower("__b"))
    sizes = F.filter(F.sequence(F.lit(1), F.lit(GRAM)), lambda n: n <= F.length("__l"))
    index = texts.select("__b", "__l", F.explode(F.flatten(F.transform(sizes, lambda n: _grams(F.col("__l"), n)))).alias("__g"))
    counts = index.groupBy("__g").agg(F.count("*").alias("__n"))
    terms = inner.select(F.col(a).alias("__a")).filter(F.length("__a") > 0).distinct().withColumn("__t", F.lower("__a"))
    asked = terms.select("__a", "__t", F.explode(_grams(F.col("__t"), F.least(F.lit(GRAM), F.length("__t")))).alias("__g")).join(counts, "__g", "left")
    rarest = asked.groupBy("__a", "__t").agg(F.min(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), F.col("__g").alias("g"))).alias("__r")).filter("__r.n > 0").select("__a", "__t", F.col("__r.g").alias("__g"))
    return rarest.join(index, "__g").filter(F.contains("__l", "__t")).select(F.col("__a").alias(a), F.col("__b").alias(b))


def first_match(terms: DataFrame, organs: DataFrame, term: str, name: str, order: str, two_way: bool = True) -> DataFrame:
    """For each term the first organ, by `order`, whose name holds it (or, two_way, is held by it), else the term, as `resolved`.

    An empty name is held by every term, an empty term by every name; null ones match nothing.
    """
    rank = F.struct(F.col(order).alias("o"), F.col(name).alias("n"))
    leading = organs.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("__name")).agg(F.min(rank).alias("__rank"))
    pairs = contained(terms, term, organs.withColumnRenamed(name, "__name"), "__name")
    if two_way:
        pairs = pairs.unionAll(contained(organs.select(F.col(name).alias("__name")), "__name", terms, term).select(term, "__name"))
    hits = pairs.join(leading, "__name").groupBy(term).agg(F.min("__rank").alias("__rank"))
    every = organs.filter(F.col(name).isNotNull()).agg(F.min(rank).alias("__any"), F.min(F.when(F.col(name) == "", rank)).alias("__empty"))
    out = terms.join(hits, term, "left").crossJoin(F.broadcast(every))  # one row
    best = F.when(F.col(term) == "", F.col("__any")).when(F.col(term).isNull(), None).otherwise(F.least("__rank", "__empty") if two_way else F.col("__rank"))
    return out.withColumn("resolved", F.coalesce(best["n"], term)).drop("__rank", "__any", "__empty")


def levels(*tables: DataFrame) -> DataFrame:
    """Union by name of the levels of a tree; columns that a level lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
