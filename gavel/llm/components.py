"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavel.llm.storage import materialise


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of links (columns a, b): root is the smallest node that can be reached.

    Each round points neighbours at the smallest node next to them and writes the links anew; it ends when they are
    stars. Groups are only ever reduced to their minimum, map-side first, so a huge component is no single task.
    """
    edges = materialise(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _are_stars(edges):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(lowest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))  # larger neighbours go to the minimum
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        edges = materialise(small.filter("a <> b").distinct(), "links")
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)


def _are_stars(edges: DataFrame) -> bool:
    """Whether each larger end has one link, and is no smaller end."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("b").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e"))
    counted = ends.groupBy("e.x").agg(F.sum("e.up").alias("up"), F.sum("e.down").alias("down"))
    return counted.filter("up > 1 or (up > 0 and down > 0)").isEmpty()
