"""Crawls of folders to a fixpoint: each round expands what is new, until nothing is.

The frontier of a round are the keys that its predecessor found and none before it had. Rounds are written to the
shared folder, so that the plan of a round reads two tables instead of all rounds before, and a lost executor costs
one round at most. Keys that were seen are left out by an anti join, so cycles and folders with many parents end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavel.operators import ordered
from gavel.session import scratch


def reached(starts: DataFrame, expand: Callable[[DataFrame], DataFrame], keys: list[str], depth: int | None = None) -> DataFrame:
    """The rows of starts and all that expand finds from them, each key once: by the shortest way, and `depth` of it.

    expand: from a frontier (columns of starts) to candidates (the same columns); it may bring what is known, or rows
    that repeat. Of candidates with one key in one round the least by its other columns counts. Null keys end a way.
    depth: rounds at most; None: until the frontier is empty.
    """
    spark, folder, number = starts.sparkSession, scratch(starts.sparkSession, "crawl"), 0
    others = [c for c in starts.columns if c not in keys]
    schema = starts.withColumn("depth", F.lit(0)).schema
    seen = spark.createDataFrame([], schema)
    found = starts
    while depth is None or number <= depth:
        first = found.select(*keys, *others).dropna(subset=keys).groupBy(*keys).agg(F.min(F.struct(*others)).alias("__o") if others else F.count("*").alias("__o"))
        fresh = first.select(*keys, *([f"__o.{c}" for c in others])).withColumn("depth", F.lit(number)).select(*schema.names)
        new = fresh.join(seen.select(*keys), keys, "left_anti").select(*schema.names) if number else fresh
        new.write.parquet(f"{folder}/round={number}")
        frontier = spark.read.schema(schema).parquet(f"{folder}/round={number}")
        if frontier.isEmpty():
            break
        # every round is a folder of its own: what was seen is read from all of them, keys alone
        seen = spark.read.schema(schema).option("basePath", folder).parquet(folder)
        found, number = expand(frontier.select(*starts.columns)), number + 1
    return spark.read.schema(schema).parquet(*[f"{folder}/round={k}" for k in range(max(1, number))])


def through_pages(pages: DataFrame, links: Callable[[DataFrame], DataFrame], key: str = "path") -> Callable[[DataFrame], DataFrame]:
    """An expand for `reached`: from keys to the pages (key, ...) that they name, and to the keys that `links` finds on them.

    pages: a table, or what a page source reads; it is joined, so that a frontier of any size is one job.
    """

    def expand(frontier: DataFrame) -> DataFrame:
        return links(pages.join(frontier.select(key), key))

    return expand


CHOICES, ROOTS = ("year", "all", "last"), ("never", "also", "instead")


def subfolders(links: DataFrame, index: DataFrame, keys: list[str], pattern: str, choose: str = "all", since: int | None = None, months: int = 12, root: str = "never") -> DataFrame:
    """link, pos: the sub-folders of a page that are worth reading, from its links (keys, pos, link).

    Links that match the pattern count once. Of these: `year` keeps those whose last year in the link is `since` or
    later (and those without any), `last` the newest that hold so many months, by their place on the page, `all` all.
    root: whether the page itself (index: keys, link) is read too: never, also, or instead where no link matched.
    """
    if choose not in CHOICES or root not in ROOTS:
        raise ValueError(f"choose is one of {', '.join(CHOICES)}, root one of {', '.join(ROOTS)}")
    matched = ordered.first_occurrence(links.filter(F.col("link").rlike(pattern)).select(*keys, "pos", "link"), ["link"], ["pos"], keys)
    kept = matched
    if choose == "year":
        year = F.regexp_extract("link", r"(?s).*(?<!\d)((?:19|20)\d{2})(?!\d)", 1)  # the last one: folders above may be numbered like years
        kept = matched.filter((year == "") | (year.try_cast("int") >= since))
    elif choose == "last":
        kept = ordered.ends(matched, ordered.folders_to_read(months), keys, ["pos"], last=True)
    if root == "never":
        return kept
    own = index if root == "also" else index.join(matched.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(own.select(*keys, F.lit(-1).cast("long").alias("pos"), "link"))
