"""Crawls to a fixpoint: cycles, many parents, nulls, bounds, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from gavel.operators import crawl


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "up string, path string, label string")


def over(links):
    return lambda frontier: frontier.select(F.col("path").alias("up")).join(links, "up").select("path", "label")


def starts(spark, *keys):
    return spark.createDataFrame([(k, "start") for k in keys], "path string, label string")


def test_random_graphs(spark):
    rng = random.Random(3)
    pairs = [(str(rng.randrange(60)), str(rng.randrange(60)), f"l{rng.randrange(3)}") for _ in range(140)] + [("0", "1", "b"), ("1", "2", "b"), ("2", "3", "b"), ("3", "0", "b"), ("0", None, "x"), ("0", "0", "a")]
    want, frontier = {"0": ("start", 0), "7": ("start", 0)}, {"0", "7"}
    depth = 0
    while frontier:
        depth += 1
        new = {}
        for up, path, label in pairs:
            if up in frontier and path is not None and path not in want:
                new[path] = min(new.get(path, label), label)
        want |= {k: (label, depth) for k, label in new.items()}
        frontier = set(new)
    found = crawl.reached(starts(spark, "0", "7", "0"), over(edges(spark, pairs)), ["path"])
    assert {r["path"]: (r["label"], r["depth"]) for r in found.collect()} == want
    assert max(d for _, d in want.values()) >= 4
    two = crawl.reached(starts(spark, "0", "7"), over(edges(spark, pairs)), ["path"], depth=2)
    assert {r["path"]: (r["label"], r["depth"]) for r in two.collect()} == {k: v for k, v in want.items() if v[1] <= 2}


def test_ends(spark):
    chain = edges(spark, [(str(k), str((k + 1) % 9), "n") for k in range(9)])  # a circle of nine
    assert sorted(r["depth"] for r in crawl.reached(starts(spark, "4"), over(chain), ["path"]).collect()) == list(range(9))
    assert crawl.reached(starts(spark), over(chain), ["path"]).count() == 0
    assert crawl.reached(starts(spark, None), over(chain), ["path"]).count() == 0
    assert crawl.reached(starts(spark, "none"), over(chain), ["path"]).count() == 1


def test_pages_that_are_not_there_end_a_way(spark):
    pages = spark.createDataFrame([("a", "b c"), ("b", "a missing")], "path string, body string")
    expand = crawl.through_pages(pages, lambda read: read.select(F.explode(F.split("body", " ")).alias("path"), F.lit("x").alias("label")))
    assert {r["path"] for r in crawl.reached(starts(spark, "a"), expand, ["path"]).collect()} == {"a", "b", "c", "missing"}


def test_wrong_choices(spark):
    none = spark.createDataFrame([], "k int, pos long, link string")
    for wrong in ({"choose": "some"}, {"root": "maybe"}):
        with pytest.raises(ValueError, match="one of"):
            crawl.subfolders(none, none, ["k"], "x", **wrong)


def test_years_in_links(spark):
    links = spark.createDataFrame([(1, i, x) for i, x in enumerate(["/pv/2023/", "/pv/2024", "/pv/oud", "/pv/12024", "/pv/2024", "/nieuws/2024"])], "k int, pos long, link string")
    kept = crawl.subfolders(links, links.select("k", "link").limit(0), ["k"], "^/pv/", "year", since=2024)
    assert sorted((r["pos"], r["link"]) for r in kept.collect()) == [(1, "/pv/2024"), (2, "/pv/oud"), (3, "/pv/12024")]
