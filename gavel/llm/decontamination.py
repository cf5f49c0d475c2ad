"""Benchmark decontamination: hash windows of test words, scan training windows, verify hits, remove.

A word is a maximal run of ASCII letters, digits and non-ASCII characters, with A-Z lower-cased. The windows of the
benchmark go into a hash table that is broadcast when it is small; each document is cut into words and windows once,
row by row, and only windows whose hash is in the table leave the scan, where the words themselves are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavel.llm.rows import packed, unpacked
from gavel.llm.storage import materialise

#: Everything that separates words, after lower-casing and before.
SEPARATORS, ANY_CASE = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a window; most windows of a benchmark that are broadcast (about 200 bytes each), beyond them a shuffle.
WINDOW, BROADCAST_WINDOWS = 13, 500_000
#: Most contaminated documents whose keys are broadcast (about 50 bytes each); beyond them the texts are shuffled.
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    """Array of the words of text, lower-cased in ASCII; empty for null."""
    text = F.coalesce(text, F.lit(""))
    lower = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))  # lower() is quick on ASCII
    return F.filter(F.split(lower, SEPARATORS), lambda w: w != "")


def count_words(text: Column) -> Column:
    """Number of words of text, for which the case need not be changed; 0 for null."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), ANY_CASE), lambda w: w != "")).cast("long")


def _joined(tokens: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(tokens, start + 1, length), " ")


def _hash(tokens: str, length: int, start: Column) -> Column:
    """Hash of `length` words from a 0-based place; words beyond the end add nothing."""
    return F.xxhash64(*(F.get(F.col(tokens), start + i) for i in range(length)))


def benchmark_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """item_id, length, phrase, hash: the distinct windows of each item; an item of fewer words is one window."""
    cut = items.select("item_id", words(F.col("text")).alias("__words")).filter(F.size("__words") > 0)
    length = F.least(F.size("__words"), F.lit(size))
    at = cut.withColumn("length", length).withColumn("__at", F.explode(F.sequence(F.lit(0), F.size("__words") - F.col("length"))))
    at = at.withColumn("__phrase", F.slice("__words", F.col("__at") + 1, F.col("length")))
    return at.select("item_id", "length", F.array_join("__phrase", " ").alias("phrase"), _hash("__phrase", size, F.lit(0)).alias("hash")).distinct()


def find_hits(docs: DataFrame, items: DataFrame, size: int = WINDOW, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """One row for each distinct (doc_id, text) with a hit: __id, __key, __n_words, n_hit, item_ids (array of strings, sorted).

    A document word is hit if it lies in any occurrence of a window. Rows that agree in doc_id and text share a row;
    __key is a hash of the text. Null or wordless texts and items match nothing.
    """
    listed = materialise(benchmark_windows(items, size), "bench-windows")
    lengths = [r["length"] for r in listed.select("length").distinct().collect()]  # at most `size` values
    table = listed.select("hash", "length", "phrase").distinct()
    small = listed.count() <= broadcast_windows
    if not lengths:
        lengths = [size]
    cut = docs.select(F.col("doc_id").alias("__id"), key(F.col("text")).alias("__key"), words(F.col("text")).alias("__words"))
    # positions are exploded and windows hashed in generated code; words and windows stay in the task that read the text
    # (explode_outer, since the filter that Spark infers for explode would cut every text into words once more)
    starts = F.when(F.size("__words") >= min(lengths), F.sequence(F.lit(0), F.size("__words") - min(lengths)))
    fits = cut.select("*", F.explode_outer(starts).alias("__at")).filter("__at is not null")
    if len(lengths) == 1:
        scan = fits.select("*", F.lit(lengths[0]).alias("__n"), _hash("__words", lengths[0], F.col("__at")).alias("__h"))
    else:
        each = F.explode(F.array(*(F.struct(F.lit(n).alias("n"), _hash("__words", n, F.col("__at")).alias("h")) for n in lengths)))
        scan = fits.select("*", each.alias("__w")).filter(F.col("__at") + F.col("__w.n") <= F.size("__words")).select("__id", "__key", "__words", "__at", F.col("__w.n").alias("__n"), F.col("__w.h").alias("__h"))
    phrase = _joined(F.col("__words"), F.col("__at"), F.col("__n"))
    if small:
        found = scan.withColumn("__size", F.size("__words")).join(F.broadcast(table), F.col("__h") == F.col("hash")).filter((F.col("__n") == F.col("length")) & (phrase == F.col("phrase")))
    else:  # the table is dealt by hash instead, and only phrases travel to it
        scan = scan.select("__id", "__key", "__at", "__n", "__h", F.size("__words").alias("__size"), phrase.alias("__phrase"))
        found = scan.join(table, (F.col("__h") == F.col("hash")) & (F.col("__phrase") == F.col("phrase")))
    hits = materialise(found.select("__id", "__key", F.col("__at").alias("at"), F.col("__n").alias("n"), "hash", "length", "phrase", "__size").distinct(), "bench-hits")
    covered = F.aggregate(
        F.sort_array(F.collect_list(F.struct("at", "n"))),
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("hit")),
        lambda acc, w: F.struct(F.greatest(acc["end"], w["at"] + w["n"]).alias("end"), (acc["hit"] + F.greatest(F.lit(0), w["at"] + w["n"] - F.greatest(acc["end"], w["at"]))).alias("hit")),
        lambda acc: acc["hit"].cast("long"),
    )
    counted = hits.groupBy("__id", "__key").agg(covered.alias("n_hit"), F.first("__size").cast("long").alias("__n_words"))
    owners = hits.select("__id", "__key", "hash", "length", "phrase").distinct().join(listed, ["hash", "length", "phrase"])
    owners = owners.groupBy("__id", "__key").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    same = counted["__id"].eqNullSafe(owners["__id"]) & (counted["__key"] == owners["__key"])
    return counted.join(owners, same).select(counted["__id"], counted["__key"], "__n_words", "n_hit", "item_ids")


def key(text: Column) -> Column:
    """128 bits that stand for a text in joins; null counts as empty."""
    return F.md5(F.coalesce(text, F.lit("")))


def contamination(docs: DataFrame, items: DataFrame, share: int = 20, **options) -> DataFrame:
    """All columns of docs and n_words, n_hit, item_ids, contaminated (n_hit > 0 and share * n_hit >= n_words).

    Columns of these names in docs are replaced. Every row stays, repeated rows and null texts too.
    """
    found = find_hits(docs, items, **options)
    own = docs.drop("n_words", "n_hit", "item_ids", "contaminated").withColumn("__text_key", key(F.col("text")))
    joined = own.withColumn("n_words", count_words(F.col("text"))).join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_key") == F.col("__key")), "left")
    joined = joined.withColumn("n_hit", F.coalesce("n_hit", F.lit(0)).cast("long")).withColumn("item_ids", F.coalesce("item_ids", F.array().cast("array<string>")))
    return joined.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).drop("__id", "__key", "__n_words", "__text_key")


def decontaminate(docs: DataFrame, items: DataFrame, share: int = 20, broadcast_rows: int = BROADCAST_ROWS, **options) -> DataFrame:
    """docs without its contaminated rows (n_hit > 0 and share * n_hit >= n_words), with the columns of docs, of any names.

    Only keys of the contaminated ones are gathered; while they are few, they go to the texts. Null texts stay.
    """
    bad = find_hits(docs, items, **options).filter(share * F.col("n_hit") >= F.col("__n_words")).select("__id", "__key")
    bad = materialise(bad, "bench-bad")
    bad = F.broadcast(bad) if bad.count() <= broadcast_rows else bad
    own = packed(docs, "doc_id", "text")
    return unpacked(own.join(bad, F.col("doc_id").eqNullSafe(F.col("__id")) & (key(F.col("text")) == F.col("__key")), "left_anti"), docs, "doc_id", "text")
