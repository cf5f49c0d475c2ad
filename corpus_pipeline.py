"""The corpus pipeline: language ID, near-duplicates, decontamination, mixing, sharding.

Each stage works on all that its predecessor kept and is written and read again before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavel.llm import decontamination, language, mixing, neardup, sharding
from gavel.llm.storage import materialise, remove, scope
from gavel.session import table

#: Shards of the result.
SHARDS = 24


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found; those whose text is null, empty or has no letter go. Repeated rows stay.

    Texts of any length are read whole. Columns of any name are kept as they are, lang_pred and score too.
    """
    return language.identified(docs, language.train(docs))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies: shingles of five words, similarity of 0.8 or more.

    The smallest id of a group stays, texts without words each; of rows that repeat id and text one stays. Texts of any
    length count whole. Columns of any name are kept as they are.
    """
    return neardup.deduplicate(docs, words=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark passages; those without words, and repeated rows, stay.

    Texts of any length are searched whole. Columns of any name are kept as they are.
    """
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, a null source being one; those without words are never taken.

    A text of any length is one document. Columns of any name are kept as they are.
    """
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot, in order of id (nulls first) and of a hash of text and source.

    A text longer than a shard fills more than one. Columns of any name are kept as they are, but for shard and slot
    that documents have already: these are kept as shard_before and slot_before (with more such endings if needed).
    """
    for name in [c for c in docs.columns if c.lower() in ("shard", "slot")]:
        free = f"{name}_before"
        while free.lower() in (c.lower() for c in docs.columns):
            free += "_before"
        docs = docs.withColumnRenamed(name, free)
    size = (F.octet_length(F.coalesce("text", F.lit(""))) + 8).cast("long")
    return sharding.assign_shards(docs, SHARDS, size, ties=[F.xxhash64("text", "source")])


STAGES = [("language_id", identify), ("near_dedup", deduplicate), ("decontamination", decontaminate), ("mixing", mix), ("sharding", shard)]
#: SQL cannot express the first stage; a test holds run() against plain Python, with that stage's predictions given.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of sf_dir after all stages. What a stage has written goes once the next one's result is there."""
    docs, earlier = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with scope(spark) as written:
            docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
            own = written.pop()
        remove(spark, *earlier)
        earlier = [own]
    return STAGES[-1][1](spark, docs, sf_dir)
