"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled by a hash and laid end to end; the words are cut into equal blocks. The slots of
the mix follow the van der Corput sequence: the i-th point, mapped through the cumulative target weights, names the
source of slot i, so every stretch of the schedule is close to the weights. The r-th slot of a source takes its r-th
block, over again once all are taken. Blocks grow with the mix; a source whose target is only a few of them would get
no slot or far too many words, so it has a schedule of its own, in slots of one word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavel.llm.rows import packed, unpacked
from gavel.llm.storage import materialise

#: Words: maximal runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Least number of slots (less where the mix has fewer words) and most words in a slot.
SLOTS, SLOT_WORDS = 1 << 16, 1 << 22
#: Least target of a source in the common schedule, in slots: it gets one more or less at most, and its blocks are off by less.
LEAST_SLOTS = 200
#: Rows of a source that one window task orders, about.
ROWS_A_TASK = 50_000
#: Most sources whose places are broadcast (about 100 bytes each).
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    """Number of words of text; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """One row a source: __src (rank by code point, null last), source, words, target.

    The targets share `share` times all words by weight (the tuple repeats over the ranks); none exceeds cap times
    its source's words, and what is above goes to the others by weight. Raising all targets at one level per weight
    until the budget is spent gives the same: sources reach their caps in the order of cap / weight.
    """
    by_code_point = Window.orderBy(F.col("source").asc_nulls_last())
    totals = sized.groupBy("source").agg(F.sum("size").cast("long").alias("words"))
    ranked = totals.withColumn("__src", (F.row_number().over(by_code_point) - 1).cast("int"))
    weight = F.element_at(F.lit([float(w) for w in weights]), (F.col("__src") % len(weights) + 1).cast("int"))
    filling = Window.orderBy("__ratio", "__src")
    level = (
        ranked.withColumn("__w", weight)
        .withColumn("__cap", F.lit(float(cap)) * F.col("words"))
        .withColumn("__ratio", F.col("__cap") / F.col("__w"))
        .withColumn("__budget", F.lit(float(share)) * F.sum("words").over(Window.partitionBy()))
        .withColumn("__spent", F.coalesce(F.sum("__cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("__open", F.sum("__w").over(filling.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("__try", (F.col("__budget") - F.col("__spent")) / F.col("__open"))
        .withColumn("__level", F.min(F.when(F.col("__try") <= F.col("__ratio"), F.struct("__ratio", "__src", "__try"))).over(Window.partitionBy())["__try"])
    )
    return level.select("__src", "source", "words", F.least(F.col("__cap"), F.coalesce(F.col("__level") * F.col("__w"), F.col("__cap"))).alias("target"))


def schedule(spark, targets: DataFrame, slots: int) -> DataFrame:
    """slot, __src, rank: the source of each of `slots` slots (a power of two) and its rank among the source's slots.

    Ranks come from counts per block of slots and source, so no task orders more than one block of one source.
    """
    bits = slots.bit_length() - 1
    edge = Window.orderBy("__src").rowsBetween(Window.unboundedPreceding, 0)
    upto = targets.withColumn("__high", F.sum("target").over(edge)).withColumn("__sum", F.sum("target").over(Window.partitionBy()))
    # one array over all sources: the point is looked up by counting the edges at or below it, in two steps
    edges = upto.agg(F.sort_array(F.collect_list(F.struct(F.coalesce(F.try_divide("__high", "__sum"), F.lit(1.0)).alias("high"), "__src"))).alias("__edges"), F.count("*").alias("__n"))
    point = F.conv(F.reverse(F.lpad(F.bin(F.col("slot")), bits, "0")), 2, 10).cast("double") / slots if bits else F.lit(0.0)
    step = F.greatest(F.lit(1), F.ceil(F.sqrt(F.col("__n"))).cast("int"))
    strides = F.transform(F.sequence(step, F.greatest(step, F.col("__n").cast("int")), step), lambda i: F.get(F.col("__edges.high"), i - 1))
    at = spark.range(slots).withColumnRenamed("id", "slot").join(F.broadcast(edges.withColumn("__step", step).withColumn("__strides", strides)))  # one row on the right
    at = at.withColumn("__point", point).withColumn("__block", F.size(F.filter("__strides", lambda h: h <= F.col("__point"))) * F.col("__step"))
    inner = F.size(F.filter(F.slice(F.col("__edges.high"), F.col("__block") + 1, F.col("__step")), lambda h: h <= F.col("__point")))
    named = at.select("slot", F.least(F.col("__block") + inner, F.col("__n").cast("int") - 1).alias("__src"), F.floor(F.col("slot") / 65536).alias("__part"))
    counts = named.groupBy("__src", "__part").agg(F.count("*").alias("__c"))
    earlier = Window.partitionBy("__src").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__src", "__part", F.coalesce(F.sum("__c").over(earlier), F.lit(0)).alias("__off"))
    within = Window.partitionBy("__src", "__part").orderBy("slot")
    return named.withColumn("__rn", F.row_number().over(within)).join(offsets, ["__src", "__part"]).select("slot", "__src", (F.col("__off") + F.col("__rn") - 1).alias("rank"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: int = 2, seed: str = "mix", slots: int = SLOTS) -> DataFrame:
    """doc_id, source, text_md5, size, source_size, target, taken: how many words of each document the mix takes.

    docs needs doc_id, source and text; other columns are ignored. Null texts have size 0 and are never taken. Rows
    that agree in all three columns are interchangeable. Empty input gives an empty result.
    """
    spark = docs.sparkSession
    sized = materialise(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))
        .withColumn("__order", F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_md5")))),
        "mix-sizes",
    )
    rows, words = sized.agg(F.count("*"), F.sum("size")).head()
    digits = next(d for d in range(1, 9) if 16**d * ROWS_A_TASK >= rows or d == 8)
    total = int(share * (words or 0))
    slots = max(1, 1 << (max(min(slots, total), total // SLOT_WORDS) - 1).bit_length()) if total else 1
    targets = materialise(source_targets(sized, weights, share, cap), "mix-targets")
    block_words = max(1e-9, share * (words or 0) / slots)
    own = F.col("target") < LEAST_SLOTS * block_words
    plan = targets.filter(~own).withColumn("__blocks", F.greatest(F.lit(1), F.round(F.col("words") / block_words)).cast("long"))

    keyed = sized.join(targets.withColumnRenamed("words", "source_size").withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    # where a document lies among its source's words: totals per source and hash prefix, then a window inside each
    keyed = keyed.withColumn("__part", F.substring("__order", 1, digits))
    sums = keyed.groupBy("__src", "__part").agg(F.sum("size").alias("__s"))
    earlier = Window.partitionBy("__src").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("__src", "__part", F.coalesce(F.sum("__s").over(earlier), F.lit(0)).alias("__off"))
    within = Window.partitionBy("__src", "__part").orderBy("__order", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    laid = keyed.withColumn("__end", F.sum("size").over(within)).join(offsets, ["__src", "__part"]).withColumn("__start", F.col("__off") + F.col("__end") - F.col("size")).drop("__end", "__off", "__part")
    laid = materialise(laid, "mix-laid")

    # how often the schedule takes each block; blocks are cut at equal numbers of words
    taken = schedule(spark, targets, slots).join(plan.select("__src", "words", "__blocks"), "__src")
    taken = taken.withColumn("__block", F.col("rank") % F.col("__blocks")).groupBy("__src", "__block").agg(F.least(F.count("*"), F.lit(cap)).alias("__times"), F.first("words").alias("words"), F.first("__blocks").alias("__blocks"))
    cut = "cast({} as decimal(38,0)) * words div __blocks"
    taken = taken.select("__src", "__block", "__times", F.expr(cut.format("__block")).alias("__from"), F.expr(cut.format("__block + 1")).alias("__to"))

    block_of = "(cast({} + 1 as decimal(38,0)) * __blocks - 1) div words"  # the block that holds a word
    pieces = laid.filter("size > 0").select("__src", "__start", "size").join(plan.select("__src", "words", "__blocks"), "__src")
    pieces = pieces.withColumn("__block", F.explode(F.sequence(F.expr(block_of.format("__start")), F.expr(block_of.format("__start + size - 1"))))).select("__src", "__start", "size", "__block")
    parts = pieces.join(taken, ["__src", "__block"])
    overlap = F.least(F.col("__to"), F.col("__start") + F.col("size")) - F.greatest(F.col("__from"), F.col("__start"))
    got = parts.groupBy(F.col("__src").alias("__s"), F.col("__start").alias("__at")).agg(F.sum(F.greatest(overlap, F.lit(0)) * F.col("__times")).alias("taken"))
    joined = laid.join(got, (F.col("__src") == F.col("__s")) & (F.col("__start") == F.col("__at")) & (F.col("size") > 0), "left")
    # slots of one word take all words of a source some times, and the first of them once more
    whole = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    more = F.round("target").cast("long") - whole * F.col("source_size")
    by_word = whole * F.col("size") + F.least(F.col("size"), F.greatest(more - F.col("__start"), F.lit(0)))
    return joined.select("doc_id", "source", "text_md5", "size", "source_size", "target", F.when(own, by_word).otherwise(F.coalesce("taken", F.lit(0))).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, seed: str = "mix", broadcast_sources: int = BROADCAST_SOURCES, **options) -> DataFrame:
    """The rows of docs as often as the mix takes them, to the nearest whole document; all columns, of any names, are kept.

    A document that the mix takes for half its words or more appears once, from one and a half times on twice; one
    without words never. Within a source the schedule takes the first documents of the shuffled order once more often
    than the rest, so one place in that order a source says how often each is taken, and texts need not move. Rows
    that agree in id and text have the same place: they are taken alike.
    """
    order = lambda key: F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), key))
    plan = mix(docs, seed=seed, **options).filter("size > 0")
    plan = plan.select(F.col("source").alias("__source"), order(F.col("text_md5")).alias("__order"), F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("__copies"))
    lasts = plan.groupBy("__source", "__copies").agg(F.max("__order").alias("__order"))  # two rows a source
    lasts = materialise(lasts.groupBy("__source").agg(F.min("__copies").alias("__least"), F.max("__copies").alias("__most"), F.max_by("__order", "__copies").alias("__last")), "mix-lasts")
    lasts = F.broadcast(lasts) if lasts.count() <= broadcast_sources else lasts
    own = packed(docs, "doc_id", "text", "source")
    joined = own.filter(F.col("text").rlike(WORD)).join(lasts, F.col("source").eqNullSafe(F.col("__source")))
    copies = F.when(order(F.md5("text")) <= F.col("__last"), F.col("__most")).otherwise(F.col("__least"))
    taken = joined.withColumn("__copies", copies).filter("__copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return unpacked(taken, docs, "doc_id", "text", "source")
