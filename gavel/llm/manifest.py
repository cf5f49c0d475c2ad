"""A Merkle manifest of a dataset: a trie over exact ranks.

Every row has a digest, the leaf. Rows of a group are ranked by a key without a global sort: a histogram over the key's
leading digits splits each group into buckets, those that are still large are split by their next differing digit, and
prefix sums over at most 256 sisters at a time give each bucket its first rank; a window inside a small bucket does the
rest. The digits of a rank to the base of the fanout are the trie's keys: nodes that agree in all but the last digit
are one run, whose digests are hashed to their parent's, longest prefixes first, STEP digits in one shuffle. The roots
of the groups, ranked by group, are the leaves of one more trie, whose root stands for the dataset.

On the way back each node gets its path: for each level what stands left and right of it in its run. A path and a
leaf fold to the root, so that one row can be verified without the others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavel.llm.rows import quoted
from gavel.llm.storage import materialise

#: Bits of a digit of a rank; nodes of a run; levels that one shuffle folds; rows of a bucket that one window orders, at most.
BITS, FANOUT, STEP, BUCKET = 3, 8, 3, 4096
#: Hexadecimal digits of the key that split a bucket.
DIGITS = 2


def digest(*parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the parts one after another."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(fields: list[Column]) -> Column:
    """Digest of a row: each field as its number of UTF-8 bytes, a colon and its text; a null is a hyphen."""
    text = lambda c: c.cast("string")
    return digest(*(F.coalesce(F.concat(F.octet_length(text(c)).cast("string"), F.lit(":"), text(c)), F.lit("-")) for c in fields))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda own, level: digest(level["left"], own, level["right"]))


def siblings(path: Column) -> Column:
    """All digests of a path, level by level from the leaf, left to right."""
    return F.array_join(F.transform(path, lambda level: F.concat(level["left"], level["right"])), "")


def _common(lo: Column, hi: Column) -> Column:
    """Number of leading characters that two strings share."""
    upto = F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.length(lo), F.length(hi))))
    return F.size(F.filter(upto, lambda i: F.left(lo, i) == F.left(hi, i)))


def ranked(rows: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """rows (group, key, ...) with rank (from 0, by key, bytewise) and width (rows of the group).

    group and key are strings and never null; the keys of a group are distinct. Only groups and keys are counted, and
    only rows of buckets that are still large are looked at again.
    """
    counted = [F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")]
    sisters = Window.partitionBy("group", "parent").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    found = rows.groupBy("group").agg(*counted).select("group", F.lit("").alias("bucket"), "n", "lo", "hi", F.lit(0).cast("long").alias("first"), F.col("n").alias("width"))
    levels, splits = [materialise(found, "manifest-histogram")], []
    large = (F.col("n") > bucket) & (F.col("lo") < F.col("hi"))
    inside, placed = rows.select("group", "key", F.lit("").alias("bucket")), rows.withColumn("bucket", F.lit(""))
    while not levels[-1].filter(large).isEmpty():
        split = levels[-1].filter(large).select("group", "bucket", "first", "width", (_common(F.col("lo"), F.col("hi")) + DIGITS).alias("depth"))
        inside = inside.join(split.drop("first", "width"), ["group", "bucket"]).select("group", "key", F.col("bucket").alias("parent"), F.expr("left(key, depth)").alias("bucket"))
        counts = inside.groupBy("group", "parent", "bucket").agg(*counted).join(split.select("group", F.col("bucket").alias("parent"), "first", "width"), ["group", "parent"])
        counts = counts.withColumn("first", F.col("first") + F.coalesce(F.sum("n").over(sisters), F.lit(0)))
        levels.append(materialise(counts.select("group", "bucket", "n", "lo", "hi", "first", "width"), "manifest-histogram"))
        inside = inside.drop("parent")
        splits.append(split.select("group", "bucket", "depth"))
    for split in splits:
        placed = placed.join(split, ["group", "bucket"], "left").withColumn("bucket", F.expr("coalesce(left(key, depth), bucket)")).drop("depth")
    whole = reduce(DataFrame.unionAll, [x.filter(~large).select("group", "bucket", "first", "width") for x in levels])
    nth = F.row_number().over(Window.partitionBy("group", "bucket").orderBy("key"))
    return placed.join(whole, ["group", "bucket"]).withColumn("rank", F.col("first") + nth - 1).drop("bucket", "first", "key")


def _nodes(width: Column, level: int) -> Column:
    """Nodes of a group, `level` levels above where it has `width`."""
    return F.ceil(width / F.lit(FANOUT**level))


def _parents(children: Column) -> Column:
    """Digests of the parents of an array of digests, run by run."""
    last = ((F.size(children) - 1) / FANOUT).cast("int")
    # bound as a variable, for an array that is written out inside a lambda would be made anew for each element
    return F.transform(F.array(children), lambda c: F.transform(F.sequence(F.lit(0), last), lambda i: F.sha2(F.array_join(F.slice(c, i * FANOUT + 1, FANOUT), ""), 256)))[0]


def _blocks(nodes: DataFrame, carried: list[str]) -> list[DataFrame]:
    """Tables (group, block, width, items, level_0 ... level_STEP) from the nodes (group, rank, width, digest, carried) upwards.

    A block holds the nodes that share all but the last STEP digits of their rank, and the nodes above them. The last
    table has one block a group.
    """
    tables = []
    while True:
        item = F.struct("rank", "digest", *carried)
        blocks = nodes.groupBy("group", F.expr(f"rank div {FANOUT**STEP}").alias("block")).agg(F.first("width").alias("width"), F.sort_array(F.collect_list(item)).alias("items"))
        blocks = blocks.withColumn("level_0", F.col("items.digest"))
        for k in range(STEP):
            below = F.col(f"level_{k}")
            blocks = blocks.withColumn(f"level_{k + 1}", F.when(_nodes(F.col("width"), k) > 1, _parents(below)).otherwise(below))
        tables.append(materialise(blocks, "manifest-trie"))
        if (tables[-1].agg(F.max("width")).head()[0] or 0) <= FANOUT**STEP:
            return tables
        carried = []
        nodes = tables[-1].select("group", F.col("block").alias("rank"), _nodes(F.col("width"), STEP).alias("width"), F.col(f"level_{STEP}")[0].alias("digest"))


def _own_path(at: Column) -> Column:
    """Path within a block of the item at a place in it."""
    levels = []
    for k in range(STEP):
        place = F.shiftright(at, BITS * k)
        own = place.bitwiseAND(FANOUT - 1)
        run = F.slice(f"level_{k}", place - own + 1, FANOUT)
        joined = F.struct(F.array_join(F.slice(run, F.lit(1), own), "").alias("left"), F.array_join(F.slice(run, own + 2, FANOUT), "").alias("right"))
        levels.append(F.when(_nodes(F.col("width"), k) > 1, joined))
    return F.filter(F.array(*levels), lambda level: level.isNotNull())


def _paths(tables: list[DataFrame], tops: DataFrame, carried: list[str]) -> DataFrame:
    """group, rank, digest, carried, path and the other columns of tops for every node of the lowest table.

    tops: group, path and more, one row a group: how its root goes on upwards.
    """
    more = [c for c in tops.columns if c not in ("group", "path")]
    above, keys = tops.withColumn("block", F.lit(0).cast("long")), ["group", "block"]
    for depth, table in enumerate(reversed(tables)):
        names = ["rank", "digest", *(carried if depth == len(tables) - 1 else [])]
        items = F.transform("items", lambda x, at: F.struct(*(x[n].alias(n) for n in names), F.concat(_own_path(at), F.col("path")).alias("path")))  # noqa: B023
        above = table.join(above, keys).select("group", *more, F.inline(items))
        if depth < len(tables) - 1:
            above = above.select("group", *more, F.col("rank").alias("block"), "path")
    return above


def manifest(docs: DataFrame, fields: list[str], key: str = "doc_id", group: str = "lang", carry: dict[str, Column] | None = None, bucket: int = BUCKET) -> DataFrame:
    """key, group, rank, leaf, subroot, root, path (array of left, right), and the columns of `carry`, for every row.

    fields: columns that are hashed, in this order. Within a group rows are ranked by key (an integer, null first),
    equal keys by the leaf; rows that agree in both are interchangeable. Groups are ranked bytewise, null first. A
    lone leaf is its group's root, a lone group's root the dataset's. Texts of any length count whole; columns that
    are not named are ignored, whatever their names; an empty table gives no rows. Names in `carry` must not clash
    with those of the result.
    """
    carry = carry or {}
    number = F.col("__key")
    signed = F.concat(F.lit("1"), F.lpad(F.hex(number.bitwiseXOR(F.lit(-(2**63)))), 16, "0"))
    rows = docs.select(quoted(key).cast("long").alias("__key"), quoted(group).alias("__group"), leaf_digest([quoted(f) for f in fields]).alias("digest"), *(c.alias(n) for n, c in carry.items()))
    named = F.coalesce(F.concat(F.lit("="), F.col("__group").cast("string")), F.lit(""))
    unique = F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0")  # read from the written table, so a lost task changes nothing
    rows = rows.withColumn("group", named).withColumn("key", F.concat(F.coalesce(signed, F.lit("0")), F.left("digest", F.lit(16)), unique))
    held = ["__key", "__group", *carry]
    tables = _blocks(ranked(materialise(rows, "manifest-leaves"), bucket), held)
    top = F.col(f"level_{STEP}")[0]
    groups = tables[-1].select(F.lit("").alias("group"), F.hex("group").alias("key"), F.col("group").alias("name"), top.alias("digest"))
    upper = _blocks(ranked(groups, bucket), ["name"])
    root = upper[-1].select("group", top.alias("root"), F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    tops = _paths(upper, root, ["name"]).select(F.col("name").alias("group"), F.col("digest").alias("subroot"), "root", "path")
    return _paths(tables, tops, held).select(F.col("__key").alias(key), F.col("__group").alias(group), "rank", F.col("digest").alias("leaf"), "subroot", "root", "path", *carry)
