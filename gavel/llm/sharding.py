"""Contiguous, byte-balanced shards from global prefix sums.

The documents are dealt into buckets of consecutive ids. Each bucket is summed (map-side, one row a bucket), the few
totals are added up to one offset a bucket, and a window inside each bucket adds the rest. No task sees more than
its bucket, and nothing but bucket totals is broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavel.llm.rows import quoted

#: Buckets of consecutive ids; totals of so many rows are broadcast. Rounded up to a square number.
BUCKETS = 1024


def _bucket(key: Column, cuts: list, fan: int) -> Column:
    """Number of cuts that are not above key, found in two steps of `fan` comparisons."""
    if not cuts:
        return F.lit(0)
    coarse, every = cuts[fan - 1 :: fan], F.lit(cuts)
    block = F.size(F.filter(F.lit(coarse), lambda c: c <= key)) if coarse else F.lit(0)
    found = F.transform(F.array(block), lambda b: b * fan + F.size(F.filter(F.slice(every, b * fan + 1, fan), lambda c: c <= key)))
    return F.when(key.isNull(), 0).otherwise(found[0])


def prefix_sums(df: DataFrame, key: str, ties: list[Column], measures: dict[str, Column], buckets: int = BUCKETS) -> DataFrame:
    """Add __before_<m> (sum of m over earlier rows) and __all_<m> (over all rows) for each measure m.

    key: integer column that orders the rows, nulls first; ties: what orders rows of an equal key. Rows that agree
    in all of these are interchangeable. An empty input gives no rows.
    """
    fan = max(2, round(buckets**0.5))
    probes = [i / (fan * fan) for i in range(1, fan * fan)]
    cuts = df.agg(F.percentile_approx(F.col(key).cast("long"), probes, 20 * fan * fan).alias("c")).head()["c"] or []
    base = df.withColumn("__bucket", _bucket(F.col(key).cast("long"), sorted(set(cuts)), fan))
    base = reduce(lambda d, m: d.withColumn(f"__own_{m[0]}", m[1]), measures.items(), base)
    named = [f"__tie_{i}" for i in range(len(ties))]
    base = reduce(lambda d, t: d.withColumn(*t), zip(named, ties, strict=True), base)  # before rows move, so that what ties are made of need not
    totals = base.groupBy("__bucket").agg(*(F.sum(f"__own_{m}").alias(f"__sum_{m}") for m in measures))
    earlier, every = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    offsets = totals.select(
        F.col("__bucket").alias("__at"),
        *(F.coalesce(F.sum(f"__sum_{m}").over(earlier), F.lit(0)).alias(f"__off_{m}") for m in measures),
        *(F.sum(f"__sum_{m}").over(every).alias(f"__all_{m}") for m in measures),
    )
    within = Window.partitionBy("__bucket").orderBy(F.col(key).asc_nulls_first(), *named).rowsBetween(Window.unboundedPreceding, 0)
    joined = base.join(F.broadcast(offsets), F.col("__bucket") == F.col("__at"))  # at most `buckets` rows
    out = reduce(lambda d, m: d.withColumn(f"__before_{m}", F.col(f"__off_{m}") + F.sum(f"__own_{m}").over(within) - F.col(f"__own_{m}")), measures, joined)
    return out.drop("__bucket", "__at", *named, *(f"__{x}_{m}" for x in ("own", "off") for m in measures))


def assign_shards(df: DataFrame, shards: int, size: Column, key: str = "doc_id", ties: list[Column] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """df with `shard` (0 to shards - 1) and `slot` (gapless from 0 in each shard), in the order of key.

    A row belongs to the shard whose equal share of all bytes holds the middle of the row, so every cut is off by
    half a row at most. size: non-negative long, never null. A row larger than a share leaves shards empty. Columns
    named shard or slot in df are replaced, all others, of any names, are kept; null keys come first; rows with an equal
    key are ordered by ties.
    """
    ties = ties or []
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    named = {f"__order_{i}": t for i, t in enumerate(ties)}
    rows = df.select(F.struct(*map(quoted, kept)).alias("__own"), quoted(key).alias("__key"), size.alias("__size"), *(t.alias(n) for n, t in named.items()))
    summed = prefix_sums(rows, "__key", [*map(F.col, named), F.col("__size")], {"bytes": F.col("__size"), "rows": F.lit(1).cast("long")}, buckets)
    middle = f"cast(2 * __before_bytes + __size as decimal(38,0)) * {shards} div (2 * __all_bytes)"
    placed = summed.withColumn("shard", F.expr(f"cast(if(__all_bytes = 0, 0, least({shards - 1}, {middle})) as int)"))
    first = placed.groupBy(F.col("shard").alias("__shard")).agg(F.min("__before_rows").alias("__first"))
    out = placed.join(F.broadcast(first), F.col("shard") == F.col("__shard"))  # one row a shard
    return out.select(*(F.col("__own").getField(c).alias(c) for c in kept), "shard", (F.col("__before_rows") - F.col("__first")).alias("slot"))
