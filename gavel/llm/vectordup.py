"""Near-duplicate vectors of one label by cross-polytope hashing.

A vector is turned by three rounds of random signs and a fast Hadamard transform; the coordinate of largest size, with
its sign, is a hash. Some hashes together name a bucket of a table. A vector is posted under the buckets of least loss
(probes), which are its own and those that it just misses, in each of a few tables; vectors that share a bucket are
candidates, and a candidate is a link only if its cosine says so.

Equal vectors are one node. Nodes that crowd a bucket are gathered in balls first: a ball has a leader, and members
within half of the largest angle of a link, so that all its members are linked with each other. From then on buckets
hold balls (a node outside is a ball of its own), and two balls are settled by the angle of their leaders where their
radii allow it, else member by member against a leader, else pair by pair. A crowd of m vectors near to each other
costs about m times the number of its balls, instead of the square of m.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavel.llm.components import components
from gavel.llm.neighbours import usable
from gavel.llm.storage import materialise

#: Least cosine of a link; tables. A pair of just that cosine (64 components, 3 hashes) is missed with probability 3e-5.
COSINE, TABLES = 0.93, 6
#: Vectors of a label times this fit into the buckets of a table, about one each: so many hashes make a bucket.
SPREAD = 16
#: Nodes of a bucket that are gathered in balls, at least; tables that balls are gathered in; margin of angles.
CROWD, GATHERINGS, MARGIN = 16, 3, 1e-6


def hadamard(points: np.ndarray) -> np.ndarray:
    """Rows of points (their length a power of two) after the fast Hadamard transform."""
    rows, n, h = *points.shape, 1
    while h < n:
        pairs = points.reshape(rows, -1, 2, h)
        points = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(rows, n)
        h *= 2
    return points / math.sqrt(n)


def probes(hashes: int) -> int:
    """Buckets of a table that a vector is posted under: they make up for what more hashes lose."""
    return 2**hashes


def hashes_for(rows: int, length: int) -> int:
    """Hashes of a bucket, for so many vectors of a label."""
    return max(1, math.ceil(math.log(max(2, SPREAD * rows)) / math.log(2 * _wide(length))))


def _wide(length: int) -> int:
    return max(2, 1 << (length - 1).bit_length())


def buckets(points: np.ndarray, hashes: int, tables: int = TABLES) -> np.ndarray:
    """Codes of the buckets of each row, table by table, a vector's own bucket of a table first."""
    wide = _wide(points.shape[1])
    points = np.pad(points / np.linalg.norm(points, axis=1, keepdims=True), ((0, 0), (0, wide - points.shape[1])))
    deep = min(wide, 3 if hashes <= 4 else 2)
    choices = np.array(list(itertools.product(range(deep), repeat=hashes)))
    count, signs, out = min(probes(hashes), len(choices)), np.random.default_rng(13).choice([-1.0, 1.0], size=(tables, hashes, 3, wide)), []
    for table in range(tables):
        code, loss = np.zeros((len(points), len(choices)), dtype=np.int64), np.zeros((len(points), len(choices)))
        for k in range(hashes):
            turned = points
            for s in signs[table, k]:
                turned = hadamard(turned * s)
            size = np.abs(turned)
            best = np.argsort(-size, axis=1, kind="stable")[:, :deep]
            height, value = np.take_along_axis(size, best, 1), best + wide * (np.take_along_axis(turned, best, 1) < 0)
            code = code * (2 * wide) + value[:, choices[:, k]]
            loss += (height[:, :1] - height[:, choices[:, k]]) ** 2
        out.append(np.take_along_axis(code, np.argsort(loss, axis=1, kind="stable")[:, :count], 1))
    return np.concatenate(out, axis=1)


def _posted(nodes: DataFrame, hashes: dict[int, int]) -> DataFrame:
    """node, table, own (whether it is the node's own bucket), bucket: hashes: hashes of a bucket by length of vectors."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, found = batch.column("v"), [None] * len(batch)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                points = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), size)
                for lo in range(0, len(at), 1024):
                    for i, codes in zip(at[lo : lo + 1024], buckets(points[lo : lo + 1024], hashes[int(size)]), strict=True):
                        found[i] = codes
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("node", "label", "size")] + [pa.array(found, pa.list_(pa.int64()))], ["node", "label", "size", "codes"])

    coded = nodes.select("node", F.col("label").cast("string").alias("label"), F.size("v").alias("size"), "v").mapInArrow(post, "node long, label string, size int, codes array<long>")
    each = coded.select("node", "label", "size", (F.size("codes") / TABLES).cast("int").alias("per"), F.posexplode("codes").alias("at", "code"))
    table = F.floor(F.col("at") / F.col("per")).cast("int")
    return each.select("node", table.alias("table"), (F.col("at") % F.col("per") == 0).alias("own"), F.xxhash64("label", "size", table, "code").alias("bucket"))


def cosine(a: str, b: str) -> Column:
    """Cosine of the vectors of two structs (v, norm)."""
    dot = F.aggregate(F.zip_with(f"{a}.v", f"{b}.v", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return dot / (F.col(f"{a}.norm") * F.col(f"{b}.norm"))


def _angle(cos: Column) -> Column:
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cos)))


def _gathered(nodes: DataFrame, posted: DataFrame, widest: float, crowd: int) -> DataFrame:
    """node, ball, angle for nodes that crowds gather in balls: within half of the widest angle of the ball's leader."""
    vector = nodes.select("node", F.struct("v", "norm").alias("x"))
    balls = None
    for table in range(GATHERINGS):
        here = posted.filter((F.col("table") == table) & F.col("own")).select("node", "bucket")
        known = balls.select("node", (F.col("node") == F.col("ball")).alias("leads")) if balls else None
        here = here.join(known, "node", "left") if balls else here.withColumn("leads", F.lit(None).cast("boolean"))
        here = here.filter("leads is null or leads")  # the others are members already
        full = here.groupBy("bucket").agg(F.count_if(F.col("leads").isNull()).alias("n"), F.max_by("node", F.struct(F.coalesce("leads", F.lit(False)), F.xxhash64("node"))).alias("leader")).filter(F.col("n") >= crowd)
        full = materialise(full.select("bucket", "leader"), "vectordup-crowds")
        if full.isEmpty():
            continue
        led = full.join(vector.select(F.col("node").alias("leader"), F.col("x").alias("c")), "leader")
        near = here.filter("leads is null").join(led, "bucket").join(vector, "node").withColumn("angle", F.when(F.col("node") == F.col("leader"), 0.0).otherwise(_angle(cosine("x", "c"))))
        new = near.filter(F.col("angle") <= widest / 2 - MARGIN).select("node", F.col("leader").alias("ball"), "angle")
        balls = materialise(balls.unionByName(new) if balls else new, "vectordup-balls")
    return balls if balls else nodes.limit(0).select("node", F.col("node").alias("ball"), F.lit(0.0).alias("angle"))


def _settled(nodes: DataFrame, posted: DataFrame, least: float, crowd: int) -> tuple[DataFrame, DataFrame]:
    """(node, ball, n_links), and links of balls (a, b)."""
    widest = math.acos(least)
    gathered = _gathered(nodes, posted, widest, crowd)
    members = nodes.join(gathered, "node", "left").select("node", F.coalesce("ball", "node").alias("ball"), F.coalesce("angle", F.lit(0.0)).alias("angle"), "copies", F.struct("v", "norm").alias("x"))
    members = materialise(members, "vectordup-members")
    whole = members.groupBy("ball").agg(F.max("angle").alias("radius"), F.sum("copies").alias("weight"))
    balls = materialise(whole.join(members.filter("node = ball").select("ball", "x"), "ball"), "vectordup-leaders")
    placed = posted.select("bucket", "node").join(members.select("node", "ball"), "node").select("bucket", "ball").distinct()
    shared = placed.groupBy("bucket").count().filter("count > 1").select("bucket")
    placed = materialise(placed.join(shared, "bucket"), "vectordup-postings")
    pairs = placed.join(placed.withColumnRenamed("ball", "other"), "bucket").filter("ball < other").select("ball", "other").distinct()

    one = balls.select("ball", F.struct("radius", "weight", "x.v", "x.norm").alias("a"))
    two = balls.select(F.col("ball").alias("other"), F.struct("radius", "weight", "x.v", "x.norm").alias("b"))
    met = pairs.join(one, "ball").join(two, "other").withColumn("cos", cosine("a", "b"))
    reach = F.col("a.radius") + F.col("b.radius")
    sure = F.when(reach == 0, F.col("cos") >= least).when(_angle(F.col("cos")) + reach <= widest - MARGIN, True).when(_angle(F.col("cos")) - reach > widest + MARGIN, False)
    met = met.select("ball", "other", F.col("a.weight").alias("wa"), F.col("b.weight").alias("wb"), sure.alias("sure")).filter("sure or sure is null")
    met = materialise(met, "vectordup-met")
    both = lambda df: df.select("ball", "other", F.col("wb").alias("w")).unionAll(df.select(F.col("other").alias("ball"), F.col("ball").alias("other"), F.col("wa").alias("w")))

    # balls that are neither near nor far as wholes: members against leaders, in both directions
    aside = both(met.filter("sure is null")).join(two, "other").join(members.select("ball", "node", "x"), "ball").withColumn("cos", cosine("x", "b"))
    radius = F.col("b.radius")
    sure = F.when(radius == 0, F.col("cos") >= least).when(_angle(F.col("cos")) + radius <= widest - MARGIN, True).when(_angle(F.col("cos")) - radius > widest + MARGIN, False)
    aside = materialise(aside.select("ball", "other", "node", "w", sure.alias("sure")).filter("sure or sure is null"), "vectordup-aside")
    rest = aside.filter("sure is null").select("ball", "other", "node").join(members.select("node", "x"), "node")
    rest = rest.join(members.select(F.col("ball").alias("other"), F.col("copies").alias("w"), F.col("x").alias("y")), "other").filter(cosine("x", "y") >= least)
    rest = materialise(rest.groupBy("ball", "other", "node").agg(F.sum("w").alias("w")), "vectordup-rest")

    added = both(met.filter("sure")).groupBy("ball").agg(F.sum("w").alias("by_ball"))
    single = aside.filter("sure").select("node", "w").unionAll(rest.select("node", "w")).groupBy("node").agg(F.sum("w").alias("by_node"))
    links = met.filter("sure").select("ball", "other").unionAll(aside.filter("sure").select("ball", "other")).unionAll(rest.select("ball", "other"))
    counted = members.select("node", "ball").join(balls.select("ball", "weight"), "ball").join(added, "ball", "left").join(single, "node", "left")
    counted = counted.select("node", "ball", (F.col("weight") - 1 + F.coalesce("by_ball", F.lit(0)) + F.coalesce("by_node", F.lit(0))).cast("long").alias("n_links"))
    return counted, links.select(F.col("ball").alias("a"), F.col("other").alias("b"))


def near_vectors(vectors: DataFrame, least: float = COSINE, crowd: int = CROWD) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors (vec_id, embedding, label).

    Two rows are linked if their labels are equal and not null, their vectors of one length, and the cosine is `least`
    or more; n_links counts rows. component_id is the smallest vec_id that links reach, kept says whether it is the
    row's own. Vectors that are null, zero, or hold null or non-finite components are linked with nothing, nor are
    rows without a label. Rows that repeat an id are rows of their own; null ids belong to components but name none
    unless all are null. Other columns are ignored; an empty table gives no rows.
    """
    rows = vectors.select("vec_id", "label", "embedding", *(F.xxhash64(F.lit(k), "label", "embedding").alias(f"h{k}") for k in (1, 2)))
    good = usable(rows).filter("label is not null")
    # 128 bits say which vectors are equal; powers of two scale exactly
    power = F.floor(F.log2(F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double"))))))
    scale = F.pow(F.lit(2.0), -F.greatest(F.lit(-1022), F.least(F.lit(1022), power)))
    nodes = good.groupBy("h1", "h2").agg(F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    nodes = nodes.withColumn("scale", scale).withColumn("v", F.expr("transform(embedding, x -> cast(x as double) * scale)"))
    nodes = nodes.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).drop("embedding", "scale")
    nodes = materialise(nodes.withColumn("node", F.monotonically_increasing_id()), "vectordup-nodes")
    most = nodes.groupBy("label", F.size("v").alias("size")).count().groupBy("size").agg(F.max("count").alias("n")).collect()  # a row a length
    posted = materialise(_posted(nodes, {r["size"]: hashes_for(r["n"], r["size"]) for r in most}), "vectordup-posted")
    counted, links = _settled(nodes, posted, least, crowd)
    roots = components(materialise(links, "vectordup-links")).select(F.col("node").alias("ball"), "root")
    named = counted.join(roots, "ball", "left").join(nodes.select("node", "h1", "h2", "least"), "node").withColumn("root", F.coalesce("root", "ball"))
    named = materialise(named.select("h1", "h2", "n_links", "root", "least"), "vectordup-counted")
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(ids, "root").select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), "n_links", "component_id")
    out = rows.select("vec_id", "h1", "h2", "label").join(named, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")) & F.col("label").isNotNull(), "left")
    own = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.col("vec_id").eqNullSafe(own).alias("kept"))
