"""MinHash near-duplicates by a signature-coordinate inverted join.

Texts with equal shingle sets share one node. Each node's signature has COORDINATES minima; a posting is a pair of
coordinate and value. Two sets of similarity 0.8 agree in fewer than MATCHES of 48 coordinates with probability
3e-8, so partners must share MATCHES postings. Ordered by how many nodes have a posting, the MATCHES - 1 most frequent
of each node can be skipped: partners share one of the others, so only lists of those are merged.

Lists of up to SHORT nodes are merged as blocks (equal lists once): each block counts, for all its pairs, the
coordinates that agree, skipped ones too, and keeps those of MATCHES or more. A longer list is chained to its least node
first, and its pairs are counted later. What hangs together by either is a family; all links lie within families.

A family's texts meet in chunks of bounded size. There pairs are counted by their signatures first, and those of
MATCHES or more are confirmed on the full sets, strongest first, as long as they would join different components: what
is already joined needs no further link. Each chunk of a large family also gets some of the family's leaders, so that
copies become one component at a cost in proportion to their number; after that, chunks meet each other only where
sizes allow a link and they hold nodes of different components.

Texts stay where they are unless they may be in a family: a bitmap of those rows is broadcast to the scan.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavel.llm import bitmaps
from gavel.llm.components import components
from gavel.llm.rows import packed, unpacked
from gavel.llm.shingles import mixed, shingle_sets
from gavel.llm.storage import materialise

#: Minima of a signature; least number that partners share; words of a shingle; similarity in percent.
COORDINATES, MATCHES, WORDS, PERCENT = 48, 22, 2, 80
#: Nodes of a list that is counted as a block, at most; nodes and shingles of a chunk, about; leaders of a large family.
SHORT, CHUNK, CHUNK_SHINGLES, LEADERS = 64, 512, 400_000, 8
#: Pairs that numpy compares at a time; pairs of a chunk above which full sets are compared all together.
PAIRS, MANY = 1 << 16, 4096
_random = np.random.default_rng(20240502)
_A = (_random.integers(0, 1 << 31, COORDINATES, dtype=np.uint64) * 2 + 1).astype(np.uint32)[:, None]
_B = _random.integers(0, 1 << 32, COORDINATES, dtype=np.uint64).astype(np.uint32)[:, None]


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over a set, as signed 32-bit words; empty for an empty set."""
    if not len(shingles):
        return np.zeros(0, dtype=np.int32)
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    return np.minimum.reduce([(_A * low[i : i + 65536] + _B).min(axis=1) for i in range(0, len(low), 65536)]).view(np.int32)


def _texts(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def _key() -> Column:
    return F.xxhash64("text").alias("text_key")


def signatures(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, text_key, n_shingles, node, signature: node is a hash of the whole set (0 for an empty one)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, node, rows = [], [], []
            with np.errstate(over="ignore"):
                for s in shingle_sets(_texts(batch.column("text")), words):
                    n.append(len(s))
                    node.append(mixed(np.sum(mixed(s ^ np.uint64(0xA5A5A5A5)), dtype=np.uint64, keepdims=True) + np.uint64(len(s))).view(np.int64)[0] if len(s) else 0)
                    rows.append(signature(s))
            ends = np.cumsum([0, *map(len, rows)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(rows or [np.zeros(0, np.int32)]), pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(n, pa.int64()), pa.array(node, pa.int64()), lists], ["doc_id", "text_key", "n_shingles", "node", "signature"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key(), "text").mapInArrow(make, "doc_id long, text_key long, n_shingles long, node long, signature array<int>")


def postings(nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """token, node: each node's postings but the MATCHES - 1 most frequent, without those of one node only.

    Sets so small that one shingle more or less takes them below the similarity are like no other set.
    """
    tokens = nodes.filter(100 * F.col("n") >= percent * (F.col("n") + 1)).select("node", F.posexplode("signature").alias("at", "value"))
    tokens = tokens.select("node", (F.shiftleft(F.col("at").cast("long"), 32) + F.col("value").cast("long")).alias("token"))
    frequent = tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    kept = tokens.join(frequent, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("l"))  # at most COORDINATES each
    return kept.filter(F.size("l") >= MATCHES).select(F.explode(F.slice("l", F.lit(1), F.size("l") - MATCHES + 1)["token"]).alias("token"), "node")


def _least(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of each of n places the least that links x - y reach."""
    least = np.arange(n)
    while len(x):
        low, was = np.minimum(least[x], least[y]), least.copy()
        np.minimum.at(least, x, low)
        np.minimum.at(least, y, low)
        least = least[least]
        if (least == was).all():
            break
    return least


def _close(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes can be alike."""
    return 100 * np.minimum(n, m) >= percent * np.maximum(n, m)


def agreeing(blocks: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) that hold together what agrees in MATCHES coordinates or more within blocks (block, node, n, signature)."""

    def count(block: np.ndarray, node: np.ndarray, n: np.ndarray, signs: np.ndarray) -> pa.RecordBatch:
        start = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        sizes = np.diff(np.concatenate((start, [len(block)])))
        pairs = [start[sizes == m][:, None, None] + np.stack(np.triu_indices(m, 1))[None] for m in np.unique(sizes[sizes > 1])]
        i, j = (np.concatenate([p[:, k].ravel() for p in pairs] or [np.zeros(0, dtype=np.int64)]) for k in (0, 1))
        good = [np.zeros(0, dtype=np.int64)]
        for at in range(0, len(i), PAIRS):
            x, y = i[at : at + PAIRS], j[at : at + PAIRS]
            good.append(at + np.flatnonzero(_close(n[x], n[y], percent) & ((signs[x] == signs[y]).sum(axis=1) >= MATCHES)))
        good = np.concatenate(good)
        least = _least(len(block), i[good], j[good])
        moved = np.flatnonzero(least != np.arange(len(block)))
        return pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[least[moved]])], ["a", "b"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of a block that may go on
        for batch in batches:
            own = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "node", "n")] + [batch.column("signature").flatten().to_numpy(zero_copy_only=False).reshape(-1, COORDINATES)]
            own = [np.concatenate(x) for x in zip(held, own, strict=True)] if held else own
            cut = int(np.searchsorted(own[0], own[0][-1])) if len(own[0]) else 0  # blocks come in order
            if cut:
                yield count(*(x[:cut] for x in own))
            held = [x[cut:] for x in own]
        if held:
            yield count(*held)

    return blocks.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "a long, b long")


def _families(links: DataFrame, long: DataFrame) -> DataFrame:
    """family, node: nodes that links (a, b) or long lists (token, node) hold together."""
    leader = long.groupBy("token").agg(F.min("node").alias("b"))
    found = components(links.unionAll(long.join(leader, "token").select(F.col("node").alias("a"), "b")))
    return found.select(F.col("root").alias("family"), "node")


def _chunks(members: DataFrame, percent: int) -> DataFrame:
    """members (family, node, n, lead ...) with `chunk`: by hash, within groups of one lead and of about one size.

    A family that fits in one chunk is one. Nodes of one lead are dealt to as many chunks as they fill; those without
    (null) by their roots, so that a component that is small stays together. Counts are summed before they move.
    """
    weight = F.greatest(F.count("*") / CHUNK, F.sum("n") / CHUNK_SHINGLES).alias("__w")
    banded = members.withColumn("__band", F.floor(F.log("n") / math.log(100 / percent if percent < 100 else 2)))
    whole = banded.groupBy("family").agg(weight).select(F.col("family").alias("__f"), (F.col("__w") <= 1).alias("__one"))
    parts = banded.groupBy(F.col("family").alias("__g"), F.col("lead").alias("__l"), F.col("__band").alias("__b")).agg(F.ceil(weight).alias("__parts"))
    joined = banded.join(whole, F.col("family") == F.col("__f")).join(parts, (F.col("family") == F.col("__g")) & F.col("lead").eqNullSafe(F.col("__l")) & (F.col("__band") == F.col("__b")))
    dealt = F.pmod(F.xxhash64(F.when(F.col("lead").isNull(), F.col("root")).otherwise(F.col("node"))), F.col("__parts"))
    return joined.withColumn("chunk", F.when(F.col("__one"), F.lit(0)).otherwise(F.xxhash64("lead", "__band", dealt))).select(*members.columns, "chunk")


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set on the left with each on the right."""
    sets = [*left, *right]
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count[code] > 1
    owner, code = owner[keep], np.unique(code[keep], return_inverse=True)[1]
    order, out, k = np.argsort(code, kind="stable"), np.zeros((len(left), len(right)), dtype=np.int64), len(left)
    owner, code = owner[order], code[order]
    for at in range(0, int(code[-1]) + 1 if len(code) else 0, 4096):
        lo, hi = np.searchsorted(code, [at, at + 4096])
        marks = np.zeros((len(sets), 4096), dtype=np.float32)
        marks[owner[lo:hi], code[lo:hi] - at] = 1
        out += (marks[:k] @ marks[k:].T).astype(np.int64)  # at most 4096 each, exact
    return out


def _counted(one: list[np.ndarray], two: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of sets that agree in MATCHES coordinates and whose sizes allow a link, strongest first."""
    signs, others = (np.stack([signature(x) for x in sets]) for sets in (one, two))
    n, m = np.array([len(x) for x in one]), np.array([len(x) for x in two])
    step, found = max(1, PAIRS // len(two)), [np.zeros((3, 0), dtype=np.int64)]
    for at in range(0, len(one), step):
        same = np.zeros((len(signs[at : at + step]), len(two)), dtype=np.int8)
        for c in range(COORDINATES):
            same += signs[at : at + step, c, None] == others[None, :, c]
        i, j = np.nonzero((same >= MATCHES) & _close(n[at : at + step, None], m[None, :], percent))
        found.append(np.stack((same[i, j], i + at, j)))
    same, i, j = np.concatenate(found, axis=1)
    order = np.argsort(-same, kind="stable")
    return i[order], j[order]


def _links(left: pd.DataFrame, right: pd.DataFrame | None, words: int, percent: int) -> pd.DataFrame:
    """Links (a, b) among the components of two chunks (node, root, text), or of one: each that is joined, to the least of them."""
    both = [x.drop_duplicates("node") for x in (left, right) if x is not None]
    with np.errstate(over="ignore"):
        sets = [list(shingle_sets([t.encode() for t in x["text"]], words)) for x in both]
        i, j = _counted(sets[0], sets[-1], percent)
    roots, known = [x["root"].to_numpy() for x in both], np.unique(np.concatenate([x["root"].to_numpy() for x in both]))
    x, y = np.searchsorted(known, roots[0][i]), np.searchsorted(known, roots[-1][j])
    differ = x != y
    i, j, x, y = i[differ], j[differ], x[differ], y[differ]
    parent, table = list(range(len(known))), None

    def find(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    tried = 0
    for a, b, p, q in zip(i.tolist(), j.tolist(), x.tolist(), y.tolist(), strict=True):
        p, q = find(p), find(q)
        if p == q:
            continue
        tried += 1
        if tried == MANY:
            table = _common(sets[0], sets[-1])
        one, two = sets[0][a], sets[-1][b]
        common = int(table[a, b]) if table is not None else len(np.intersect1d(one, two, assume_unique=True))
        if 100 * common >= percent * (len(one) + len(two) - common):
            parent[max(p, q)] = min(p, q)
    least = np.array([find(k) for k in range(len(known))], dtype=np.int64)
    moved = np.flatnonzero(least != np.arange(len(known)))
    return pd.DataFrame({"a": known[moved], "b": known[least[moved]]})


def _within(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links within each (family, chunk); chunks are dealt to tasks in groups, so that small ones cost little."""

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        found = [_links(one.assign(root=one["node"]), None, words, percent) for _, one in batch.groupby(["family", "chunk"]) if len(one) > 1]
        return pd.concat(found) if found else pd.DataFrame({"a": [], "b": []})

    rows = texts.agg(F.sum("n")).head()[0] or 0
    dealt = F.pmod(F.xxhash64("family", "chunk"), F.lit(max(1, int(rows // CHUNK_SHINGLES) * 2)))
    return texts.withColumn("deal", dealt).groupBy("deal").applyInPandas(run, "a long, b long")


def _across(members: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between chunks (family, chunk, node, n, root) of one family that hold different components."""
    about = members.groupBy("family", "chunk").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("root").alias("r1"), F.max("root").alias("r2"))
    other = about.select("family", *(F.col(c).alias(f"{c}_") for c in ("chunk", "lo", "hi", "r1", "r2")))
    meets = about.join(other, "family").filter("chunk <= chunk_").filter(~((F.col("r1") == F.col("r2_")) & (F.col("r2") == F.col("r1_"))))
    enough = (100 * F.col("hi") >= percent * F.col("lo_")) & (100 * F.col("hi_") >= percent * F.col("lo"))
    meets = materialise(meets.filter(enough).select("family", "chunk", "chunk_"), "near-meets")
    held = members.join(texts, "node").select("family", "chunk", "node", "root", "text")
    left = held.join(meets, ["family", "chunk"])
    right = held.withColumnRenamed("chunk", "chunk_").join(meets, ["family", "chunk_"])
    right = right.select(*(F.col(c).alias(f"{c}_2") for c in ("family", "chunk", "chunk_", "node", "root", "text")))
    meet = lambda x, y: _links(x, y.rename(columns=lambda c: c.removesuffix("_2")), words, percent)
    return left.groupBy("family", "chunk", "chunk_").cogroup(right.groupBy("family_2", "chunk_2", "chunk__2")).applyInPandas(meet, "a long, b long")


def _among(docs: DataFrame, keys: DataFrame, once: bool = False) -> DataFrame:
    """Rows of docs whose `__row` may be among keys (key: long); once: of a row that repeats, one a task is enough."""
    shipped = docs.sparkSession.sparkContext.broadcast(bitmaps.build(keys, bitmaps.bits_for(keys.count())))  # bounded size

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            row = batch.column("__row").to_numpy(zero_copy_only=False)
            at = np.flatnonzero(bitmaps.among(shipped.value, row))
            if once and len(at):
                at = at[np.sort(np.unique(row[at], return_index=True)[1])]
                at = at[[r not in seen for r in row[at].tolist()]]
                seen.update(row[at].tolist())
            yield batch.take(pa.array(at))

    return docs.mapInArrow(keep, docs.schema)


def link_nodes(docs: DataFrame, nodes: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """node, root for each node that is linked with another, directly or not.

    nodes: node, n, signature, and doc_id, text_key of a row with the set.
    """
    lists = materialise(postings(nodes, percent), "near-postings")
    lists = materialise(lists.join(lists.groupBy("token").agg(F.count("*").alias("m")).filter("m > 1"), "token"), "near-lists")
    blocks = lists.filter(F.col("m") <= SHORT).groupBy("token").agg(F.sort_array(F.collect_list("node")).alias("nodes")).select("nodes").distinct()
    blocks = blocks.select(F.xxhash64("nodes").alias("block"), F.explode("nodes").alias("node")).join(nodes.select("node", "n", "signature"), "node")
    links = materialise(agreeing(blocks, percent), "near-agreeing")
    found = _families(links, lists.filter(F.col("m") > SHORT)).join(nodes.select("node", "n", "doc_id", "text_key"), "node")
    found = found.withColumns({"lead": F.lit(None).cast("long"), "root": F.col("node")})
    members = materialise(_chunks(found, percent), "near-members")
    row = lambda d, k: F.xxhash64(d, k)
    own = docs.select(F.col("doc_id").cast("long").alias("__id"), F.xxhash64("text").alias("__key"), "text").withColumn("__row", row("__id", "__key"))
    wanted = members.select("node", F.col("doc_id").alias("__d"), "text_key")
    near = _among(own, members.select(row("doc_id", "text_key").alias("key")), once=True)
    texts = near.join(wanted, F.col("__id").eqNullSafe(F.col("__d")) & (F.col("__key") == F.col("text_key")))
    texts = materialise(texts.select("node", "text"), "near-texts")

    # leaders of families of several chunks join each chunk
    whole = members.groupBy("family").agg(F.min("chunk").alias("lo"), F.max("chunk").alias("hi")).filter("lo < hi").select("family")
    large = members.drop("chunk").join(whole, "family")
    least = F.min_by("node", F.xxhash64("node"))
    leaders = large.groupBy("family", F.pmod(F.xxhash64("node", F.lit("lead")), F.lit(LEADERS)).alias("__k")).agg(least.alias("node"))
    leaders = leaders.drop("__k").join(members.select("family", "chunk").distinct(), "family").join(nodes.select("node", "n"), "node")
    first = members.select("family", "node", "n", "chunk").unionByName(leaders).distinct()
    links = materialise(_within(first.join(texts, "node"), words, percent), "near-links")
    roots = components(links)
    if large.isEmpty():
        return roots
    large = large.drop("root", "lead").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    many = large.groupBy("family", "root").agg(F.count("*").alias("__c")).filter(F.col("__c") >= CHUNK // 8).select("family", "root", F.col("root").alias("lead"))
    large = materialise(_chunks(large.join(many, ["family", "root"], "left"), percent), "near-large")
    return components(links.unionAll(materialise(_across(large, texts, words, percent), "near-links")))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept: a row for each of docs (columns doc_id and text count).

    component_id is the smallest doc_id that links reach; a document without words is alone, also if others are
    empty too. kept: it is that document itself. Rows that share a doc_id but not a text are documents of their own.
    Null ids belong to components, but name none: where all are null, so is component_id, and kept is true.
    Texts of any length count whole; columns of other names in docs are not carried. An empty table gives no rows.
    """
    signed = materialise(signatures(docs, words), "near-signatures")
    first = F.min(F.struct("doc_id", "text_key"))
    nodes = signed.filter("n_shingles > 0").groupBy("node").agg(F.first("n_shingles").alias("n"), F.first("signature").alias("signature"), first.alias("f"), F.min("doc_id").alias("least"))
    nodes = materialise(nodes.select("node", "n", "signature", "f.doc_id", "f.text_key", "least"), "near-nodes")
    rooted = nodes.select("node", "least").join(link_nodes(docs, nodes, words, percent), "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select(F.col("node").alias("__node"), "component_id")
    out = signed.select("doc_id", "text_key", "n_shingles", "node").join(named, (F.col("node") == F.col("__node")) & (F.col("n_shingles") > 0), "left")
    out = out.withColumn("component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "text_key", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """docs with one row of each component, all columns kept, of any names. Of rows that repeat id and text the least stays.

    Rows pass the scan as they are unless a bitmap says that they may go; only those are moved to be judged.
    """
    judged = near_duplicates(docs, **options).groupBy("doc_id", "text_key").agg(F.first("kept").alias("kept"), F.count("*").alias("copies"))
    judged = materialise(judged.withColumn("key", F.xxhash64("doc_id", "text_key")), "near-judged")
    doubtful = judged.filter(~F.col("kept") | (F.col("copies") > 1)).select("key")
    own = packed(docs, "doc_id", "text").withColumn("__key", F.xxhash64("text")).withColumn("__row", F.xxhash64(F.col("doc_id").cast("long"), F.col("__key")))
    shipped = docs.sparkSession.sparkContext.broadcast(bitmaps.build(doubtful, bitmaps.bits_for(doubtful.count())))  # bounded size

    def part(inside: bool):
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(bitmaps.among(shipped.value, batch.column("__row").to_numpy(zero_copy_only=False)) == inside))

        return own.mapInArrow(keep, own.schema)

    kept = judged.filter("kept").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__k"))
    moved = part(True).join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__k")), "left_semi")
    first = F.row_number().over(Window.partitionBy("doc_id", "__key").orderBy(F.to_json(F.struct("doc_id", "text", "extra"))))
    columns = ("doc_id", "text", "extra")
    kept = part(False).select(*columns).unionByName(moved.withColumn("__n", first).filter("__n = 1").select(*columns))
    return unpacked(kept, docs, "doc_id", "text")
