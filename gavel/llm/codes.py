"""Compression of vectors to codes by Lloyd's rounds that are maintained by their changes.

A vector's components become integers, its parts each have a codebook of integer entries, and a code names the nearest
entry of each part. Vectors lie in a bucketed table, and so do each round's assignments, so that both meet again without
a shuffle. A round reads the vectors and the assignments of the round before, and writes the new assignments together
with those parts that moved to another entry. Only these are summed, first within each batch, and shuffled as at most
one row an entry and batch: plus where a part went, minus where it came from. The running sums and counts of all
entries, which the codebooks are made of, have a fixed size and stay in the driver. All arithmetic is on integers, so
the result is the same for every order of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavel.llm.storage import bucketed, discard

#: Components are multiplied by this; parts of a vector; entries of a codebook; rounds.
SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Vectors of a bucket, about; most labels whose sums are broadcast (some 30 bytes each); numbers that numpy holds at a time.
BUCKET, BROADCAST_LABELS, HELD = 1 << 17, 100_000, 1 << 20
_MOVED = "array<struct<part:int,was:int,now:int,values:array<long>>>"


@dataclass
class Codebooks:
    """Entries of each part (parts x entries x width), and sums and counts of the parts that are assigned to them."""

    entries: np.ndarray
    sums: np.ndarray = field(default=None)
    counts: np.ndarray = field(default=None)

    def moved(self, changes: list) -> None:
        """Add rows (part, entry, count, sums) and replace the entries in use by floor(sum / count)."""
        if self.sums is None:
            self.sums, self.counts = np.zeros(self.entries.shape, dtype=np.int64), np.zeros(self.entries.shape[:2], dtype=np.int64)
        for r in changes:
            self.sums[r["part"], r["entry"]] += np.array(r["sums"], dtype=np.int64)
            self.counts[r["part"], r["entry"]] += r["count"]
        used = self.counts > 0
        self.entries[used] = self.sums[used] // self.counts[used][:, None]

    def nearest(self, part: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry, the lowest of equally near ones, and its squared distance, for each row of values."""
        own, at, d = self.entries[part], np.zeros(len(values), dtype=np.int64), np.zeros(len(values), dtype=np.int64)
        step = max(1, HELD // max(1, own.size))
        for lo in range(0, len(values), step):
            far = ((values[lo : lo + step, None, :] - own[None]) ** 2).sum(2)
            at[lo : lo + step] = far.argmin(1)
            d[lo : lo + step] = far.min(1)
        return at, d


def integers(vectors: DataFrame, column: str = "embedding", scale: int = SCALE, parts: int = PARTS) -> DataFrame:
    """vectors with `ints` in place of column: floor(scale * x), padded with zeros to a multiple of `parts`.

    Rows whose vector is null, empty, or holds null or non-finite components go, and so do those of another length
    than most (the longest of equally frequent ones). A component so large that distances would not fit into 64 bits
    counts as the largest that is not.
    """
    good = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.filter(F.col(column).isNotNull() & (F.size(column) > 0) & F.coalesce(good, F.lit(False)))
    sizes = kept.groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    length = sizes[0]["d"] if sizes else 0
    most = float(2 ** ((60 - max(0, length - 1).bit_length()) // 2))
    whole = F.transform(column, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-most)), F.lit(most))).cast("long"))
    padded = F.concat(whole, F.array_repeat(F.lit(0).cast("long"), -length % parts))
    return kept.filter(F.size(column) == length).withColumn("ints", padded).drop(column)


def _matrix(lists: pa.Array, parts: int) -> np.ndarray:
    """Lists of one length as rows x parts x width."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lists), parts, -1)


def _assigned(vectors: DataFrame, books: Codebooks, parts: int) -> DataFrame:
    """row, code, moved: the new assignment of each vector (row, ints, code: the assignment before, or null)."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)  # fixed size

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for batch in batches:
            values = _matrix(batch.column("ints"), parts)
            known = batch.column("code")  # of all rows or of none
            was = np.full(values.shape[:2], -1) if known.null_count else np.frombuffer(b"".join(known.to_pylist()), dtype=np.uint8).reshape(-1, parts).astype(np.int64)
            now = np.stack([books.nearest(p, values[:, p])[0] for p in range(parts)], axis=1)
            i, p = np.nonzero(was != now)
            own = pa.ListArray.from_arrays(pa.array(np.arange(len(i) + 1) * values.shape[2], pa.int32()), pa.array(values[i, p].ravel()))
            moved = pa.StructArray.from_arrays([pa.array(x, pa.int32()) for x in (p, was[i, p], now[i, p])] + [own], ["part", "was", "now", "values"])
            ends = pa.array(np.concatenate(([0], np.cumsum((was != now).sum(axis=1)))), pa.int32())
            codes = pa.array([bytes(c) for c in now.astype(np.uint8)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("row"), codes, pa.ListArray.from_arrays(ends, moved)], ["row", "code", "moved"])

    return vectors.select("row", "ints", "code").mapInArrow(assign, f"row long, code binary, moved {_MOVED}")


def _changes(assigned: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """part, entry, count, sums: what moved parts add to and take from entries; at most one row an entry."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums, counts, touched = np.zeros(shape, dtype=np.int64), np.zeros(shape[:2], dtype=np.int64), np.zeros(shape[:2], dtype=bool)
            values = np.array(batch["values"].tolist(), dtype=np.int64).reshape(len(batch), shape[2])
            part = batch["part"].to_numpy()
            for entry, sign in ((batch["now"].to_numpy(), 1), (batch["was"].to_numpy(), -1)):
                own = entry >= 0
                np.add.at(sums, (part[own], entry[own]), sign * values[own])
                np.add.at(counts, (part[own], entry[own]), sign)
                touched[part[own], entry[own]] = True
            p, e = np.nonzero(touched)
            yield pd.DataFrame({"part": p.astype(np.int32), "entry": e.astype(np.int32), "count": counts[p, e], "sums": list(sums[p, e])})

    moved = assigned.filter(F.size("moved") > 0).select(F.inline("moved"))
    partial = moved.mapInPandas(add, "part int, entry int, count long, sums array<long>")
    total = [F.sum(F.get("sums", F.lit(k))).alias(f"s{k}") for k in range(shape[2])]
    return partial.groupBy("part", "entry").agg(F.sum("count").alias("count"), *total).select("part", "entry", "count", F.array(*(f"s{k}" for k in range(shape[2]))).alias("sums"))


def compress(vectors: DataFrame, column: str = "embedding", key: str = "vec_id", keep: tuple[str, ...] = (), scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(key, keep ..., code, error) for every vector, and the codebooks (parts x entries x width).

    code: a binary of one byte a part; error: the squared distance of the integers to the entries that the code names.
    A part's codebook starts as that part of the vectors with the `entries` smallest keys (nulls last, of rows that
    repeat a key the least vector first); where there are fewer rows, it has fewer entries. Rows that repeat a key are
    vectors of their own. See integers() for what takes no part. An empty table gives no rows and empty codebooks.
    """
    spark = vectors.sparkSession
    rows = integers(vectors.select(key, *keep, column), column, scale, parts).withColumn("row", F.monotonically_increasing_id())
    held = bucketed(rows, "row", "codes-vectors", BUCKET)
    first = held.table.orderBy(F.col(key).asc_nulls_last(), "ints").limit(entries).select("ints").collect()  # as many as a codebook has
    if not first:
        return held.table.select(key, *keep, F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")), np.zeros((parts, 0, 0), dtype=np.int64)
    books = Codebooks(np.stack([np.array(r["ints"], dtype=np.int64).reshape(parts, -1) for r in first], axis=1))
    before = None
    for _ in range(rounds):
        known = held.table.select("row", "ints")
        known = known.withColumn("code", F.lit(None).cast("binary")) if before is None else known.join(before.table.select("row", "code").hint("shuffle_hash"), "row")
        after = bucketed(_assigned(known, books, parts), "row", "codes-assigned", buckets=held.buckets)
        changes = _changes(after.table, books.entries.shape).collect()  # at most one row an entry
        discard(spark, before)
        before = after
        if not changes:
            break  # the same assignments give the same entries
        books.moved(changes)
    discard(spark, before)
    shared = spark.sparkContext.broadcast(books)  # fixed size

    @F.pandas_udf("code binary, error long")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = np.array(batch.tolist(), dtype=np.int64).reshape(len(batch), parts, -1)
            found = [shared.value.nearest(p, values[:, p]) for p in range(parts)]
            code = np.stack([f[0] for f in found], axis=1).astype(np.uint8)
            yield pd.DataFrame({"code": [bytes(c) for c in code], "error": sum(f[1] for f in found)})

    return held.table.withColumn("__e", encode("ints")).select(key, *keep, "__e.code", "__e.error"), books.entries


def decode(coded: DataFrame, books: np.ndarray, length: int, into: str = "embedding", scale: int = SCALE) -> DataFrame:
    """coded with the vectors of `length` components that its codes stand for: the middles of the entries' integer cells.

    An integer component is floor(scale * x), so x lies between it and the next one, over scale.
    """
    shared = coded.sparkSession.sparkContext.broadcast(books)  # fixed size

    @F.pandas_udf("array<double>")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            at = np.array([list(c) for c in batch], dtype=np.int64).reshape(len(batch), -1)
            parts = shared.value[np.arange(at.shape[1])[None, :], at].reshape(len(batch), -1)[:, :length] if len(batch) else np.zeros((0, length))
            yield pd.Series(list((parts + 0.5) / scale))

    return coded.withColumn(into, read("code"))


def label_errors(coded: DataFrame, label: str = "label", broadcast_labels: int = BROADCAST_LABELS) -> DataFrame:
    """coded with label_error: the sum of `error` over all rows of an equal label, nulls together."""
    most = F.lit(2**63 - 1).cast("decimal(38,0)")
    sums = coded.groupBy(F.col(label).alias("__label")).agg(F.least(F.sum(F.col("error").cast("decimal(20,0)")), most).cast("long").alias("label_error"))
    sums = F.broadcast(sums) if sums.count() <= broadcast_labels else sums
    return coded.join(sums, F.col(label).eqNullSafe(F.col("__label"))).drop("__label")


def listed(books: np.ndarray) -> str:
    """All components of the entries in decimal, by part, entry and place, joined by commas."""
    return ",".join(map(str, books.reshape(-1).tolist()))
