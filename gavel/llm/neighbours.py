"""Approximate nearest neighbours by an inverted multi-index.

Each half of a vector has a codebook of its own; a pair of nearest centroids is the vector's cell. A query walks the
cells in the order of the summed squared distances of their two centroids, by a heap, until the cells that it has seen
hold enough vectors; these are reranked by the exact distance. A query's cells travel as one row for each group of
first centroids; there it meets the entries, in parts where they are many. Of vectors that are equal only as many can
be among the nearest as are asked for, so the others, of larger ids, stay out of the index.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gavel.llm.storage import materialise, smallest

#: Centroids of each half; bound of the sample that they are fitted on; rounds of fitting.
CENTROIDS, SAMPLE, ROUNDS = 256, 8192, 12
#: A query walks cells with this share of the entries at least, and this many. The share is high for vectors without
#: structure (measured recalls are in the README); clustered vectors need far less.
SEEN_SHARE, SEEN_LEAST = 0.3, 2000
#: First centroids that are one group; entries of a group that one task compares at a time, about.
GROUP, PART = 16, 8192


@dataclass
class Codebooks:
    """Centroids of the first and the second half of a vector."""

    first: np.ndarray
    second: np.ndarray


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is not null, not zero and without null or non-finite components."""
    good = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(F.col(column).isNotNull() & F.coalesce(good, F.lit(False)) & F.exists(column, lambda x: x != 0))


def comparable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding of usable() rows with an id and of the table's dimension.

    Vectors of different lengths have no distance: those of the length that most have take part (the longest of
    equally frequent ones).
    """
    good = usable(vectors).filter("vec_id is not null").select("vec_id", "embedding")
    sizes = good.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return good.filter(F.size("embedding") == sizes[0]["d"]) if sizes else good


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of points to centres."""
    return np.maximum((points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None, :], 0)


def _fit(points: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Centroids by k-means, begun at points far from each other; the same at every run."""
    rng = np.random.default_rng(7)
    centres, far = points[:1], None
    while len(centres) < min(k, len(points)):
        d = _nearest(points, centres[-1:])[:, 0]
        far = d if far is None else np.minimum(far, d)
        if not far.sum():
            break
        centres = np.vstack([centres, points[rng.choice(len(points), p=far / far.sum())]])
    for _ in range(rounds):
        own = _nearest(points, centres).argmin(1)
        for c in range(len(centres)):
            if (own == c).any():
                centres[c] = points[own == c].mean(0)
    return centres


def fit(vectors: DataFrame, centroids: int = CENTROIDS, sample: int = SAMPLE, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks from at most `sample` vectors, those of the smallest id hash."""
    rows = smallest(vectors, F.xxhash64("vec_id", "embedding"), sample).select("vec_id", "embedding").collect()
    rows.sort()
    if not rows:
        return Codebooks(np.zeros((1, 1)), np.zeros((1, 1)))
    points = np.array([r["embedding"] for r in rows], dtype=np.float64)
    half = points.shape[1] // 2
    return Codebooks(_fit(points[:, :half].copy(), centroids, rounds), _fit(points[:, half:].copy(), centroids, rounds))


def walk(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, enough: int) -> list[int]:
    """Cells in the order of first[i] + second[j], until those walked hold `enough` entries; empty ones are left out.

    The multi-sequence algorithm: a cell enters the heap once both its neighbours nearer to the corner are out.
    """
    by_first, by_second = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b, wide = first[by_first], second[by_second], len(second)
    heap, out, seen = [(a[0] + b[0], 0, 0)], [], 0
    reached = np.full(len(a), 0)  # of each row, how many cells are out
    while heap and seen < enough:
        _, i, j = heapq.heappop(heap)
        reached[i] = j + 1
        cell = int(by_first[i]) * wide + int(by_second[j])
        if sizes[cell]:
            out.append(cell)
            seen += int(sizes[cell])
        if i + 1 < len(a) and reached[i + 1] == j:
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
        if j + 1 < wide and (i == 0 or reached[i - 1] >= j + 2):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
    return out


def index(vectors: DataFrame, books: Codebooks, copies: int) -> DataFrame:
    """row, vec_id, embedding, cell for every vector that can be among the `copies` nearest, of copies the smallest ids."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)  # fixed size

    @F.pandas_udf("int")
    def cell(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        books = shared.value
        half = books.first.shape[1]
        for batch in batches:
            points = np.array(batch.tolist(), dtype=np.float64).reshape(len(batch), -1)
            pair = _nearest(points[:, :half], books.first).argmin(1) * len(books.second) + _nearest(points[:, half:], books.second).argmin(1)
            yield pd.Series(pair.astype(np.int32))

    nth = F.row_number().over(Window.partitionBy("__same", "embedding").orderBy("vec_id", "row"))
    fewer = vectors.select("row", "vec_id", "embedding", F.xxhash64("embedding").alias("__same")).withColumn("__n", nth).filter(F.col("__n") <= copies)
    return fewer.select("row", "vec_id", "embedding", cell("embedding").alias("cell"))


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, share: float = SEEN_SHARE, least: int = SEEN_LEAST, part: int = PART, **fitting) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of vectors for each query, by Euclidean distance, ties by vec_id.

    Both have vec_id and embedding; a query is not its own candidate, and is looked up in vectors by its id. Rows that
    repeat an id are all candidates; the least of their vectors, component by component, is the query of that id, and
    finds the others. Vectors that are null, zero or hold null or non-finite components take no part, nor do those of
    another length than most (see comparable). Distances are computed in double precision on the original vectors,
    component after component. Other columns are ignored.
    """
    spark = vectors.sparkSession
    good = materialise(comparable(vectors).withColumn("row", F.monotonically_increasing_id()), "ann-vectors")
    books = fit(good, **fitting)
    entries = materialise(index(good, books, k + 1), "ann-index")
    sizes = np.zeros(len(books.first) * len(books.second), dtype=np.int64)
    for r in entries.groupBy("cell").count().toLocalIterator():  # at most a row a cell
        sizes[r["cell"]] = r["count"]
    enough = max(least, int(share * sizes.sum()))
    wide = len(books.second) * GROUP  # cells of a group of first centroids
    groups = np.add.reduceat(sizes, np.arange(0, len(sizes), wide))
    parts = np.maximum(1, -(-groups // part))
    shared = spark.sparkContext.broadcast((books, sizes, parts))

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        books, sizes, parts = shared.value
        half = books.first.shape[1]
        for batch in batches:
            for lo in range(0, len(batch), 64):
                some, rows = batch.iloc[lo : lo + 64], []
                points = np.array(some["embedding"].tolist(), dtype=np.float64).reshape(len(some), -1)
                one, two = _nearest(points[:, :half], books.first), _nearest(points[:, half:], books.second)
                for q, r, v, a, b in zip(some["vec_id"], some["row"], some["embedding"], one, two, strict=True):
                    cells = np.sort(walk(a, b, sizes, enough)).astype(np.int64)
                    for own in np.split(cells, np.flatnonzero(np.diff(cells // wide)) + 1) if len(cells) else []:
                        rows += [(q, r, v, own[0] // wide, p, (own % wide).tolist()) for p in range(parts[own[0] // wide])]
                yield pd.DataFrame(rows, columns=["query_id", "own", "vector", "group", "part", "cells"])

    asked = good.join(queries.select("vec_id").distinct(), "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("embedding", "row")).alias("q"))
    asked = asked.select("vec_id", "q.row", "q.embedding").repartition(spark.sparkContext.defaultParallelism, "vec_id")  # small rows, long walks
    asked = asked.mapInPandas(visit, "query_id long, own long, vector array<double>, group int, part int, cells array<int>")
    held = entries.withColumn("group", F.floor(F.col("cell") / wide).cast("int")).withColumn("cell", F.col("cell") % wide)
    dealt = F.element_at(F.lit([int(x) for x in parts]), F.col("group") + 1)
    held = held.withColumn("part", F.pmod(F.xxhash64("row"), dealt).cast("int"))

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids, rows, points, cell = right["vec_id"].to_numpy(), right["row"].to_numpy(), np.array(right["embedding"].tolist(), dtype=np.float64), right["cell"].to_numpy()
            for q, own, v, cells in zip(left["query_id"].to_numpy(), left["own"].to_numpy(), left["vector"], left["cells"], strict=True):
                walked = np.zeros(wide, dtype=bool)
                walked[cells] = True
                at = np.flatnonzero(walked[cell] & (rows != own))
                best, d = _lowest(points[at], np.asarray(v, dtype=np.float64), ids[at], rows[at], k)
                out.append(pd.DataFrame({"query_id": q, "vec_id": ids[at][best], "row": rows[at][best], "score": d}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "row": [], "score": []})

    found = asked.groupBy("group", "part").cogroup(held.groupBy("group", "part")).applyInPandas(compare, "query_id long, vec_id long, row long, score double")
    nearest = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id", "row"))
    return found.withColumn("rank", nearest).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _lowest(points: np.ndarray, query: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the k points nearest to the query, ties by id and row, and their distances."""
    rough = ((points - query) ** 2).sum(1)
    near = np.flatnonzero(rough <= np.partition(rough, k - 1)[k - 1] * (1 + 1e-9)) if len(rough) > k else np.arange(len(rough))
    d = np.sqrt(np.cumsum((points[near] - query) ** 2, axis=1)[:, -1]) if len(near) else np.zeros(0)  # one component after the other
    order = np.lexsort((rows[near], ids[near], d))[:k]
    return near[order], d[order]
