"""Line dedup by winnowing: repeated runs of lines go, the first stays.

The window of a line is that line and the next ones, until they are WINDOW lines or hold LONG words. Every window
selects the rightmost of its smallest line hashes as a fingerprint, so two equal runs of a window or more always
select an equal one. Fingerprints that occur once are dropped. The positions of the others are joined: each window
that selected one is paired with the first position, in the order of (doc_id, text, line), at which the same lines
select it. Pairs at one distance from the same document extend each other both ways to runs of lines that match,
and the later run goes. Lines are compared by digests of 128 bits.

Lines end at \n; lines of white space alone are no lines here, and stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gavel.llm.shingles import mixed
from gavel.llm.storage import materialise

#: Lines of a window, and words that make fewer lines one: smaller repeated runs are left alone.
WINDOW, LONG = 3, 50
_NEXT = np.uint64(0xD6E8FEB86659FD93)


def line_places(text: bytes) -> tuple[list[bytes], list[int]]:
    """All lines of a text, and the places of those that count."""
    lines = text.split(b"\n")
    return lines, [i for i, x in enumerate(lines) if x and not x.isspace()]


def fingerprints(text: bytes, window: int = WINDOW, long: int = LONG) -> tuple[np.ndarray, ...]:
    """For each window of a text: its first line and number of lines (of those that count), the place and the hash of the
    selected line, and 128 bits that stand for all its lines."""
    lines, places = line_places(text)
    n = len(places)
    both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(lines[i]) for i in places), dtype=np.uint64).reshape(n, 2)
    words = np.fromiter((len(lines[i].split()) for i in places), dtype=np.int64, count=n)
    size, held = np.full(n, window), words.copy()
    for k in range(1, window):
        size[(size == window) & (held >= long)] = k
        held[: n - k] += words[k:]
    start = np.flatnonzero(np.arange(n) + size <= n)
    size = size[start]
    at, least = start.copy(), both[start, 0].copy()
    with np.errstate(over="ignore"):
        whole = mixed(both[start] + size[:, None].astype(np.uint64))
        for k in range(1, window):
            more = np.flatnonzero(size > k)
            own = both[start[more] + k]
            whole[more] = mixed(whole[more] * _NEXT + own)
            lower = own[:, 0] <= least[more]
            at[more[lower]], least[more[lower]] = start[more[lower]] + k, own[lower, 0]
    return start, size, at, least.view(np.int64), whole[:, 0].view(np.int64), whole[:, 1].view(np.int64)


def _key():
    return F.xxhash64("text").alias("text_key")


_WINDOWS = pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32()), ("one", pa.int64()), ("two", pa.int64())]))


def positions(docs: DataFrame, window: int = WINDOW, long: int = LONG) -> DataFrame:
    """doc_id, text_key, fingerprint, windows (start, size, one, two): a row for each selected line."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], [], []]
            for d, k, t in zip(batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                start, size, at, f, one, two = fingerprints(t or b"", window, long)
                if len(f):
                    order = np.argsort(at, kind="stable")
                    cut = np.concatenate(([0], np.flatnonzero(np.diff(at[order])) + 1, [len(at)]))
                    rows[0] += [d] * (len(cut) - 1)
                    rows[1] += [k] * (len(cut) - 1)
                    rows[2] += f[order[cut[:-1]]].tolist()
                    each = list(zip(*(x[order].tolist() for x in (start, size, one, two)), strict=True))
                    rows[3] += [[dict(zip(("start", "size", "one", "two"), w, strict=True)) for w in each[a:b]] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
            types = [pa.int64(), pa.int64(), pa.int64(), _WINDOWS]
            yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, types, strict=True)], ["doc_id", "text_key", "fingerprint", "windows"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key(), "text")
    return own.mapInArrow(scan, "doc_id long, text_key long, fingerprint long, windows array<struct<start:int,size:int,one:long,two:long>>")


def repeated_runs(docs: DataFrame, window: int = WINDOW, long: int = LONG) -> DataFrame:
    """doc_id, text_key, first, last, of_doc, of_key, of_first: runs of lines that match an earlier one, extended both ways.

    first, last: lines to delete (places among those that count, last exclusive); of_first: where the earlier run has
    the first of them.
    """
    found = materialise(positions(docs, window, long), "line-fingerprints")
    shared = found.groupBy("fingerprint").agg(F.count("*").alias("n")).filter("n > 1").select("fingerprint")
    near = found.join(shared, "fingerprint").select("doc_id", "text_key", F.explode("windows").alias("w")).select("doc_id", "text_key", "w.*")
    first = near.groupBy("one", "two").agg(F.min(F.struct("doc_id", "text_key", "start")).alias("f"), F.count("*").alias("n")).filter("n > 1").select("one", "two", "f")
    pairs = near.join(first, ["one", "two"])
    same = F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("text_key") == F.col("f.text_key"))
    begin = F.when(same, F.greatest("start", F.col("f.start") + F.col("size"))).otherwise(F.col("start"))  # a run that overlaps its first copy
    later = pairs.filter(~same | (F.col("start") > F.col("f.start")))
    later = later.select("doc_id", "text_key", F.col("f.doc_id").alias("of_doc"), F.col("f.text_key").alias("of_key"), (F.col("start") - F.col("f.start")).alias("apart"), begin.alias("first"), (F.col("start") + F.col("size")).alias("last"))
    run = ["doc_id", "text_key", "of_doc", "of_key", "apart"]
    along = Window.partitionBy(*run).orderBy("first", "last")  # at most the lines of a document
    reached = F.max("last").over(along.rowsBetween(Window.unboundedPreceding, -1))
    grown = later.withColumn("new", F.coalesce((F.col("first") > reached).cast("int"), F.lit(1))).withColumn("nth", F.sum("new").over(along))
    return grown.groupBy(*run, "nth").agg(F.min("first").alias("first"), F.max("last").alias("last")).select("doc_id", "text_key", "first", "last", "of_doc", "of_key", (F.col("first") - F.col("apart")).alias("of_first"))


def without_runs(text: bytes, runs: list[tuple[int, int]]) -> tuple[bytes, int, int, int]:
    """The text without the lines of the runs; how many lines count, how many went, in how many runs."""
    lines, places = line_places(text)
    gone = np.zeros(len(places) + 1, dtype=np.int64)
    for a, b in runs:
        gone[a] += 1
        gone[b] -= 1
    out = np.cumsum(gone)[:-1] > 0
    drop = {places[i] for i in np.flatnonzero(out)}
    kept = b"\n".join(x for i, x in enumerate(lines) if i not in drop) if drop else text
    return kept, len(places), int(out.sum()), int((np.diff(np.concatenate(([0], out.astype(np.int8)))) == 1).sum())


def deduplicate_lines(docs: DataFrame, window: int = WINDOW, long: int = LONG) -> DataFrame:
    """doc_id, text (what is left), n_lines, n_removed, n_runs: a row for each of docs.

    Null texts stay null, with zeros. Rows that repeat doc_id and text are one document: they lose the same lines.
    Texts of fewer lines than a window lose none. Other columns of docs, also of names used here, are not carried.
    """
    runs = repeated_runs(docs, window, long).groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key(), "text")
    joined = own.join(runs, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key")), "left").select("doc_id", "text", "runs")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = part.column("text").cast(pa.binary()).to_pylist()
                cut = [without_runs(t or b"", [(r["first"], r["last"]) for r in runs or []]) for t, runs in zip(texts, part.column("runs").to_pylist(), strict=True)]
                left = pa.array([None if t is None else c[0] for t, c in zip(texts, cut, strict=True)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), left, *(pa.array([c[i] for c in cut], pa.int64()) for i in (1, 2, 3))], ["doc_id", "text", "n_lines", "n_removed", "n_runs"])

    return joined.mapInArrow(apply, "doc_id long, text string, n_lines long, n_removed long, n_runs long")
