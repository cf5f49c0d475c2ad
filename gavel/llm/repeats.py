"""Suffix-array dedup: removal of every byte in a long string that starts anywhere else too.

Sharding. Every LENGTH bytes select an anchor, the place of the smallest hash of ANCHOR bytes in them, so equal strings
select equal anchors. A segment is what consecutive starts with one anchor cover. Segments whose anchor occurs once
cannot repeat and go; equal segments repeat as a whole; only the different segments of an anchor are sorted.
Sorting. The segments of an anchor meet in one shard, whose suffixes are sorted with their common prefixes by external
induced sorting (gavel.llm.suffixes); a start whose prefix with a neighbour has LENGTH bytes repeats.
Segments travel once, as four numbers each, to the task of their anchor, where sorted runs tell what repeats. Only the
different segments of an anchor need their bytes; a second pass cuts them again and takes those whose anchor is in a
bitmap of bounded size, which is broadcast, for texts cost more to move than to cut.
An anchor with more than HOT different segments is not sorted in one shard: each string of LENGTH bytes in its segments
goes by a hash of 128 bits to the task of its equals, so that shards are bounded by SHARD_BYTES and HOT segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavel.llm import bitmaps
from gavel.llm.shingles import blocks, mixed
from gavel.llm.storage import materialise
from gavel.llm.suffixes import suffix_array

#: Bytes that count as a repeat; bytes that are hashed for an anchor.
LENGTH, ANCHOR = 200, 64
#: Bytes of segments that are sorted together, unless one anchor has more.
SHARD_BYTES = 1 << 21
#: Most different segments of one anchor that are sorted together.
HOT = 4096
#: Contents that a task remembers to have sent before it starts anew.
SENT = 500_000
_PLACES = np.uint64((1 << 30) - 1)


_BYTE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2 to the 64."""
    if len(_powers[0]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for i, b in enumerate((_BASE, inverse)):
            steps = np.full(n, b, dtype=np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def segments(texts: list[bytes], length: int = LENGTH, anchor: int = ANCHOR) -> Iterator[dict[str, np.ndarray]]:
    """Segments of texts: which text, first and last start, place and key of the anchor, hash of the content."""
    wide = length - anchor + 1
    for first, last in blocks(texts):
        part = texts[first:last]
        if not any(len(t) >= length for t in part):
            continue
        data = np.frombuffer(b"".join(part), dtype=np.uint8)
        n = len(data)
        up, down = powers(n + 1)
        total = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_BYTE[data] * down[:-1])))
        grams = mixed((total[anchor:] - total[:-anchor]) * up[anchor:])
        size = -(-len(grams) // wide) * wide
        packed = np.full(size, np.iinfo(np.uint64).max, dtype=np.uint64)
        packed[: len(grams)] = (grams & ~_PLACES) | np.arange(len(grams), dtype=np.uint64)
        rows = packed.reshape(-1, wide)  # least of each window: of the end of one row and the start of the next
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        chosen = (np.minimum(back[: size - wide + 1], ahead[wide - 1 :]) & _PLACES).astype(np.int64)
        bounds = np.cumsum([0, *map(len, part)])
        valid = np.zeros(n, dtype=bool)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a >= length:
                valid[a : b - length + 1] = True
        starts = np.flatnonzero(valid)
        own = chosen[starts]
        cuts = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (np.diff(starts) != 1))))
        lo, hi, at = starts[cuts], starts[np.concatenate((cuts[1:], [len(starts)])) - 1], own[cuts]
        body = (total[hi + length] - total[lo]) * up[hi + length]
        content = mixed(mixed(body) + (at - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (hi - lo).astype(np.uint64))
        doc = np.searchsorted(bounds, lo, side="right") - 1
        yield {"text": doc + first, "lo": lo - bounds[doc], "hi": hi - bounds[doc], "at": at - bounds[doc], "key": grams[at].view(np.int64), "content": content.view(np.int64)}


def _row() -> Column:
    """64 bits that stand for a row's id and text; rows that agree in both lose the same bytes."""
    return F.xxhash64("doc_id", "text").alias("row")


def _bytes(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _sliced(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches: Python copies of texts are short-lived."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _segments(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """row, span (first and last start), key, content of all segments."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in _sliced(batches):
                for s in segments(_bytes(batch.column("text")), length, anchor):
                    columns = [batch.column("row").take(pa.array(s["text"])), pa.array(s["lo"] << 32 | s["hi"]), pa.array(s["key"]), pa.array(s["content"])]
                    yield pa.RecordBatch.from_arrays(columns, ["row", "span", "key", "content"])

    return docs.select(_row(), "text").mapInArrow(scan, "row long, span long, key long, content long")


class Settler:
    """Reads segments sorted by key and content, in pieces, and keeps one row between them.

    Kind 0: the content occurs again, so all of it repeats. Kind 1: it does not, but its anchor has other contents, so
    parts may. A content that is alone with its anchor is dropped.
    """

    def __init__(self) -> None:
        self.held: np.ndarray | None = None  # row, span, key, content of a content seen once so far
        self.last = (0, 0)  # key and content of the last row
        self.again = self.others = self.any = False  # the last content was seen twice; its key has other contents

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Settled rows (columns row, span, key, content) and their kinds."""
        if self.held is not None:
            rows = np.concatenate((self.held, rows))
        if not len(rows):
            return rows, np.zeros(0, dtype=np.int32)
        key, content = rows[:, 2], rows[:, 3]
        new_key = np.concatenate(([True], key[1:] != key[:-1]))
        new = new_key | np.concatenate(([True], content[1:] != content[:-1]))
        start = np.flatnonzero(new)
        count = np.diff(np.concatenate((start, [len(rows)])))
        group = np.cumsum(new_key[start]) - 1  # of each run, which key of this piece
        runs = np.bincount(group)
        if self.any and self.last[0] == key[0]:
            goes_on = self.held is not None or self.last[1] == content[0]
            count[0] += goes_on and self.again
            runs[0] += self.others if goes_on else 1
        many = runs[group] > 1
        kind = np.where(count > 1, 0, np.where(many, 1, 2))
        self.again, self.others, self.any, self.last = bool(count[-1] > 1), bool(many[-1]), True, (key[-1], content[-1])
        each = np.repeat(kind, np.diff(np.concatenate((start, [len(rows)]))))
        self.held = None if self.again else rows[-1:]
        stop = len(rows) if self.again else len(rows) - 1
        keep = np.flatnonzero(each[:stop] < 2)
        return rows[keep], each[keep].astype(np.int32)

    def end(self) -> tuple[np.ndarray, np.ndarray]:
        """What the held row turns out to be."""
        rows = self.held if self.held is not None and self.others else np.zeros((0, 4), dtype=np.int64)
        return rows, np.ones(len(rows), dtype=np.int32)


class Variety:
    """Reads keys and contents sorted by both, in pieces, and tells which keys have more than `hot` contents."""

    def __init__(self, hot: int) -> None:
        self.hot, self.last, self.seen = hot, None, 0  # last key and content, contents of that key so far

    def take(self, key: np.ndarray, content: np.ndarray) -> np.ndarray:
        """Keys of this piece that are known to be hot by its end."""
        if not len(key):
            return key
        new_key = np.concatenate(([True], key[1:] != key[:-1]))
        new = new_key | np.concatenate(([True], content[1:] != content[:-1]))
        start = np.flatnonzero(new_key)
        number = np.add.reduceat(new.astype(np.int64), start)
        if self.last is not None and self.last[0] == key[0]:
            number[0] += self.seen - (self.last[1] == content[0])
        self.last, self.seen = (key[-1], content[-1]), int(number[-1])
        return key[start][number > self.hot]


def _settled(found: DataFrame, hot: int = HOT) -> DataFrame:
    """row, span, kind, and for kind 1 key and content: the segments that repeat, or may in parts. Kind 2: only the key of a hot anchor."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, settler, variety = ["row", "span", "key", "content"], Settler(), Variety(hot)

        def made(rows: np.ndarray, kind: np.ndarray) -> pa.RecordBatch:
            columns = [pa.array(rows[:, 0]), pa.array(rows[:, 1]), pa.array(kind), *(pa.array(np.where(kind > 0, rows[:, i], 0)) for i in (2, 3))]
            return pa.RecordBatch.from_arrays(columns, ["row", "span", "kind", "key", "content"])

        for batch in batches:
            piece = np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names], axis=1)
            yield made(*settler.take(piece))
            if len(many := variety.take(piece[:, 2], piece[:, 3])):
                none = np.zeros(len(many), dtype=np.int64)
                yield made(np.stack((none, none, many, none), axis=1), np.full(len(many), 2, dtype=np.int32))
        yield made(*settler.end())

    return found.repartition("key").sortWithinPartitions("key", "content").mapInArrow(settle, "row long, span long, kind int, key long, content long")


def _bodies(docs: DataFrame, bits, length: int, anchor: int, hot, of_hot: bool = False) -> DataFrame:
    """key, content, starts, body: segments whose anchor is in the bitmap, with their bytes; equal ones of a task mostly once.

    hot: a bitmap of the keys of hot anchors, broadcast, or None. Only segments of keys in it are returned if of_hot
    is set, else all others; either way is right for any key.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        with np.errstate(over="ignore"):
            for batch in _sliced(batches):
                texts = _bytes(batch.column(0))
                for s in segments(texts, length, anchor):
                    keep = np.flatnonzero(bitmaps.among(bits.value, s["key"]))
                    if hot is not None:
                        keep = keep[bitmaps.among(hot.value, s["key"][keep]) == of_hot]
                    keep = keep[np.unique(s["content"][keep], return_index=True)[1]]
                    keep = keep[[c not in sent for c in s["content"][keep].tolist()]] if len(keep) else keep
                    sent = set() if len(sent) > SENT else sent
                    sent.update(s["content"][keep].tolist())
                    body = [texts[t][a : b + length] for t, a, b in zip(s["text"][keep], s["lo"][keep], s["hi"][keep], strict=True)]
                    columns = [pa.array(s["key"][keep]), pa.array(s["content"][keep]), pa.array((s["hi"] - s["lo"] + 1)[keep]), pa.array(body, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "content", "starts", "body"])

    return docs.select("text").mapInArrow(scan, "key long, content long, starts long, body binary")


def repeated_starts(bodies: list[bytes], starts: list[int], length: int) -> list[np.ndarray]:
    """Of each body, which of its first `starts` places begin a string of `length` bytes that begins elsewhere too."""
    ends = np.cumsum([len(b) + 1 for b in bodies])
    text = np.frombuffer(b"\0".join(bodies) + b"\0", dtype=np.uint8).astype(np.int64) + 2
    text[ends - 1] = 1
    order, common = suffix_array(np.concatenate((text, [0])))
    is_start = np.zeros(len(text) + 1, dtype=bool)
    for end, b, n in zip(ends, bodies, starts, strict=True):
        is_start[end - 1 - len(b) : end - 1 - len(b) + n] = True
    long = np.concatenate((common >= length, [False]))  # strings that go beyond a body hold its end mark, and bodies differ there
    hit = np.zeros(len(text) + 1, dtype=bool)
    hit[order] = long[:-1] | long[1:]
    hit &= is_start
    return [np.flatnonzero(hit[end - 1 - len(b) : end - 1 - len(b) + n]) for end, b, n in zip(ends, bodies, starts, strict=True)]


def _runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cuts = np.flatnonzero(np.concatenate(([len(places) > 0], np.diff(places) != 1)))
    return places[cuts], places[np.concatenate((cuts[1:], [len(places)])) - 1] if len(cuts) else places


def _sorted_shards(bodies: DataFrame, length: int) -> DataFrame:
    """key, content, first, last: runs of repeated starts within each body."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush():
            rows = [(k, c, int(a), int(b)) for (k, c, _, _), hit in zip(held, repeated_starts([h[3] for h in held], [h[2] for h in held], length), strict=True) for a, b in zip(*_runs(hit), strict=True)]
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["key", "content", "first", "last"])

        for batch in _sliced(batches):
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "content", "starts", "body")), strict=True):
                if held and row[:2] == held[-1][:2]:
                    continue
                if size > SHARD_BYTES and row[0] != held[-1][0]:
                    yield flush()
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield flush()

    dealt = bodies.repartition("key").sortWithinPartitions("key", "content")
    return dealt.mapInArrow(sort, "key long, content long, first long, last long")


def _matched(bodies: DataFrame, length: int) -> DataFrame:
    """key, content, first, last: starts within each body whose strings of `length` bytes are in other rows or starts too.

    Equal bodies may come in several rows: their content occurs again, so that all of it is settled elsewhere.
    """
    names = ["one", "two", "key", "content", "start"]

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches, 64):
            starts = batch.column("starts").to_numpy(zero_copy_only=False)
            digests = b"".join(xxhash.xxh3_128_digest(b[i : i + length]) for b, n in zip(batch.column("body").to_pylist(), starts.tolist(), strict=True) for i in range(n))
            both = np.frombuffer(digests, dtype=np.int64).reshape(-1, 2)
            each = np.repeat(np.arange(len(starts)), starts)
            place = np.arange(len(each)) - np.repeat(np.cumsum(starts) - starts, starts)
            columns = [both[:, 0], both[:, 1], *(batch.column(c).to_numpy(zero_copy_only=False)[each] for c in ("key", "content")), place]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settler = Settler()
        for batch in batches:
            rows, kind = settler.take(np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in ("content", "start", "one", "two", "key")], axis=1))
            rows = rows[kind == 0]
            yield pa.RecordBatch.from_arrays([pa.array(rows[:, i]) for i in (4, 0, 1, 1)], ["key", "content", "first", "last"])

    dealt = bodies.mapInArrow(strings, ", ".join(f"{n} long" for n in names)).repartition("one").sortWithinPartitions("one", "two")
    return dealt.mapInArrow(settle, "key long, content long, first long, last long")


def repeated_spans(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """row, first, last: bytes to remove (last exclusive), overlapping."""
    settled = materialise(_settled(_segments(docs, length, anchor), hot), "repeat-segments")
    single = settled.filter("kind = 1")
    ship = lambda keys, n: docs.sparkSession.sparkContext.broadcast(bitmaps.build(keys, bitmaps.bits_for(n)))
    anchors, many = single.select("key").distinct(), settled.filter("kind = 2").select("key").distinct()
    bits, n_hot = ship(anchors, anchors.count()), many.count()
    keys = ship(many, n_hot) if n_hot else None
    partial = materialise(_sorted_shards(_bodies(docs, bits, length, anchor, keys), length), "repeat-starts")
    if n_hot:
        partial = partial.unionAll(materialise(_matched(_bodies(docs, bits, length, anchor, keys, of_hot=True), length), "repeat-hot-starts"))
    lo, hi = F.shiftrightunsigned("span", 32), F.col("span").bitwiseAND(0xFFFFFFFF)
    whole = settled.filter("kind = 0").select("row", lo.alias("first"), (hi + length).alias("last"))
    parts = single.select("row", lo.alias("lo"), "key", "content").join(partial, ["key", "content"])
    return whole.unionAll(parts.select("row", (F.col("lo") + F.col("first")).alias("first"), (F.col("lo") + F.col("last") + length).alias("last")))


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left of text, bytes removed, maximal removed runs."""
    kept, at, removed, runs, end = [], 0, 0, 0, -1
    for a, b in sorted(spans):
        if a > end:
            kept.append(text[at:a])
            runs += 1
            removed += b - a
            at = end = b
        elif b > end:
            removed += b - end
            at = end = b
    return b"".join([*kept, text[at:]]), removed, runs


def deduplicate_bytes(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """doc_id, kept (binary: what is left of the text's UTF-8 bytes), n_bytes, n_removed, n_spans: a row for each of docs.

    Each byte goes that lies in `length` bytes which also start anywhere else, in the same document too; overlaps
    count, and so do repeated rows. Null texts are empty, shorter texts are left alone. Other columns are not carried.
    """
    spans = repeated_spans(docs, length, anchor, hot).groupBy("row").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    joined = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row(), "text").join(spans, "row", "left").select("doc_id", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _sliced(batches):
            texts = _bytes(part.column("text"))
            out = [without_spans(t, [(x["first"], x["last"]) for x in s or []]) for t, s in zip(texts, part.column("spans").to_pylist(), strict=True)]
            columns = [part.column("doc_id"), pa.array([o[0] for o in out], pa.binary()), pa.array([len(t) for t in texts], pa.int64()), *(pa.array([o[i] for o in out], pa.int64()) for i in (1, 2))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return joined.mapInArrow(cut, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")
