"""Anchors with very many different segments."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from gavel.llm import bitmaps, repeats

HOT = 20


def texts():
    rng = np.random.default_rng(5)
    noise = lambda n: bytes(rng.integers(97, 123, n).tolist()).decode()
    passage, tail = noise(500), noise(90)
    out = [noise(150) + passage + noise(150) for _ in range(60)]
    out += [noise(150) + passage + tail + noise(150) for _ in range(10)]  # share strings beyond the passage
    return [*out, *out[:5], noise(300) + passage[:250], passage[200:] + noise(300), "x" * 900]


def test_hot_anchors(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    counts = Counter(t[i : i + 200] for _, t in rows for i in range(len(t) - 199))
    expected = {}
    for d, t in rows:
        mark = bytearray(len(t))
        for i in range(len(t) - 199):
            if counts[t[i : i + 200]] > 1:
                mark[i : i + 200] = b"\1" * 200
        expected[d] = "".join(c for c, m in zip(t, mark, strict=True) if not m)
    for hot in (HOT, repeats.HOT):
        left = repeats.deduplicate_bytes(docs, hot=hot).select("doc_id", F.col("kept").cast("string").alias("kept"))
        assert {r["doc_id"]: r["kept"] for r in left.collect()} == expected


def test_shards_are_bounded(spark):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    settled = repeats._settled(repeats._segments(docs, 200, 64), HOT)
    hot = sorted({r["key"] for r in settled.filter("kind = 2").collect()})
    every = np.full(1 << 13, 255, dtype=np.uint8)
    context = spark.sparkContext
    marked = lambda keys: context.broadcast(bitmaps.build(spark.createDataFrame([(k,) for k in keys], "key long"), 28))
    bodies = lambda keys, **o: repeats._bodies(docs, context.broadcast(every), 200, 64, marked(keys) if keys else None, **o)
    most = lambda frame: frame.groupBy("key").agg(F.countDistinct("content").alias("n")).agg(F.max("n")).head()[0]
    assert hot and most(bodies([])) > HOT  # all of these once went to one shard
    assert most(bodies(hot)) <= HOT
    assert {r["key"] for r in bodies(hot, of_hot=True).collect()} == set(hot)


def test_variety():
    rng = np.random.default_rng(6)
    pairs = np.array(sorted(zip(rng.integers(0, 6, 400).tolist(), rng.integers(0, 30, 400).tolist(), strict=True)))
    pairs[pairs[:, 0] == 3, 1] = 0
    want = {k for k in range(6) if len(set(pairs[pairs[:, 0] == k, 1].tolist())) > 10}
    for size in (1, 7, 400):
        variety = repeats.Variety(10)
        assert {k for a in range(0, 400, size) for k in variety.take(*pairs[a : a + size].T).tolist()} == want and 3 not in want
