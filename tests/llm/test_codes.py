"""Codes of vectors against plain Python on integers."""

import math

import numpy as np
from pyspark.sql import functions as F

from gavel.llm import codes


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """{row: (code, error)} and codebooks, for rows (id, vector) in the order of ids."""
    ints = [(i, [math.floor(scale * x) for x in v]) for i, v in rows]
    wide = len(ints[0][1]) // parts
    cut = [[v[p * wide : (p + 1) * wide] for p in range(parts)] for _, v in ints]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = [nearest(p, c[p])[1] for c in cut]
            for k in range(len(books[p])):
                held = [c[p] for c, o in zip(cut, own, strict=True) if o == k]
                if held:
                    books[p][k] = [sum(x) // len(held) for x in zip(*held, strict=True)]
    final = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    return {i: (bytes(k for _, k in f), sum(d for d, _ in f)) for (i, _), f in zip(ints, final, strict=True)}, np.array(books)


def frame(spark, rows, more=None):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int" if more else "vec_id long, embedding array<double>").repartition(3)


def test_against_plain_python(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(5, 16))
    rows = [(i, (centres[i % 5] * (i % 4) + rng.normal(size=16) * 0.2).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[i][1]) for i in range(100)] + [(2000, [0.0] * 16), (2001, [-1e-9] * 16), (2002, [1000.5] * 16)]
    out, books = codes.compress(frame(spark, rows))
    want, want_books = brute(rows)
    assert {r["vec_id"]: (bytes(r["code"]), r["error"]) for r in out.collect()} == want
    assert (books == want_books).all()


def test_fewer_rows_than_entries_and_ties(spark):
    rows = [(i, [float(i % 2)] * 8) for i in range(5)]
    out, books = codes.compress(frame(spark, rows))
    assert {r["vec_id"]: (bytes(r["code"]), r["error"]) for r in out.collect()} == brute(rows)[0] and books.shape == (8, 5, 1)


def test_awkward_rows(spark):
    good = [(3, [0.5] * 9), (1, [0.25] * 9), (1, [0.125] * 9), (None, [-0.5] * 9)]
    bad = [(4, None), (5, []), (6, [None] + [1.0] * 8), (7, [float("nan")] * 9), (8, [float("-inf")] * 9), (9, [1.0] * 4)]
    out, books = codes.compress(frame(spark, good + bad))
    assert books[0, :, 0].tolist() == [512, 1024, 2048, -2048]  # least vector first, null ids last, nine components padded
    assert sorted((r["error"], str(r["vec_id"])) for r in out.collect()) == [(0, "1"), (0, "1"), (0, "3"), (0, "None")]
    out, books = codes.compress(frame(spark, [(1, [1e300] * 8), (2, [-1e300] * 8), (3, [0.0] * 8)]), rounds=1)
    assert out.filter("error = 0").count() == 3 and np.abs(books).max() == 2**28
    out, books = codes.compress(frame(spark, bad[:5]))
    assert out.collect() == [] and codes.listed(books) == ""
    assert codes.compress(frame(spark, []))[0].count() == 0


def test_label_errors_by_broadcast_and_by_shuffle(spark):
    coded = spark.createDataFrame([(1, 5, 7), (2, None, 1), (3, None, 2), (4, 5, 0)], "vec_id long, label int, error long")
    for most in (100, 0):
        out = codes.label_errors(coded, broadcast_labels=most).collect()
        assert sorted((r["vec_id"], r["label_error"]) for r in out) == [(1, 7), (2, 3), (3, 3), (4, 7)]
    huge = codes.label_errors(coded.withColumn("error", F.lit(2**63 - 1)))
    assert {r["label_error"] for r in huge.collect()} == {2**63 - 1}


def test_assignments_join_without_a_shuffle(spark):
    from gavel.llm.storage import bucketed, discard

    one = bucketed(spark.range(1000).withColumn("x", F.col("id") * 2), "id", "test-one", 100)
    two = bucketed(one.table.select("id", (F.col("x") + 1).alias("y")), "id", "test-two", buckets=one.buckets)
    joined = one.table.join(two.table.hint("shuffle_hash"), "id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString() and joined.filter("y = 2 * id + 1").count() == 1000
    discard(spark, one, two)
    assert not spark.catalog.tableExists(one.name)


def test_only_what_moved_is_summed(spark):
    books = codes.Codebooks(np.array([[[0], [10]], [[0], [10]]], dtype=np.int64))
    rows = spark.createDataFrame([(1, [1, 9], bytes([0, 1])), (2, [9, 9], bytes([0, 1]))], "row long, ints array<long>, code binary")
    after = codes._assigned(rows, books, 2)
    assert {r["row"]: [(m["part"], m["was"], m["now"], m["values"]) for m in r["moved"]] for r in after.collect()} == {1: [], 2: [(0, 0, 1, [9])]}
    assert sorted((r["part"], r["entry"], r["count"], r["sums"]) for r in codes._changes(after, books.entries.shape).collect()) == [(0, 0, -1, [-9]), (0, 1, 1, [9])]


def test_decoded_vectors_are_as_far_as_the_error_says(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.integers(0, 4, 12) + rng.normal(size=12) * 0.01).tolist()) for i in range(300)]
    out, books = codes.compress(frame(spark, rows))
    vectors = dict(rows)
    for r in codes.decode(out, books, 12).collect():
        own = np.array([math.floor(4096 * x) for x in vectors[r["vec_id"]]])
        read = np.array(r["embedding"]) * 4096 - 0.5
        padding = books.reshape(8, books.shape[1], -1).shape[2] * 8 - 12
        assert len(read) == 12 and padding == 4
        assert abs(((own - read) ** 2).sum() - r["error"]) < 1e-3  # padding is zero in every entry
