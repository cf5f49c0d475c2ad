"""Near-duplicate vectors against brute force: crowds, copies, pairs about the least cosine, awkward rows."""

import math
from itertools import groupby

import numpy as np
import pytest

from gavel.llm import vectordup


def brute(rows, least=vectordup.COSINE):
    """(vec_id, n_links, component_id, kept) of rows (vec_id, vector, label) with distinct ids."""
    links = {i: set() for i, *_ in rows}
    good = [(i, np.array(v, dtype=np.float64), k) for i, v, k in rows if k is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    for _, own in groupby(sorted(good, key=lambda r: (r[2], len(r[1]))), key=lambda r: (r[2], len(r[1]))):
        own = list(own)
        points = np.stack([v for _, v, _ in own])
        points /= np.linalg.norm(points, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(points @ points.T >= least), strict=True):
            if a != b:
                links[own[a][0]].add(own[b][0])
    out = []
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        out.append((i, len(links[i]), min(seen), min(seen) == i))
    return sorted(out)


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    return sorted(map(tuple, vectordup.near_vectors(frame, **options).collect()))


def unit(x):
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def crowd(rng, n, wide, spread):
    """n vectors around one, each at a cosine of about 1 / sqrt(1 + spread^2) to it."""
    return unit(unit(rng.normal(size=wide)) + spread * unit(rng.normal(size=(n, wide))))


@pytest.fixture(scope="module")
def mixture():
    rng = np.random.default_rng(1)
    parts = [unit(rng.normal(size=(300, 64))), crowd(rng, 200, 64, 0.1), crowd(rng, 120, 64, 0.2), crowd(rng, 80, 64, 0.27), crowd(rng, 9, 64, 0.15)]
    points = np.concatenate(parts).astype(np.float32)
    labels = rng.integers(0, 2, len(points))
    rows = [(i, p.tolist(), int(k)) for i, (p, k) in enumerate(zip(points, labels, strict=True))]
    copies = [(10_000 + i, rows[i % 7 + 400][1], 0) for i in range(150)]
    return rows + copies


def test_crowds_copies_and_pairs_about_the_bound(spark, mixture):
    assert found(spark, mixture) == brute(mixture)


def test_without_balls_the_result_is_the_same(spark, mixture):
    assert found(spark, mixture, crowd=10**9) == brute(mixture)


def test_awkward_rows(spark):
    a, b = [1.0, 0.0, 0.5], [2.0, 0.0, 1.0]
    rows = [(1, a, 1), (2, b, 1), (3, a, 2), (4, a, None), (5, b, None), (6, None, 1), (7, [], 1), (8, [0.0] * 3, 1), (9, [0.0] * 3, 1), (10, [None, 1.0, 1.0], 1), (11, [float("nan"), 1.0, 1.0], 1)]
    rows += [(12, [float("inf"), 0.0, 0.5], 1), (13, [1.0], 1), (14, [3.0], 1), (15, [-1.0], 1), (16, [1e-44, 0.0, 0.0], 3), (17, [3e38, 0.0, 0.0], 3), (18, a[:2], 1), (0, a, 1)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    odd = spark.createDataFrame([(None, a, 1), (5, b, 1), (5, b, 1), (None, a, None)], "vec_id long, embedding array<float>, label int")
    out = sorted(map(str, vectordup.near_vectors(odd).collect()))
    assert out == sorted(["Row(vec_id=None, n_links=2, component_id=5, kept=False)", *["Row(vec_id=5, n_links=2, component_id=5, kept=True)"] * 2, "Row(vec_id=None, n_links=0, component_id=None, kept=True)"])


def test_recall_at_the_least_cosine():
    rng = np.random.default_rng(2)
    x = unit(rng.normal(size=(4000, 64)))
    z = rng.normal(size=x.shape)
    z = unit(z - (z * x).sum(1, keepdims=True) * x)
    y = 0.93 * x + math.sqrt(1 - 0.93**2) * z
    for hashes in (2, 3, 4):
        one, two = vectordup.buckets(x, hashes), vectordup.buckets(y, hashes)
        per = one.shape[1] // vectordup.TABLES
        met = np.zeros(len(x), dtype=bool)
        for t in range(vectordup.TABLES):
            met |= (one[:, t * per : (t + 1) * per, None] == two[:, None, t * per : (t + 1) * per]).any((1, 2))
        assert met.mean() >= 0.999
    assert np.allclose(vectordup.hadamard(vectordup.hadamard(x)), x)
