"""Bitmaps hold all their keys and few others, also of keys that are all small."""

import numpy as np

from gavel.llm import bitmaps


def test_bitmap(spark):
    keys = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 40_000)
    for shown in (keys, (keys.view(np.uint64) >> np.uint64(7)).view(np.int64)):  # minima of many hashes begin with zeros
        own, others = shown[:20_000], shown[20_000:]
        made = bitmaps.build(spark.createDataFrame([(int(k),) for k in own], "key long"), bitmaps.bits_for(len(own)))
        assert bitmaps.among(made, own).all()
        assert bitmaps.among(made, others).mean() < 0.002
    assert not bitmaps.among(bitmaps.build(spark.createDataFrame([], "key long"), bitmaps.LEAST), keys).any()
