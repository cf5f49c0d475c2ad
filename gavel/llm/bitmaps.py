"""Bitmaps of 64-bit keys (Bloom filters): a superset of the keys, of bounded size, that scans can be filtered by."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Least and most bits of a bitmap, as powers of two (8 kB, 32 MB), bits of one of its parts, bits for each key.
LEAST, MOST, PART, EACH = 16, 28, 16, 32
#: Places that each key marks; with EACH bits a key, one other key in 5,000 passes, with 13 one in 200.
PLACES = 4


def bits_for(keys: int) -> int:
    """Power of two of the bits of a bitmap of so many keys: EACH bits a key or more, within the bounds."""
    return min(MOST, max(LEAST, (EACH * keys).bit_length()))


def build(keys: DataFrame, bits: int) -> np.ndarray:
    """Bytes of the bitmap of the column `key` (long): bits are merged in executors, part by part.

    The low 56 bits of a key must be spread evenly; the top ones need not be.
    """
    mask = F.lit((1 << bits) - 1).cast("long")
    one, two = F.col("key").bitwiseAND(mask), F.shiftrightunsigned("key", 28).bitwiseAND(mask)
    slot = keys.select(F.explode(F.array(*((one + i * two).bitwiseAND(mask) for i in range(PLACES)))).alias("slot"))
    spread = slot.select(F.shiftright("slot", PART).cast("int").alias("part"), F.col("slot").bitwiseAND(F.lit((1 << PART) - 1).cast("long")).cast("int").alias("bit"))

    def pack(one: pd.DataFrame) -> pd.DataFrame:
        marks = np.zeros(1 << PART, dtype=bool)
        marks[one["bit"].to_numpy()] = True
        return pd.DataFrame({"part": [int(one["part"].iloc[0])], "bits": [np.packbits(marks).tobytes()]})

    out = np.zeros((1 << (bits - PART), (1 << PART) // 8), dtype=np.uint8)
    for r in spread.distinct().groupBy("part").applyInPandas(pack, "part int, bits binary").collect():  # fixed size
        out[r["part"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out.ravel()


def among(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the bitmap; never false for one that is."""
    mask, keys = np.uint64(8 * len(bitmap) - 1), keys.view(np.uint64)
    one, two = keys & mask, (keys >> np.uint64(28)) & mask
    found = np.ones(len(keys), dtype=bool)
    for i in range(PLACES):
        slot = ((one + np.uint64(i) * two) & mask).astype(np.int64)
        found &= (bitmap[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1
    return found
