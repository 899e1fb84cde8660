"""Maps of a fixed number of bits that tell tasks which keys may be among those looked for; they rule out, never in."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26


def bitmap(places: DataFrame) -> np.ndarray:
    """The map in which the bits of a column `place`, numbers from 0 to BITS - 1, are set: BITS / 8 bytes, whatever the input."""
    # Spark counts places and parts of a map from 1 on; the lowest bit of a byte comes first.
    numbered = places.select((F.col("place") + 1).alias("place"))
    parts = numbered.groupBy(F.bitmap_bucket_number("place").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    out = np.zeros(BITS // 8, np.uint8)
    for r in parts.toLocalIterator():
        out[(r.part - 1) * len(r.bits) : r.part * len(r.bits)] = np.frombuffer(r.bits, np.uint8)
    return out


def marked(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether the bits at `places` are set."""
    return (bits[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)
