"""Sets of 64-bit hashes as fields of bits, of one size whatever the number of hashes.

A field answers "surely not in the set" or "perhaps": hashes that share a bit only let more through, so a job that uses a
field to leave work out stays exact. Spark sets the bits (`bitmap_construct_agg`, reduced in the map tasks); the driver
receives the field and no hash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BITS = 1 << 15  # bits per row of bitmap_construct_agg


def bit_field(hashes: DataFrame, bits: int) -> np.ndarray:
    """The bits that the column `h` sets, `bits` of them (a power of two, at least CHUNK_BITS) in bytes."""
    at = F.col("h").cast("long").bitwiseAND(F.lit(bits - 1).cast("long"))
    chunk = F.call_function("div", at, F.lit(CHUNK_BITS).cast("long"))
    rows = hashes.select(chunk.alias("chunk"), (at % CHUNK_BITS).alias("bit")).groupBy("chunk")
    field = np.zeros(bits // 8, np.uint8)
    for row in rows.agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        field[row.chunk * CHUNK_BITS // 8 : (row.chunk + 1) * CHUNK_BITS // 8] = np.frombuffer(row.bits, np.uint8)
    return field


def holds(field: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the unsigned 64-bit hashes may be in the set."""
    at = hashes & np.uint64(8 * len(field) - 1)
    return field[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1
