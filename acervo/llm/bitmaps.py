"""A set of hashes as a map of bits, of a size that is bounded whatever the set's size."""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2**MOST_BITS bits are 32 MB: the most that goes through the driver and to each executor.
LEAST_BITS, MOST_BITS = 15, 28
#: Bits per hash, while the map can still grow: about one foreign hash in so many passes.
ROOM = 256
_BUCKET = 15  # bits of a position within one of Spark's bitmaps


def bitmap(hashes: DataFrame, column: str) -> tuple[Broadcast, int]:
    """(the map on all executors, its number of address bits) of the 64-bit numbers in ``column``.

    ``hashes`` is read twice, so it should be stored. Beyond 2**MOST_BITS bits the map grows no
    further; it then lets more foreign hashes pass, and never stops one of the set.
    """
    spark = hashes.sparkSession
    bits = min(MOST_BITS, max(LEAST_BITS, (ROOM * hashes.count() - 1).bit_length()))
    address = F.shiftrightunsigned(F.col(column), 64 - bits)
    parts = hashes.select(F.shiftright(address, _BUCKET).alias("bucket"), address.bitwiseAND(F.lit((1 << _BUCKET) - 1)).alias("at"))
    found = np.zeros(1 << (bits - 3), np.uint8)
    size = 1 << (_BUCKET - 3)
    for row in parts.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("map")).collect():
        found[row["bucket"] * size : (row["bucket"] + 1) * size] = np.frombuffer(row["map"], np.uint8)
    return spark.sparkContext.broadcast(found), bits


def in_bitmap(found: np.ndarray, bits: int, hashes: np.ndarray) -> np.ndarray:
    """Whether each unsigned 64-bit hash may be of the set; all that are, are told so."""
    address = hashes >> np.uint64(64 - bits)
    return (found[(address >> np.uint64(3)).astype(np.int64)] >> (address & np.uint64(7)).astype(np.uint8)) & 1 == 1
