"""Reduction of a large table to the keys of a smaller one before its shuffle, by a broadcast bitmap.

A join shuffles both sides whole, also the rows of a history that can't match.  Here the keys of the smaller side set bits of
a bitmap of a stated size, by a hash; the rows of the larger side whose bit isn't set are dropped where they are read.
No row with a matching key is lost; of the others, a share passes that is the bitmap's fill, and the join that follows removes
them.  The broadcast is ``bits / 8`` bytes at most, whatever the number of keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 4 MB
DEFAULT_BITS = 1 << 25
#: most bits: 64 MB
MAX_BITS = 1 << 29
#: bits for each key, at which one row in sixteen passes that has no match
BITS_PER_KEY = 16


def bits_for(keys: int) -> int:
    """Bits of a bitmap for so many keys: a power of two, ``MAX_BITS`` at most."""
    return min(max(1 << (BITS_PER_KEY * max(keys, 1) - 1).bit_length(), 1 << 15), MAX_BITS)


def _place(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits)) + 1


def reduced_to_keys(df: DataFrame, key: str, keys: DataFrame, keys_col: str, bits: int = DEFAULT_BITS) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be among ``keys``: all that are, and a few others; a NULL key is none."""
    place = _place(F.col(keys_col), bits)
    bitmaps = (
        keys.where(F.col(keys_col).isNotNull())
        .select(F.bitmap_bucket_number(place).alias("_kf_bucket"), F.bitmap_bit_position(place).alias("_kf_bit"))
        .groupBy("_kf_bucket").agg(F.bitmap_construct_agg("_kf_bit").alias("_kf_bits"))
    )
    mine = _place(F.col(key), bits)
    bit = F.bitmap_bit_position(mine)
    byte = F.conv(F.hex(F.substring("_kf_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (bit % 8).cast("int")) == 1
    held = df.where(F.col(key).isNotNull())
    # bits / 8 bytes at most
    return held.join(F.broadcast(bitmaps), F.bitmap_bucket_number(mine) == F.col("_kf_bucket"), "inner").where(is_set).select(*df.columns)
