"""Prefilters of bounded size: a bitmap of hashed keys tells most rows without a partner from the others.

A clear bit proves that a key is absent; a set bit says nothing.  So rows with a clear bit need no join
and do not move, whatever the number of keys; more keys than bits cost time and change no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 25  # 4 MB


def key_bits(keys: DataFrame, key: Column, bits: int = BITS) -> DataFrame:
    """(bucket, map): the bits at the hashes of ``key``, ``bits / 8`` bytes at most."""
    spot = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    marks = keys.select(F.bitmap_bucket_number(spot).alias("bucket"), F.bitmap_bit_position(spot).alias("bit"))
    return marks.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("map"))


def with_maybe(df: DataFrame, key: Column, bitmap: DataFrame, out: str, bits: int = BITS) -> DataFrame:
    """Add boolean ``out``: whether the bit of ``key`` is set.  The bitmap's size is bounded, so it is
    broadcast; the rows do not move."""
    spot = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    place = F.bitmap_bit_position(spot)
    byte = F.conv(F.hex(F.substring(F.col("_bitmap"), (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.pmod(F.floor(byte / F.pow(F.lit(2), place % 8)), F.lit(2))
    joined = df.withColumn("_bucket", F.bitmap_bucket_number(spot)).join(F.broadcast(bitmap.toDF("_bucket", "_bitmap")), "_bucket", "left")
    return joined.withColumn(out, F.coalesce(bit == 1, F.lit(False))).drop("_bucket", "_bitmap")
