"""Rows that may have a partner, told by a bitmap of bounded size.

A join of whole texts with few keys need not shuffle the texts that no key names. Each key
sets one of ``SLOTS`` bits; the bits, a megabyte however many keys there are, are broadcast.
A row whose bit is not set has no partner. The others still have to be joined, so the
result of the join is exact; the more keys, the fewer rows are left out.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 23


def marked(rows: DataFrame, keys: DataFrame, of: list[str], name: str = "_maybe") -> DataFrame:
    """``rows`` with a boolean that is false only where no row of ``keys`` has the same values in the columns ``of``."""
    # Spark's bitmaps count from 1
    slot = (F.pmod(F.xxhash64(*of), F.lit(SLOTS)) + 1).alias("_slot")
    bucket = F.bitmap_bucket_number("_slot").alias("_bucket")
    place = F.bitmap_bit_position("_slot")
    bits = keys.select(slot).select("_slot", bucket).repartition("_bucket")
    bits = bits.groupBy("_bucket").agg(F.bitmap_construct_agg(place).alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (place % 8).cast("int")) == 1
    placed = rows.select("*", slot).select("*", bucket).join(F.broadcast(bits), "_bucket", "left")
    return placed.withColumn(name, F.coalesce(is_set, F.lit(False))).drop("_slot", "_bucket", "_bits")
