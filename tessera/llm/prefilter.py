"""A map-side filter of bounded size before a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the map for each wanted key, and at most: 32 MB are broadcast then, whatever the tables' sizes.
BITS, MOST = 8, 1 << 28


def flagged(df: DataFrame, wanted: DataFrame, key: str, flag: str) -> DataFrame:
    """df with a boolean: whether its key (a 64-bit hash) may be one of wanted's (stored, for it is read twice); false is
    certain. With far more keys than bits it is true for all, which costs time but no rows."""
    bits = min(MOST, 1 << max(20, (BITS * wanted.count()).bit_length()))
    slot = F.pmod(F.col(key), F.lit(bits)) + 1
    maps = wanted.groupBy(F.bitmap_bucket_number(slot).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("_map"))
    word = lambda i: F.conv(F.hex(F.substring("_map", i * 8 + 1, F.lit(8))), 16, -10).cast("long")
    maps = maps.select("_bucket", F.transform(F.sequence(F.lit(0), F.lit(511)), word).alias("_map"))  # a test is one bit of a long
    at = F.bitmap_bit_position(slot)
    bit = F.getbit(F.get("_map", F.shiftright(at, 6).cast("int")), (at.bitwiseAND(F.lit(63))).bitwiseXOR(F.lit(56)).cast("int"))  # bytes are the other way round
    joined = df.withColumn("_bucket", F.bitmap_bucket_number(slot)).join(F.broadcast(maps), "_bucket", "left")
    return joined.withColumn(flag, F.coalesce(bit == 1, F.lit(False))).select(*df.columns, flag)


def maybe_in(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows of df whose key may be one of wanted's, so that the others are not shuffled by the exact join to follow."""
    return flagged(df, wanted, key, "_maybe").where("_maybe").drop("_maybe")
