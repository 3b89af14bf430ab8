"""Joins that stay even when one key holds a large part of the rows, and that move few of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "__qx_salt"


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], spread: Column, how: str = "left", salts: int = 8) -> DataFrame:
    """Join of many rows with one row per key. spread: what tells rows of one key apart; a hot key falls into
    `salts` parts, for which the row of the small side is repeated. Null keys match nothing.
    """
    left = big.withColumn(SALT, F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    right = small.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, SALT], how).drop(SALT)


_BUCKET = 32_768  # bits of one bitmap of Spark's bitmap functions
_MOST_BITS = 1 << 28


def keep_likely(big: DataFrame, key: str, wanted: DataFrame, bits_per_key: int = 16) -> DataFrame:
    """The rows of big whose key is in wanted (a column of the same name), and a few more: those whose hash falls on the
    bit of a wanted key. Put before a join it spares the shuffle of rows that can't match.

    The bitmap is sent to all executors. It has about bits_per_key bits a key and 32 MB at most, whatever is wanted;
    beyond that more rows pass, never fewer. Null keys are dropped.
    """
    keys = wanted.select(key).where(F.col(key).isNotNull()).distinct()
    n, enough = _BUCKET, min(_MOST_BITS, bits_per_key * keys.count())
    while n < enough:
        n *= 2
    place = F.pmod(F.xxhash64(key), F.lit(n))
    maps = keys.select(place.alias("p")).groupBy(F.expr("bitmap_bucket_number(p)").alias("__qx_bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("__qx_bits"))
    told = big.withColumn("__qx_place", place).withColumn("__qx_bucket", F.expr("bitmap_bucket_number(__qx_place)"))
    byte = F.conv(F.hex(F.expr("substring(__qx_bits, CAST(bitmap_bit_position(__qx_place) DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    hit = F.expr("CAST(bitmap_bit_position(__qx_place) % 8 AS INT)")
    joined = told.join(F.broadcast(maps), "__qx_bucket").withColumn("__qx_byte", byte).withColumn("__qx_bit", hit)
    return joined.where(F.expr("(shiftright(__qx_byte, __qx_bit) & 1) = 1")).select(*big.columns)
