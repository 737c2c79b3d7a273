"""A bit filter, sized by its keys up to a bound, that drops most rows without a partner before they are shuffled."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits for each key; fewest and most bits in all. The largest filter is 32 MB: beyond about 16 million keys it lets more
#: rows pass, which costs their shuffle and changes no result.
BITS_PER_KEY, FEWEST, MOST = 16, 1 << 20, 1 << 28


class Filter(NamedTuple):
    """At most bits / 32768 rows (bucket, bits) of 4 KB, to be broadcast."""

    rows: DataFrame
    bits: int


def _bit(key: str, bits: int) -> F.Column:
    return F.expr(f"pmod(xxhash64(`{key}`), {bits}L) + 1")


def bit_filter(keys: DataFrame, key: str) -> Filter:
    """A filter with a bit for each key. keys, a written table at best, is counted first."""
    bits = min(MOST, max(FEWEST, 1 << (BITS_PER_KEY * keys.count() - 1).bit_length()))
    bit = keys.select(_bit(key, bits).alias("bit"))
    rows = bit.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    return Filter(rows, bits)


def with_match(rows: DataFrame, key: str, keys: Filter, match: str) -> DataFrame:
    """rows with a boolean column, match: whether the key's bit is set. It is for all keys in the filter, and some others."""
    bit = _bit(key, keys.bits)
    at = F.bitmap_bit_position(bit)
    table = keys.rows.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
    joined = rows.withColumn("_bucket", F.bitmap_bucket_number(bit)).join(F.broadcast(table), "_bucket", "left")
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return joined.withColumn(match, F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))).drop("_bucket", "_bits")


def may_match(rows: DataFrame, key: str, keys: Filter) -> DataFrame:
    """Rows whose key's bit is set: all whose key is in the filter, and some others."""
    return with_match(rows, key, keys, "_match").filter("_match").drop("_match")
