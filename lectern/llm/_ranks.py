"""Row numbers within groups of any size, made in parts so that no group is one task's."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, group: str, key: F.Column, order: list[str], parts: int, rank: str = "rank") -> DataFrame:
    """df with the 0-based rank of each row in its group, by part of the hash key, then by order.

    Each group is dealt into `parts` parts; a part's rows are numbered by a window, and start after the rows of the
    parts before it. Parts are ranges of key, so that ranks follow the key.
    """
    part = F.floor(F.shiftrightunsigned(key, 33) * F.lit(parts) / F.lit(float(1 << 31))).cast("int")
    dealt = df.withColumn("_part", part)
    sizes = dealt.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(group, "_part", F.coalesce(before, F.lit(0)).alias("_before"))
    row = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*order))
    joined = dealt.withColumn("_row", row).join(sizes, [group, "_part"])
    return joined.withColumn(rank, F.col("_before") + F.col("_row") - 1).drop("_part", "_row", "_before")
