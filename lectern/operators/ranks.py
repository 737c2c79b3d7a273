"""Row numbers within groups of any size, made in parts, so that a few large groups are not a few tasks' work."""

from __future__ import annotations

from collections.abc import Callable

from lectern.sources.store import table_path
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranged(df: DataFrame, per: list[str], order: list[str]) -> DataFrame:
    """df, written, with _part: ranges of the whole order of group and order columns, of any type, so that a group of any
    size, and rows that tie, spread over many; and _tie, which puts ties in an order that stays. Within a group, later
    rows have a larger part, or the same.

    Written, as bounds of ranges are sampled, and every reader must see the same ones.
    """
    spark = df.sparkSession
    path = table_path(spark, "ranged")
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    placed = tied.repartitionByRange(*(F.col(c) for c in [*per, *order]), "_tie").withColumn("_part", F.spark_partition_id())
    placed.write.parquet(path)
    return spark.read.parquet(path)


def before_part(summary: DataFrame, per: list[str], **values: Callable[[Window], Column]) -> DataFrame:
    """summary (per, _part, ...), a row for each part of a group, with values over the parts before it: each is made of a
    window that holds these in order."""
    w = Window.partitionBy(*per).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return summary.withColumns({name: f(w) for name, f in values.items()})


def joined_by_part(rows: DataFrame, summary: DataFrame, per: list[str], columns: list[str]) -> DataFrame:
    """rows with columns of their part's summary; nulls in group columns are equal."""
    keys = [*per, "_part"]
    right = summary.select(*(F.col(c).alias(f"_of_{c}") for c in keys), *columns)
    return rows.join(right, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in keys], "left").drop(*(f"_of_{c}" for c in keys))


def numbered(df: DataFrame, per: list[str], order: list[str], name: str, total: str | None = None) -> DataFrame:
    """df with the number of each row in its group, from 1, in the order of columns; total: the group's rows as well.

    Each part of a group is numbered by itself, and starts after the rows of the parts before it.
    """
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}  # so that no column meets those made on the way
    keys, by = [names[c] for c in per], [names[c] for c in order]
    rows = ranged(df.toDF(*names.values()), keys, by)
    sizes = rows.groupBy(*keys, "_part").agg(F.count("*").alias("_rows"))
    sizes = before_part(sizes, keys, _before=lambda w: F.sum("_rows").over(w), _total=lambda w: F.sum("_rows").over(Window.partitionBy(*keys)))
    own = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*by, "_tie"))
    found = joined_by_part(rows.withColumn("_own", own), sizes, keys, ["_before", "_total"])
    extra = [F.col("_total").alias(total)] if total else []
    return found.select(*(F.col(v).alias(c) for c, v in names.items()), (F.col("_own") + F.coalesce("_before", F.lit(0))).alias(name), *extra)
