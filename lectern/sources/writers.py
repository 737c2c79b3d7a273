"""Sinks: append of new rows, upsert, partitions replaced. An index writes itself: operators.index."""

from __future__ import annotations

from lectern.operators.etl import insert_new, upsert
from pyspark.sql import DataFrame


def append_new(new: DataFrame, path: str, key: list[str]) -> None:
    """Append rows whose key is not in the table yet."""
    insert_new(new, new.sparkSession.read.parquet(path), key).write.mode("append").parquet(path)


def upserted(existing_path: str, new: DataFrame, key: list[str], out_path: str) -> None:
    """Write the table with new rows in place of those of the same key, to another path."""
    upsert(new.sparkSession.read.parquet(existing_path), new, key).write.parquet(out_path)


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Overwrite only the partitions that df holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
