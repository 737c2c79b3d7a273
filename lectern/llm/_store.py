"""Written tables that cut lineage, kept in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset a temporary one is set, in local mode alone."""
    found = spark.conf.get("spark.checkpoint.dir", None) or (d.get() if (d := spark.sparkContext._jsc.sc().getCheckpointDir()).isDefined() else None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="lectern-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


#: Paths of the tables that this driver has written and not deleted, in that order.
_paths: list[str] = []


def table_path(spark: SparkSession, name: str) -> str:
    """A new path for a written table."""
    _paths.append(f"{shared_folder(spark).rstrip('/')}/lectern/{name}-{uuid.uuid4().hex}")
    return _paths[-1]


def tables_written() -> int:
    """How many tables there are by now."""
    return len(_paths)


def _delete(spark: SparkSession, path: str) -> None:
    _paths.remove(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def discard(spark: SparkSession, since: int = 0, keep: DataFrame | None = None) -> None:
    """Delete the tables written since there were so many, but for one. What was not written elsewhere can no longer be
    read."""
    for path in _paths[since:]:
        if path != getattr(keep, "_table", None):
            _delete(spark, path)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the tables that were written within: results are to be written elsewhere before."""
    began = tables_written()
    try:
        yield
    finally:
        discard(spark, began)


def release(*tables: DataFrame | None) -> None:
    """Delete written tables that nothing still to be computed reads."""
    for df in tables:
        if (path := getattr(df, "_table", None)) in _paths:
            _delete(df.sparkSession, path)


def written(df: DataFrame, name: str, *sorted_by: str, partition_by: list[str] | None = None, **options: str) -> DataFrame:
    """df, written as Parquet in the shared folder and read again; sorted_by: within each file."""
    spark = df.sparkSession
    path = table_path(spark, name)
    (df.sortWithinPartitions(*sorted_by) if sorted_by else df).write.options(**options).parquet(path, partitionBy=partition_by)
    out = spark.read.schema(df.schema).parquet(path)
    out._table = path
    return out
