"""Written tables that later plans read, kept in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset a temporary one is set, in local mode alone."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="lectern-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def table_path(spark: SparkSession, name: str) -> str:
    """A new path for a written table."""
    return f"{shared_folder(spark).rstrip('/')}/lectern/{name}-{uuid.uuid4().hex}"


def delete_table(spark: SparkSession, path: str) -> None:
    """Delete a written table that nothing still to be computed reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def fingerprint(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """Name, size and time of each file of a table: another tuple once the table was written again or added to."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(target, True)
    out = []
    while found.hasNext():
        s = found.next()
        out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return tuple(sorted(out))


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def rename_table(spark: SparkSession, path: str, to: str) -> bool:
    """Whether a written table got its new path."""
    new = spark._jvm.org.apache.hadoop.fs.Path
    return new(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(new(path), new(to))
