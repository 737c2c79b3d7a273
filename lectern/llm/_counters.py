"""Fixed-size arrays of counts that tasks fill and Spark adds up, part by part."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART = 1 << 14


def parts(counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(part, its bytes) of each part of an array that has a count."""
    for p in range(-(-len(counts) // PART)):
        x = counts[p * PART : (p + 1) * PART]
        if x.any():
            yield p, x.astype(np.int64).tobytes()


#: Tasks whose arrays are added up together, before those of all tasks are.
FAN = 256


def summed(rows: DataFrame, size: int) -> np.ndarray:
    """The sum over tasks of rows (part, counts), in two levels; size / PART rows reach the driver."""

    def total(part: pa.Table) -> pa.Table:
        out = np.frombuffer(part["counts"][0].as_py(), np.int64).copy()
        for b in part["counts"][1:]:
            out += np.frombuffer(b.as_buffer(), np.int64)
        return pa.table({"part": part["part"][:1], "counts": pa.array([out.tobytes()], pa.binary())})

    out = np.zeros(size, np.int64)
    some = rows.select("part", "counts", F.floor(F.spark_partition_id() / FAN).alias("tasks")).groupBy("part", "tasks").applyInArrow(total, "part int, counts binary")
    for row in some.groupBy("part").applyInArrow(total, "part int, counts binary").collect():
        x = np.frombuffer(row["counts"], np.int64)
        out[row["part"] * PART : row["part"] * PART + len(x)] = x
    return out
