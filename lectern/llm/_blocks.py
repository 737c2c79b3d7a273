"""Counts of 64-bit hashes over a corpus in blocks of documents: hashes go to buckets, and answers come back."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm._filter import bit_filter, with_match

#: Text bytes in a block of documents; a block, and a bucket of about as many hashes, each fit in one task, whose arrays
#: take about 40 times as much. Larger blocks send fewer and longer rows, where executors have the memory.
BLOCK_BYTES = 4 << 20


#: Rows in a block at most, on average: short texts take memory for each row.
BLOCK_ROWS = 1 << 16


#: Shuffle partitions and buckets at most, however many blocks there are: a task then gets several blocks, one by one.
MOST_PARTITIONS, MOST_BUCKETS = 1 << 14, 1 << 16


def deal(docs: DataFrame, block_bytes: int = BLOCK_BYTES, least: int = 1) -> tuple[DataFrame, int]:
    """docs (doc_id, text, ...) with the number of its block; how many blocks there are, `least` at least.

    Rows are dealt by a hash of doc_id and text, whatever the partitions of docs. So rows without a doc_id, or with one
    that recurs, spread by their texts. Rows that repeat both spread by their number among these: they are alike, so
    that it doesn't matter which of them gets which.
    """
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", "text"))
    counts = keyed.groupBy("_key").agg(F.count("*").alias("n"), F.sum(size).alias("size"))
    total, rows, most = counts.agg(F.sum("size"), F.sum("n"), F.max("n")).first()
    n = max(least, -(-(total or 0) // block_bytes), -(-(rows or 0) // BLOCK_ROWS))
    numbered = keyed.withColumn("_copy", F.lit(0)) if (most or 0) < 2 else _copies_numbered(keyed, counts.filter("n > 1").select("_key"))
    dealt = numbered.withColumn("block", F.pmod(F.xxhash64("doc_id", "text", "_copy"), F.lit(n)).cast("int")).drop("_key", "_copy")
    return dealt.repartition(min(n, MOST_PARTITIONS), "block"), n


def _copies_numbered(keyed: DataFrame, repeated: DataFrame) -> DataFrame:
    """keyed with _copy: 0, 1, ... among rows of a _key, 0 for those that are alone. A key's rows are numbered within
    each partition, after those of the partitions before it, so that no task gets all of them."""
    flagged = with_match(keyed, "_key", bit_filter(repeated, "_key"), "_some")
    some = flagged.filter("_some").withColumn("_of", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id())
    each = Window.partitionBy("_key", "_of")
    before = F.sum("_n").over(Window.partitionBy("_key").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1))
    sizes = some.groupBy("_key", "_of").agg(F.count("*").alias("_n")).select("_key", "_of", F.coalesce(before, F.lit(0)).alias("_before"))
    joined = some.withColumn("_nth", F.row_number().over(each.orderBy("_row"))).join(sizes, ["_key", "_of"])
    copies = joined.withColumn("_copy", (F.col("_before") + F.col("_nth") - 1).cast("int")).drop("_of", "_row", "_nth", "_before")
    return flagged.filter("not _some").withColumn("_copy", F.lit(0)).unionByName(copies).drop("_some")


def in_order(block: pa.Table, *columns: str) -> pa.Table:
    """Columns of a block, in one piece, in an order that does not depend on how its rows arrived."""
    rows = block.select(list(columns)).sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return rows.combine_chunks() if len(rows) else rows


class Distinct:
    """The distinct values among hashes: ascending, with how often each occurs and where each hash's value is."""

    def __init__(self, h: np.ndarray):
        order = np.argsort(h)
        ranked = h[order]
        new = np.ones(len(h), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        self.values = ranked[new]
        self.counts = np.diff(np.append(np.flatnonzero(new), len(h)))
        self.at = np.empty(len(h), np.int64)
        self.at[order] = np.cumsum(new) - 1


def _ends(h: np.ndarray, n: int) -> np.ndarray:
    """Where each of n buckets starts and ends in ascending hashes: buckets are ranges of the upper bits."""
    return np.searchsorted(((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32), np.arange(n + 1, dtype=np.uint64))


def bucketed(h: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """(bucket, start, end) of the buckets, of n, that some ascending hashes fall into."""
    ends = _ends(h, n)
    return [(int(b), int(ends[b]), int(ends[b + 1])) for b in np.flatnonzero(np.diff(ends))]


def counted(dealt: DataFrame, n: int, distinct: Callable[[pa.Table], Distinct], answer: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """(block, bucket, answers): a byte for each distinct hash of a block, in order, given its count in all blocks.

    Each block sends a hash once, with its count there, so that a frequent hash is one entry for each block.
    """

    def send(block: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()  # what the worker kept of the block before
        d = distinct(block)
        some = bucketed(d.values, min(n, MOST_BUCKETS))
        counts = np.minimum(d.counts, 65535).astype(np.uint16)
        return pa.table(
            {
                "block": pa.array(np.full(len(some), block["block"][0].as_py()), pa.int32()),
                "bucket": pa.array([b for b, _, _ in some], pa.int32()),
                "hashes": pa.array([d.values[i:j].tobytes() for _, i, j in some], pa.binary()),
                "counts": pa.array([counts[i:j].tobytes() for _, i, j in some], pa.binary()),
            }
        )

    def reply(bucket: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        hashes = [np.frombuffer(x, np.uint64) for x in bucket["hashes"].to_pylist()]
        d = Distinct(np.concatenate(hashes))
        counts = np.concatenate([np.frombuffer(x, np.uint16) for x in bucket["counts"].to_pylist()])
        total = np.bincount(d.at, weights=counts).astype(np.int64)
        found = np.split(answer(total).astype(np.uint8)[d.at], np.cumsum([len(x) for x in hashes])[:-1])
        return pa.table({"block": bucket["block"], "bucket": bucket["bucket"], "answers": pa.array([x.tobytes() for x in found], pa.binary())})

    sent = dealt.groupBy("block").applyInArrow(send, "block int, bucket int, hashes binary, counts binary")
    return sent.groupBy("bucket").applyInArrow(reply, "block int, bucket int, answers binary")


def answers(found: pa.Table) -> np.ndarray:
    """The answers to one block, in the order of its distinct hashes."""
    return np.frombuffer(b"".join(found.sort_by("bucket")["answers"].to_pylist()), np.uint8)
