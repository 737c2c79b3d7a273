"""Exact de-duplication with a log-structured merge index of text digests, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm._filter import bit_filter, may_match, with_match
from lectern.llm._store import release, written

#: Rows in a memtable, about: documents whose digests one task gathers, sorts and flushes as a run.
MEMTABLE_ROWS = 1 << 16
#: Distinct digests that a run's filter is sized for, and the share of absent digests that it lets through.
FILTER_OPTIONS = {
    "parquet.bloom.filter.enabled#digest": "true",
    "parquet.bloom.filter.expected.ndv#digest": str(MEMTABLE_ROWS),
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.fpp#digest": "0.01",
}


def digest(text: F.Column) -> F.Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _order(keep: str) -> F.Column:
    """Compaction keeps the smallest of these identifiers; keep = 'max' turns the order of doc_id round, and back."""
    if keep not in ("min", "max"):
        raise ValueError(f"keep must be 'min' or 'max', not {keep!r}")
    return F.col("doc_id") if keep == "min" else F.bitwise_not("doc_id")


def flush_runs(docs: DataFrame, keep: str = "min", memtable_rows: int = MEMTABLE_ROWS, key: Callable[[F.Column], F.Column] = digest) -> DataFrame:
    """Index entries of documents in runs: run, digest, rank_id (smallest identifier), copies.

    Rows are dealt into memtables of about memtable_rows, by a hash of doc_id and digest, so that copies spread over
    them. Each memtable is one task's: it merges the copies that it meets and is flushed as a sorted run. Runs are
    Parquet files whose row groups carry Parquet's Bloom filter of the digests, and their smallest and largest digest.
    """
    rows = docs.select(key(F.col("text")).alias("digest"), _order(keep).alias("rank_id"))
    n = max(1, -(-docs.count() // memtable_rows))
    dealt = rows.withColumn("run", F.pmod(F.xxhash64("rank_id", "digest"), F.lit(n)).cast("int")).repartition(n, "run")
    runs = dealt.groupBy("run", "digest").agg(F.min("rank_id").alias("rank_id"), F.count("*").alias("copies"))
    return written(runs, "digest-runs", "run", "digest", **FILTER_OPTIONS)


def compact(*runs: DataFrame) -> DataFrame:
    """Merge runs into one, number 0: a digest's smallest identifier stays, and copies add up."""
    entries = reduce(DataFrame.unionByName, runs).groupBy("digest").agg(F.min("rank_id").alias("rank_id"), F.sum("copies").alias("copies"))
    return written(entries.select(F.lit(0).alias("run"), "digest", "rank_id", "copies"), "digest-index", "digest", **FILTER_OPTIONS)


class DigestIndex:
    """Runs of digests. insert() flushes new documents as runs; over max_flushes, all are compacted into one."""

    def __init__(self, spark: SparkSession, keep: str = "min", max_flushes: int = 8, memtable_rows: int = MEMTABLE_ROWS, key: Callable[[F.Column], F.Column] = digest):
        self.spark, self.keep, self.max_flushes, self.memtable_rows, self.key = spark, keep, max_flushes, memtable_rows, key
        self.runs: list[DataFrame] = []

    def insert(self, docs: DataFrame) -> DigestIndex:
        self.runs.append(flush_runs(docs, self.keep, self.memtable_rows, self.key))
        if len(self.runs) > self.max_flushes:
            self._compact()
        return self

    def _compact(self) -> None:
        runs, self.runs = self.runs, [compact(*self.runs)]
        release(*runs)

    def entries(self) -> DataFrame:
        """One entry for each digest after compaction: digest, rank_id, copies."""
        if not self.runs:
            return self.spark.createDataFrame([], "digest string, rank_id long, copies long")
        self._compact()
        return self.runs[0].select("digest", "rank_id", "copies")

    def contains(self, text: str) -> bool:
        """Whether a text is indexed; the equality reaches the runs' Bloom filters and digest ranges."""
        found = self.spark.range(1).select(self.key(F.lit(text))).first()[0]
        return any(not r.filter(F.col("digest") == found).isEmpty() for r in self.runs)


def dedup_exact(docs: DataFrame, keep: str = "min", memtable_rows: int = MEMTABLE_ROWS, key: Callable[[F.Column], F.Column] = digest) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if their UTF-8 bytes are; a null text counts as empty. Of equal texts the row with the smallest
    doc_id stays (keep='min'), or the largest ('max'). Rows repeated with the same doc_id each count in group_size, and
    each such row is returned as kept if the id is. A null doc_id gives way to any other, and stays if there is none.
    Empty tables give empty results; other columns are ignored. key: the digest of a text, SHA-256 unless given.

    Documents are flushed in runs, and these are compacted. keep_id and group_size are the compacted entry's. Hits,
    rows that pass a filter of the digests with two copies or more, are verified by their bytes: they are grouped by
    digest and whole text, in each task first. A group that has as many rows as its entry has copies confirms the
    entry; where texts share a digest no group does, and each group gives its own rows' identifier and number.
    """
    index = DigestIndex(docs.sparkSession, keep, memtable_rows=memtable_rows, key=key).insert(docs).entries()
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), key(F.col("text")).alias("digest"), _order(keep).alias("rank_id"))
    copied = index.filter("copies > 1")
    hits = may_match(rows, "digest", bit_filter(copied, "digest"))
    groups = hits.groupBy("digest", "text").agg(F.min("rank_id").alias("group_rank"), F.count("*").alias("n"))
    groups = groups.select("digest", F.xxhash64("text").alias("check"), "group_rank", "n")
    apart = groups.join(copied.select("digest", "copies"), "digest").filter("n <> copies").drop("copies")
    sha = F.col("digest") if key is digest else digest(F.col("text"))
    keys = rows.select("doc_id", "digest", F.xxhash64("text").alias("check"), sha.alias("text_sha256"))
    found = keys.join(index, "digest").join(apart, ["digest", "check"], "left")
    keep_rank = F.when(F.col("n").isNull(), F.col("rank_id")).otherwise(F.col("group_rank"))
    keep_id = keep_rank if keep == "min" else F.bitwise_not(keep_rank)
    return found.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("n", "copies").cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        "text_sha256",
    )


def kept_rows(docs: DataFrame) -> DataFrame:
    """Of rows with equal texts the whole row with the smallest doc_id, exactly one; a null doc_id gives way to any other.

    Rows whose digest has one copy in the compacted index stay as they are; hits are grouped by digest and whole text.
    """
    index = DigestIndex(docs.sparkSession).insert(docs).entries()
    bits = bit_filter(index.filter("copies > 1").select(F.col("digest").alias("_digest")), "_digest")
    # Columns are renamed, so that they never meet those made here.
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    plain, text = docs.toDF(*names.values()), names["text"]
    flagged = with_match(plain.withColumn("_digest", digest(F.col(text))), "_digest", bits, "_hit")
    others, doc_id, none = [c for c in plain.columns if c != text], F.col(names["doc_id"]), F.col(text).isNull()
    order = F.struct(doc_id.isNull(), doc_id, F.xxhash64(*others, *(F.col(c).isNull() for c in others)), none)
    row = F.min_by(F.struct(*others, none.alias("_null")), order).alias("row")
    groups = flagged.filter("_hit").groupBy("_digest", F.coalesce(text, F.lit("")).alias("_text")).agg(row)
    groups = groups.select(*(F.expr("if(row._null, null, _text)").alias(c) if c == text else F.col(f"row.{c}") for c in plain.columns))
    return flagged.filter("not _hit").select(*plain.columns).unionByName(groups).toDF(*docs.columns)


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
