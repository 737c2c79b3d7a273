"""A stored inverted index that follows its documents: segments, deletions beside them, and a manifest for each version."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from lectern.operators.index import Index
from lectern.sources.store import delete_table
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "kind string, name string, n_docs long, n_terms long"
#: Segments up to so many documents are merged by compact().
SMALL = 1_000_000
#: Terms, as they stand in documents, of a run that compact() makes.
MERGED_TERMS = 1 << 23
#: Up to so many ids are sent to every task, so that texts and postings that they are compared with are not shuffled.
SENT = 2_000_000


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _ids(ids: DataFrame, n: int) -> DataFrame:
    return F.broadcast(ids) if n <= SENT else ids


@dataclass(frozen=True)
class SegmentedIndex:
    """An index of documents (doc_id, text, kept columns) in a folder.

    A change writes what is new as a segment, as Index.write makes it, with postings in sorted runs; compact() merges
    them into longer ones. What is gone is a delta, with the documents that a segment has lost and the terms that they
    had, negative; and a manifest that names all that counts. Statistics are
    sums over both, so that scores equal those of an index made anew. Readers of a version are not disturbed by later
    ones; of two writers of one version the second fails.
    """

    spark: SparkSession
    path: str
    doc_id: str = "doc_id"
    text: str = "text"
    keep: list[str] = field(default_factory=list)
    stop_words: list[str] | None = None

    # --- versions -----------------------------------------------------------------------------------------------

    def _files(self):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifests")
        return target, target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The last version; 0 before the first change."""
        target, files = self._files()
        if not files.exists(target):
            return 0
        names = [s.getPath().getName() for s in files.listStatus(target)]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def manifest(self, version: int | None = None) -> list[tuple[str, str, int, int]]:
        version = self.version() if version is None else version
        return [tuple(r) for r in self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifests/{version:08}").collect()] if version else []

    def _commit(self, version: int, rows: list[tuple[str, str, int, int]]) -> int:
        """Publish the version after `version`: a manifest is written aside and renamed, which one writer alone can do."""
        target, files = self._files()
        aside = f"{self.path}/manifests/_{uuid.uuid4().hex}"
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(aside)
        new = self.spark._jvm.org.apache.hadoop.fs.Path
        if files.exists(new(f"{self.path}/manifests/{version + 1:08}")) or not files.rename(new(aside), new(f"{self.path}/manifests/{version + 1:08}")):
            delete_table(self.spark, aside)
            raise RuntimeError(f"version {version + 1} was written by another")
        return version + 1

    # --- reading ------------------------------------------------------------------------------------------------

    def _tables(self, rows: list[tuple[str, str, int, int]], table: str) -> DataFrame | None:
        parts = [self.spark.read.parquet(f"{self.path}/segments/{name}/{table}").withColumn("segment", F.lit(name)) for kind, name, _, _ in rows if kind == "segment"]
        return _union(parts) if parts else None

    def _deltas(self, rows: list[tuple[str, str, int, int]], table: str) -> DataFrame | None:
        parts = [self.spark.read.parquet(f"{self.path}/deltas/{name}/{table}") for kind, name, _, _ in rows if kind == "delta"]
        return _union(parts) if parts else None

    def _live(self, rows: list[tuple[str, str, int, int]], table: str) -> DataFrame | None:
        found, gone = self._tables(rows, table), self._deltas(rows, "deleted")
        if found is None or gone is None:
            return found
        return found.join(gone.select("segment", "doc_id"), ["segment", "doc_id"], "left_anti")

    def documents(self, version: int | None = None) -> DataFrame | None:
        """(segment, doc_id, kept columns, dl, digest) of the documents of a version."""
        return self._live(self.manifest(version), "documents")

    def index(self, version: int | None = None) -> Index:
        """The last version, or another that vacuum() has left, as an index to search."""
        rows = self.manifest(version)
        if not any(kind == "segment" for kind, *_ in rows):
            raise ValueError("nothing is indexed yet")
        terms, gone = self._tables(rows, "terms").select("term", "df"), self._deltas(rows, "terms")
        terms = terms if gone is None else terms.unionByName(gone.select("term", "df"))
        terms = terms.groupBy("term").agg(F.sum("df").alias("df")).filter("df > 0").withColumn("size", F.length("term"))
        n_docs, n_terms = (sum(r[i] for r in rows) for i in (2, 3))
        stats = self.spark.createDataFrame([(n_docs, n_terms / n_docs if n_docs else None)], "n_docs long, avgdl double")
        segments = [f"{self.path}/segments/{name}" for kind, name, _, _ in rows if kind == "segment"]
        variants = lambda: _union([Index.read_variants(self.spark, path) for path in segments]).distinct()
        stored = {"postings": self._live(rows, "postings").drop("segment"), "terms": terms, "variants": variants, "stats": stats}
        return Index(self._live(rows, "documents").drop("segment", "digest"), stored)

    # --- changes ------------------------------------------------------------------------------------------------

    def _digest(self) -> Column:
        return F.xxhash64(F.col(self.text), *(F.col(c) for c in self.keep))

    def _change(self, added: DataFrame | None, gone: DataFrame | None) -> int:
        """A version with documents added and others (doc_id) gone; ids that are added replace what they had."""
        version = self.version()
        rows = self.manifest(version)
        new = []
        if added is not None:
            name = uuid.uuid4().hex
            out = f"{self.path}/segments/{name}"
            docs = Index.build(added.withColumn("_digest", self._digest()), self.doc_id, self.text, [*self.keep, "_digest"], self.stop_words)
            docs = Index(docs.docs.withColumnRenamed("_digest", "digest"))
            docs.write(out)
            stored = self.spark.read.parquet(f"{out}/documents")
            n, n_terms, n_ids = stored.agg(F.count("*"), F.coalesce(F.sum("dl"), F.lit(0)), F.countDistinct("doc_id")).first()
            if n_ids < n:
                delete_table(self.spark, out)
                raise ValueError("a doc_id stands more than once, or is null")
            if n:
                new.append(("segment", name, n, n_terms))
                ids = stored.select("doc_id")
                gone = ids if gone is None else gone.unionByName(ids).distinct()
            else:
                delete_table(self.spark, out)
        live = self._live(rows, "documents")
        if live is not None and gone is not None:
            name = uuid.uuid4().hex
            out = f"{self.path}/deltas/{name}"
            live.join(gone, "doc_id", "left_semi").select("segment", "doc_id", "dl").write.parquet(f"{out}/deleted")
            lost = self.spark.read.parquet(f"{out}/deleted")
            n, n_terms = lost.agg(F.count("*"), F.coalesce(F.sum("dl"), F.lit(0))).first()
            if n:
                terms = []  # those of lost documents, as their segments' postings tell
                for segment, m in lost.groupBy("segment").count().collect():
                    held = self.spark.read.parquet(f"{self.path}/segments/{segment}/postings").select("term", "doc_id")
                    held = held.join(_ids(lost.filter(F.col("segment") == segment).select("doc_id"), m), "doc_id", "left_semi")
                    terms.append(held.groupBy("term").agg((-F.count("*")).alias("df")).select(F.lit(segment).alias("segment"), "term", "df"))
                _union(terms).write.parquet(f"{out}/terms")
                new.append(("delta", name, -n, -n_terms))
            else:
                delete_table(self.spark, out)
        return self._commit(version, [*rows, *new]) if new else version

    def upsert(self, docs: DataFrame) -> int:
        """Documents are added, or replace those of their doc_id; the version that has them."""
        return self._change(docs, None)

    def delete(self, ids: DataFrame) -> int:
        """Documents of these ids (doc_id) go; unknown ids do nothing."""
        return self._change(None, ids.select(F.col(self.doc_id).alias("doc_id")).distinct())

    def sync(self, docs: DataFrame) -> int:
        """The index holds exactly docs: those that are new or differ in text or kept columns are written, and those that
        it alone has go. What is equal is not analysed again."""
        live = self.documents()
        if live is None:
            return self.upsert(docs)
        held = live.select("doc_id", F.col("digest").alias("_held"))
        found = docs.select(F.col(self.doc_id).alias("doc_id"), self._digest().alias("_digest")).join(held, "doc_id", "full")
        aside = f"{self.path}/deltas/_{uuid.uuid4().hex}"  # ids alone are compared, so that texts stay where they are
        differ = F.col("_digest").isNull() | F.col("_held").isNull() | (F.col("_held") != F.col("_digest"))
        found.filter(differ).select(F.col("doc_id").alias("_id"), F.col("_digest").isNull().alias("missing")).write.parquet(aside)
        try:
            changed, missing = (self.spark.read.parquet(aside).filter(F.col("missing") == x).select("_id") for x in (False, True))
            n, n_ids = changed.agg(F.count("*"), F.count("_id")).first()
            if n_ids < n:
                raise ValueError("a doc_id is null")
            return self._change(docs.join(_ids(changed, n), F.col(self.doc_id) == F.col("_id"), "left_semi"), missing.withColumnRenamed("_id", "doc_id"))
        finally:
            delete_table(self.spark, aside)

    def compact(self, small: int = SMALL) -> int:
        """Segments of up to `small` documents become one, without what they have lost; others keep their deltas."""
        version = self.version()
        rows = self.manifest(version)
        merged = [name for kind, name, n, _ in rows if kind == "segment" and n <= small]
        if len(merged) < 2 and not any(kind == "delta" for kind, *_ in rows) or not merged:
            return version
        name = uuid.uuid4().hex
        out = f"{self.path}/segments/{name}"
        of = F.col("segment").isin(merged)
        lost = self._deltas(rows, "deleted")
        n_lost = -sum(n for kind, _, n, _ in rows if kind == "delta")
        parts = []
        for segment in merged:
            part = self.spark.read.parquet(f"{self.path}/segments/{segment}/postings")
            parts.append(part if lost is None else part.join(_ids(lost.filter(F.col("segment") == segment).select("doc_id"), n_lost), "doc_id", "left_anti").select(part.columns))
        n_terms = sum(n for kind, name, _, n in rows if kind == "segment" and name in merged)
        Index.write_merged(out, _union(parts).coalesce(max(1, -(-n_terms // MERGED_TERMS))))
        Index.write_terms(out, self._live(rows, "documents").filter(of).drop("segment"))
        stored = self.spark.read.parquet(f"{out}/documents")
        n, n_terms = stored.agg(F.count("*"), F.coalesce(F.sum("dl"), F.lit(0))).first()
        new = [r for r in rows if r[0] == "segment" and r[1] not in merged] + ([("segment", name, n, n_terms)] if n else [])
        gone = self._deltas(rows, "deleted")
        if gone is not None:
            rest = uuid.uuid4().hex
            gone.filter(~of).write.parquet(f"{self.path}/deltas/{rest}/deleted")
            self._deltas(rows, "terms").filter(~of).write.parquet(f"{self.path}/deltas/{rest}/terms")
            n, n_terms = self.spark.read.parquet(f"{self.path}/deltas/{rest}/deleted").agg(F.count("*"), F.coalesce(F.sum("dl"), F.lit(0))).first()
            if n:
                new.append(("delta", rest, -n, -n_terms))
        return self._commit(version, new)

    def vacuum(self) -> int:
        """Delete the tables that the last version does not name; how many. Readers of earlier versions lose theirs."""
        named, gone = {name for _, name, _, _ in self.manifest()}, 0
        _, files = self._files()
        for folder in ("segments", "deltas"):
            target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
            for s in files.listStatus(target) if files.exists(target) else []:
                if s.getPath().getName() not in named:
                    files.delete(s.getPath(), True)
                    gone += 1
        return gone
