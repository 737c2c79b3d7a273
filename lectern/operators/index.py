"""Inverted index over text: analysed terms of each document, postings and statistics."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from lectern.functions.edits import word_variants
from lectern.functions.text import fold_for_search
from lectern.sources.store import delete_table, exists, rename_table
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Words that the search index leaves out. The filter runs after letters are folded, so entries that hold
# a folded letter never match; they are kept so that the list reads as published.
STOP_WORDS = [
    "على", "في", "من", "إلى", "الى", "هذا", "هذه", "التي", "الذي", "الذين", "ان", "أن", "إن", "كان", "كانت", "عن", "مع", "هو", "هي", "ما",
    "لا", "قد", "قال", "بن", "ابن", "بين", "كل", "ذلك", "تلك", "أو", "او", "ثم", "بعد", "قبل", "عند", "له", "لها", "لهم", "به", "بها",
    "فيه", "فيها", "منه", "منها", "إذا", "اذا", "لم", "لن", "حتى", "وقد", "ولا", "وهو", "وهي", "ومن", "فإن", "فان", "والله",
]

#: A token: letters, marks, digits and underscores. ASCII is named first, which is looked up fastest.
TOKEN = r"[A-Za-z0-9_\p{L}\p{M}\p{N}]+"


def analyze(text: Column | str, stop_words: list[str] | None = None) -> Column:
    """Array of index terms in order: diacritics stripped, letters folded, split, lower-cased, stop words left out."""
    terms = F.regexp_extract_all(F.lower(F.coalesce(fold_for_search(text), F.lit(""))), F.lit(TOKEN), F.lit(0))
    if stop_words is None:
        return terms
    return F.filter(terms, lambda t: ~t.isin(stop_words))


#: Edits that fuzzy terms may be apart at most.
MOST_EDITS = 2

#: Terms up to which a lookup in a stored index names them, so that row groups without any are left out.
MAX_NAMED_TERMS = 2000


#: Terms in their order, of whole documents, that a map task sorts at a time.
RUN_TERMS = 1 << 20
#: Rows of a batch that goes back to Spark.
_ROWS = 1 << 16


def _run(ids: pa.Array, terms: pa.Array, sizes: np.ndarray) -> pa.RecordBatch:
    """Postings (term, doc_id, dl, tf, positions) of documents, sorted by term; terms: those of all, one after another."""
    coded = terms.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)  # by bytes, as Spark sorts strings
    rank = np.empty(len(order), np.int32)
    rank[order.to_numpy()] = np.arange(len(order), dtype=np.int32)
    keys = rank[coded.indices.to_numpy()]
    by = np.argsort(keys, kind="stable")
    starts = np.cumsum(sizes) - sizes
    keys, doc, place = keys[by], np.repeat(np.arange(len(sizes)), sizes)[by], (np.arange(len(by)) - np.repeat(starts, sizes))[by]
    first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])]))
    bounds = np.append(first, len(by)).astype(np.int32)
    doc = doc[first]
    columns = [
        coded.dictionary.take(order).take(pa.array(keys[first])), ids.take(pa.array(doc)), pa.array(sizes[doc].astype(np.int32)),
        pa.array(np.diff(bounds).astype(np.int64)), pa.ListArray.from_arrays(pa.array(bounds), pa.array(place.astype(np.int32))),
    ]
    return pa.RecordBatch.from_arrays(columns, ["term", "doc_id", "dl", "tf", "positions"])


def sorted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings of (doc_id, terms), in runs that are each sorted by term: no row leaves its task."""
    for batch in batches:
        ids, lists = batch.column(0), batch.column(1)
        offsets, at = lists.offsets.to_numpy(), 0
        while at < len(ids):
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + RUN_TERMS, "right")) - 1)
            if offsets[end] > offsets[at]:
                run = _run(ids.slice(at, end - at), lists.values.slice(offsets[at], offsets[end] - offsets[at]), np.diff(offsets[at : end + 1]))
                for k in range(0, len(run), _ROWS):
                    yield run.slice(k, _ROWS)
            at = end


@dataclass(frozen=True)
class Index:
    """Analysed documents: doc_id, terms (array in order), dl (their number), and columns to filter by.

    A stored index has documents without terms, and the tables that write() made: postings (term, doc_id, dl, tf,
    positions) sorted by term, in runs or ranges, terms (term, df, size), variants (variant, term), and one row of stats
    (n_docs, avgdl). Variants are made when near terms first ask for them.
    """

    docs: DataFrame
    stored: dict[str, DataFrame | Callable[[], DataFrame]] | None = None

    @classmethod
    def build(cls, df: DataFrame, doc_id: str, text: str, keep: list[str] | None = None, stop_words: list[str] | None = None) -> Index:
        terms = df.select(F.col(doc_id).alias("doc_id"), *(keep or []), analyze(text, stop_words).alias("terms"))
        return cls(terms.withColumn("dl", F.size("terms")))

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Index:
        """An index that write() made."""
        tables = {t: spark.read.parquet(f"{path}/{t}") for t in ("postings", "terms", "stats")}
        return cls(spark.read.parquet(f"{path}/documents"), tables | {"variants": lambda: cls.read_variants(spark, path)})

    @staticmethod
    def read_variants(spark: SparkSession, path: str) -> DataFrame:
        """(variant, term) of a written index's terms, sorted. The first that asks writes them beside the other tables."""
        if not exists(spark, f"{path}/variants"):
            aside = f"{path}/_{uuid.uuid4().hex}"
            variants = spark.read.parquet(f"{path}/terms").select(F.explode(word_variants(F.col("term"), MOST_EDITS)).alias("variant"), "term")
            variants.repartitionByRange("variant", "term").sortWithinPartitions("variant", "term").write.option("parquet.block.size", 8 << 20).parquet(aside)
            if exists(spark, f"{path}/variants") or not rename_table(spark, aside, f"{path}/variants"):
                delete_table(spark, aside)  # another was first
        return spark.read.parquet(f"{path}/variants")

    def write(self, path: str, buckets: int | None = None) -> None:
        """The index as tables. Postings are sorted where documents are read, in runs, and are not shuffled; with buckets,
        they are dealt in so many ranges of terms. doc_id is unique."""
        spark = self.docs.sparkSession
        if buckets:
            self.write_merged(path, self.places().repartitionByRange(buckets, "term", "doc_id"))
        else:
            found = self.docs.select("doc_id", "terms")
            schema = StructType([found.schema["doc_id"], *StructType.fromDDL("dl int, tf long, positions array<int>")])
            schema = StructType([*StructType.fromDDL("term string"), *schema])
            self._put(found.mapInArrow(sorted_runs, schema), f"{path}/postings")
        lengths = spark.read.parquet(f"{path}/postings").groupBy("doc_id").agg(F.max("dl").alias("dl"))
        docs = self.docs.drop("terms", "dl").join(lengths, "doc_id", "left")
        self.write_terms(path, docs.withColumn("dl", F.coalesce("dl", F.lit(0))))
        spark.read.parquet(f"{path}/documents").agg(F.count("*").alias("n_docs"), F.avg("dl").alias("avgdl")).write.parquet(f"{path}/stats")

    @staticmethod
    def _put(postings: DataFrame, path: str) -> None:
        """Small row groups, so that a term's rows are found by their statistics."""
        postings.write.option("parquet.block.size", 8 << 20).option("compression", "zstd").parquet(path)

    @classmethod
    def write_merged(cls, path: str, places: DataFrame) -> None:
        """Postings, those of each partition as one run, which is sorted where it is read."""
        cls._put(places.sortWithinPartitions("term", "doc_id"), f"{path}/postings")

    @staticmethod
    def write_terms(path: str, docs: DataFrame) -> None:
        """The terms of written postings, and documents."""
        terms = docs.sparkSession.read.parquet(f"{path}/postings").groupBy("term").agg(F.count("*").alias("df")).withColumn("size", F.length("term"))
        terms.repartitionByRange("size", "term").sortWithinPartitions("size", "term").write.parquet(f"{path}/terms")
        docs.write.parquet(f"{path}/documents")

    def where(self, condition: Column | str) -> Index:
        """Hits are limited to these documents, but so are the statistics: filter results where those should stay."""
        if self.stored:
            raise ValueError("a stored index is not limited: filter its results")
        return Index(self.docs.filter(condition))

    def tokens(self) -> DataFrame:
        return self.docs.select("doc_id", F.posexplode("terms").alias("pos", "term"))

    def places(self, terms: DataFrame | None = None) -> DataFrame:
        """(term, doc_id, dl, tf, positions), of some terms (term) or all: one shuffle, by document and term."""
        if self.stored:
            return self._named("postings", terms)
        each = self.docs.select("doc_id", "dl", F.posexplode("terms").alias("pos", "term"))
        each = each if terms is None else each.join(terms, "term", "left_semi")
        return each.groupBy("term", "doc_id", "dl").agg(F.count("*").alias("tf"), F.array_sort(F.collect_list("pos")).alias("positions"))

    def postings(self, terms: DataFrame | None = None) -> DataFrame:
        """(term, doc_id, tf, dl), of some terms (term) or all: combined in each task before the shuffle."""
        if self.stored:
            return self._named("postings", terms).select("term", "doc_id", "dl", "tf")
        each = self.docs.select("doc_id", "dl", F.explode("terms").alias("term"))
        each = each if terms is None else each.join(terms, "term", "left_semi")
        return each.groupBy("term", "doc_id", "dl").agg(F.count("*").alias("tf"))

    def term_stats(self, terms: DataFrame | None = None) -> DataFrame:
        """(term, df), of some terms or all."""
        if self.stored:
            return self._named("terms", terms).select("term", "df")
        each = self.docs.select(F.explode(F.array_distinct("terms")).alias("term"))
        each = each if terms is None else each.join(terms, "term", "left_semi")
        return each.groupBy("term").agg(F.count("*").alias("df"))

    def variants(self, wanted: DataFrame | None = None) -> DataFrame:
        """(variant, term) of the index's terms, of some variants (variant) or all."""
        if self.stored:
            return self._named("variants", wanted, "variant")
        each = self.term_stats().select(F.explode(word_variants(F.col("term"), MOST_EDITS)).alias("variant"), "term")
        return each if wanted is None else each.join(wanted, "variant", "left_semi")

    def corpus_stats(self) -> DataFrame:
        """One row: documents, and their mean length."""
        return self.stored["stats"] if self.stored else self.docs.agg(F.count("*").alias("n_docs"), F.avg("dl").alias("avgdl"))

    def _named(self, table: str, wanted: DataFrame | None, column: str = "term") -> DataFrame:
        """Rows of a stored table, of some terms or variants: named in the scan's filter while they are few."""
        rows = self.stored[table]
        rows = rows() if callable(rows) else rows
        if wanted is None:
            return rows
        named = [r[0] for r in wanted.select(column).limit(MAX_NAMED_TERMS + 1).collect()]
        return rows.join(wanted.select(column), column, "left_semi") if len(named) > MAX_NAMED_TERMS else rows.filter(F.col(column).isin(named))
