"""A corpus pipeline of five stages; each works on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from lectern.llm import exact_dedup, language_id, mixing, ngram_join, packing
from lectern.llm._filter import Filter, bit_filter, with_match
from lectern.llm._store import discard, tables_written, written
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A document goes if no language is found for its text, or one with less than this calibrated probability.
MIN_LANGUAGE_SCORE = 0.4


def _keyed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with a hash of each whole row, _row: doc_id may be null, and may stand in several rows. Columns are renamed,
    so that they never meet those of a stage; the new name of each."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.toDF(*names.values())
    return plain.withColumn("_row", F.xxhash64(*plain.columns, *(F.col(c).isNull() for c in plain.columns))), names


def _free(docs: DataFrame, name: str) -> str:
    """A name that no column of docs has."""
    while name.lower() in (c.lower() for c in docs.columns):
        name = f"_{name}"
    return name


def _repeated(rows: DataFrame) -> Filter:
    """A bit filter of the _row that stand more than once."""
    return bit_filter(written(rows.groupBy("_row").count().filter("count > 1").select("_row"), "repeated"), "_row")


def _numbered(rows: DataFrame, repeated: Filter) -> DataFrame:
    """rows with the number, _n, of each among those of its _row: only rows that may be repeated are shuffled for it."""
    flagged = with_match(rows, "_row", repeated, "_again")
    some = flagged.filter("_again").withColumn("_n", F.row_number().over(Window.partitionBy("_row").orderBy("_row")))
    return flagged.filter("not _again").withColumn("_n", F.lit(1)).unionByName(some).drop("_again")


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a letter or without a likely language go. The model learns from docs itself."""
    lang, score = _free(docs, "_lang_pred"), _free(docs, "_lang_score")
    found = language_id.predict(docs, language_id.train(docs), lang, score)
    return found.filter((F.col(lang) != language_id.UNKNOWN) & (F.col(score) >= MIN_LANGUAGE_SCORE)).drop(lang, score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the row with the smallest doc_id stays."""
    return exact_dedup.kept_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each component of linked documents the row with the smallest doc_id stays."""
    keyed, names = _keyed(docs)
    asked = keyed.select(F.col("_row").alias("doc_id"), F.col(names["text"]).alias("text"))
    found = ngram_join.join_near_duplicates(asked).filter("n_shingles > 0")
    classes = written(found.select(F.col("doc_id").alias("_row"), F.col("component_id").alias("class")), "classes")
    doc_id = F.col(names["doc_id"])
    order = F.struct(doc_id.isNull().alias("none"), doc_id.alias("doc_id"), "_row")
    least = keyed.join(classes.distinct(), "_row").groupBy("class").agg(F.min(order).alias("least"))
    gone = classes.distinct().join(least.select("class", "least._row", F.lit(True).alias("stays")), ["class", "_row"], "left").filter("stays is null").select("_row")
    kept = _numbered(keyed.join(gone, "_row", "left_anti"), _repeated(classes))
    return kept.filter("_n = 1").select(*names.values()).toDF(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: all rows, in the order of their Pfair slots, which packing follows.

    Target weights are rows ** TEMPERATURE of each source. While all sources last, each holds its target weight; when
    one has run out, the others share its slots.
    """
    keyed, names = _keyed(docs)
    repeated = _repeated(keyed.select("_row"))
    places = mixing.mix(keyed.select(F.col("_row").alias("doc_id"), F.col(names["source"]).alias("source"))).select(F.col("doc_id").alias("_row"), "position")
    placed = _numbered(keyed, repeated).join(_numbered(places, repeated), ["_row", "_n"])
    return placed.orderBy("position").select(*names.values()).toDF(*docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: pieces of token ids, placed in windows that follow the order of docs."""
    return packing.pack_in_order(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_identified),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: Language identification and packing cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents; what each returns is written and read again, and what it wrote on the way, its
    input included, is deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    began = tables_written()
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(spark, began, keep=docs)
    return STAGES[-1][1](spark, docs, sf_dir)
