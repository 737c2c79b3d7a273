"""The registered query of each corpus operator: its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import exact_dedup, fill_middle, language_id, lm_scoring, mixing, ngram_join, packing, periodic_runs, private_data, quality_rules, substring_dedup, top_search, warc


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score_repetition(_documents(spark, sf_dir))


def op3_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data.find_private_data(_documents(spark, sf_dir))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_near_duplicates(_documents(spark, sf_dir))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(_documents(spark, sf_dir))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_exact(_documents(spark, sf_dir), keep="max")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_language(_documents(spark, sf_dir))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(_documents(spark, sf_dir))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op11_top_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_search.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.collapse_runs(_documents(spark, sf_dir), tails=True)


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.fill_in_middle(_documents(spark, sf_dir)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mixing,
        op2_quality_rules,
        op3_private_data,
        op4_ngram_join,
        op5_substring_dedup,
        op6_exact_dedup,
        op7_language_id,
        op8_packing,
        op9_lm_scoring,
        op10_warc,
        op11_top_search,
        op12_periodic_runs,
        op13_fill_middle,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op4_ngram_join": ngram_join.SQL,
    "op5_substring_dedup": substring_dedup.SQL,
    "op6_exact_dedup": exact_dedup.SQL,
    "op10_warc": warc.SQL,
    "op11_top_search": top_search.SQL,
    "op13_fill_middle": fill_middle.SQL,
}
