"""Text functions over documents, pages and names."""

from __future__ import annotations

from lectern.functions import hashing, morphology, text
from lectern.plans.registry import query, table
from lectern.sources.store import delete_table, table_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names are written in Arabic letters, so that the script's rules have something to work on.
_LATIN, _ARABIC = "abcdefghijklmnopqrstuvwxyz", "ابجدهوزحطيكلمنسعفصقرشتثخذض"
_WORDS = f"(SELECT DISTINCT translate(lower(w), '{_LATIN}', '{_ARABIC}') AS word FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS w FROM documents))"


def arabic_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(word) of the documents, in Arabic letters. Words are told apart first, and transliterated after that."""
    words = table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("w")).distinct()
    return words.select(F.translate(F.lower("w"), _LATIN, _ARABIC).alias("word")).distinct()


def rooted_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(word, root) of the documents' words, null where no pattern fits. They are written once: what asks for roots would
    otherwise read the texts each time, and its conditions would be moved below the distinct words, to every occurrence."""
    words, path = table_path(spark, "words"), table_path(spark, "roots")
    arabic_words(spark, sf_dir).write.parquet(words)
    spark.read.parquet(words).withColumn("root", morphology.extract_root("word")).write.parquet(path)
    delete_table(spark, words)
    return spark.read.parquet(path)


def _affix_sql(column: str, affixes: list[str], least: int, prefix: bool) -> str:
    whens = []
    for a in affixes:
        if prefix:
            whens.append(f"WHEN starts_with({column}, '{a}') AND length({column}) - {len(a)} >= {least} THEN substr({column}, {len(a) + 1})")
        else:
            whens.append(f"WHEN ends_with({column}, '{a}') AND length({column}) - {len(a)} >= {least} THEN substr({column}, 1, length({column}) - {len(a)})")
    return f"CASE {' '.join(whens)} ELSE {column} END"


def _root_sql(column: str) -> str:
    whens = []
    for p in morphology.ROOT_PATTERNS:
        conditions = [f"length({column}) = {len(p)}"]
        for i, c in enumerate(p):
            letter = f"substr({column}, {i + 1}, 1)"
            if c == "P":
                conditions.append(f"{letter} IN ({', '.join(repr(x) for x in morphology.IMPERFECT_PREFIXES)})")
            elif not c.isdigit():
                conditions.append(f"{letter} = '{c}'")
            elif p.index(c) < i:
                conditions.append(f"{letter} = substr({column}, {p.index(c) + 1}, 1)")
        letters = " || ".join(f"substr({column}, {p.index(d) + 1}, 1)" for d in sorted({c for c in p if c.isdigit()}))
        whens.append(f"WHEN {' AND '.join(conditions)} THEN {letters}")
    return f"CASE {' '.join(whens)} END"


@query("SELECT doc_id, trim(regexp_replace(translate(text, 'آأإٱىةء', 'اااايه'), '\\s+', ' ', 'g')) AS normalized FROM documents")
def norm_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.normalize_search("text").alias("normalized"))


_STRIP = """regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?is)<style[^>]*>.*?</style>', '', 'g')"""
for _entity, _char in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''")):
    _STRIP = f"replace({_STRIP}, '{_entity}', '{_char}')"


@query(
    f"""SELECT page_id, array_to_string(list_filter(list_transform(string_split(
    regexp_replace(regexp_replace(regexp_replace({_STRIP}, '(?i)</?(p|div|br|h[1-6]|li|tr)[^>]*>', chr(10), 'g'), '<[^>]+>', '', 'g'), '[ \\t]+', ' ', 'g'),
    chr(10)), lambda x: trim(x)), lambda x: x <> ''), chr(10)) AS plain FROM pages"""
)
def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.html_to_text("html").alias("plain"))


@query(
    """WITH p AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<p[^>]*>(.*?)</p>', 1)) AS x FROM pages),
t AS (SELECT page_id, trim(regexp_replace(replace(regexp_replace(x, '<[^>]+>', '', 'g'), '&nbsp;', ' '), '\\s+', ' ', 'g')) AS x FROM p)
SELECT page_id, count(*) AS n_paragraphs, sum(length(x))::BIGINT AS n_chars FROM t WHERE length(x) > 1 GROUP BY page_id"""
)
def paragraph_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = table(spark, sf_dir, "pages").select("page_id", F.explode(text.paragraph_texts("html")).alias("x"))
    return each.groupBy("page_id").agg(F.count("*").alias("n_paragraphs"), F.sum(F.length("x")).alias("n_chars"))


@query(
    """SELECT doc_id, regexp_matches(text, '\\d+\\s*-\\s*[^\\d]') AS dashed, regexp_matches(text, '(?i)licensed?') AS licence,
regexp_matches(text, '@[a-z0-9.]+') AS address, regexp_matches(text, '\\|') AS cells FROM documents"""
)
def content_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    patterns = {"dashed": r"\d+\s*-\s*[^\d]", "licence": "(?i)licensed?", "address": "@[a-z0-9.]+", "cells": r"\|"}
    return table(spark, sf_dir, "documents").select("doc_id", text.content_flags("text", patterns).alias("f")).select("doc_id", "f.*")


@query(
    """WITH c AS (SELECT doc_id, lang, len(regexp_extract_all(text, '\\p{L}')) AS n, len(regexp_extract_all(text, '[a-zA-Z]')) AS a FROM documents)
SELECT doc_id, lang <> 'en' AND n >= 10 AND a > 0.7::DOUBLE * n AS wrong FROM c"""
)
def wrong_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.wrong_language("text", F.col("lang") == "en").alias("wrong"))


@query("SELECT o_orderkey, CAST(ceil(year(o_orderdate) / 100) AS INTEGER) AS century FROM orders")
def century_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", text.century(F.year("o_orderdate").cast("string")).alias("century"))


@query("SELECT doc_id, sha256('page:' || source || ':' || doc_id || ':' || text) AS content_hash FROM documents")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", hashing.page_hash(F.col("source"), F.col("doc_id"), F.col("text")).alias("content_hash"))


@query("SELECT l_orderkey, l_linenumber, md5(l_orderkey || '_' || l_linenumber) AS point_id FROM lineitem")
def point_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", hashing.point_id("l_orderkey", "l_linenumber").alias("point_id"))


@query(
    f"""WITH w AS {_WORDS}, a AS (SELECT word, {_affix_sql("word", morphology.PREFIXES, 3, True)} AS p FROM w)
SELECT word, {_affix_sql("p", morphology.SUFFIXES, 3, False)} AS stem, {_affix_sql("word", morphology.ARTICLES, 3, True)} AS bare FROM a"""
)
def light_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arabic_words(spark, sf_dir).select("word", morphology.light_stem("word").alias("stem"), morphology.strip_article("word").alias("bare"))


@query(
    f"""WITH w AS {_WORDS}, a AS (SELECT word, CASE WHEN length(word) <= 2 THEN word ELSE {_affix_sql("word", morphology.LIGHT10_PREFIXES, 2, True)} END AS p FROM w)
SELECT word, CASE WHEN length(word) <= 2 THEN word ELSE {_affix_sql("p", morphology.LIGHT10_SUFFIXES, 2, False)} END AS stem FROM a"""
)
def light10_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arabic_words(spark, sf_dir).select("word", morphology.light10_stem("word").alias("stem"))


@query(f"WITH w AS {_WORDS} SELECT word, {_root_sql('word')} AS root FROM w")
def root_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arabic_words(spark, sf_dir).select("word", morphology.extract_root("word").alias("root"))


@query(
    f"""WITH w AS {_WORDS}, r AS (SELECT DISTINCT {_root_sql("word")} AS root FROM w)
SELECT root, CAST(ceil(length(root) / 3) AS BIGINT) AS tokens, 'است' || root AS tenth, 'م' || substr(root, 1, 2) || 'و' || substr(root, 3, 1) AS participle FROM r WHERE length(root) = 3"""
)
def derived_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    roots = arabic_words(spark, sf_dir).select(morphology.extract_root("word").alias("root")).distinct().filter("length(root) = 3")
    return roots.select("root", text.token_estimate("root").alias("tokens"), morphology.apply_template("root", "است123").alias("tenth"), morphology.apply_template("root", "م12و3").alias("participle"))
