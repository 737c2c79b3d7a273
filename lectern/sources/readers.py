"""Sources: JSON and JSONL, tab-separated text, SQL dumps, JDBC, tables by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    """A Parquet scan; columns and condition reach the files."""
    df = spark.read.parquet(path)
    df = df.filter(where) if where else df
    return df.select(*columns) if columns else df


def read_json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that each hold one JSON document."""
    return spark.read.schema(schema).json(path, multiLine=True)


def read_gold_queries(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """JSONL of (query, relevant, category, difficulty, language); relevant lists ids, or objects with an id."""
    fields = "query string, category string, difficulty string, language string, notes string"
    line = spark.read.text(path).filter(F.trim("value") != "")
    told = line.select(F.from_json("value", fields).alias("q"), F.get_json_object("value", "$.relevant").alias("r"))
    as_objects, as_ids = F.from_json("r", "array<struct<id:string>>"), F.from_json("r", "array<string>")
    objects = F.col("r").rlike(r"^\s*\[\s*\{")
    rows = told.select("q.*", F.when(objects, F.transform(as_objects, lambda x: x["id"])).otherwise(as_ids).alias("relevant"))
    return rows.limit(limit) if limit else rows


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated text with a header; missing values are empty strings."""
    return spark.read.csv(path, sep="\t", header=True, quote="").na.fill("")


def read_sql_dump(spark: SparkSession, path: str, table: str, columns: list[str]) -> DataFrame:
    """Rows of the INSERT statements for a table in a SQL dump, as strings; NULL is null.

    Statements are lines of the dump, as dump tools write them; tuples are cut at the commas between values, outside
    quotes, by regular expressions.
    """
    lines = spark.read.text(path).filter(F.col("value").rlike(f"(?i)^\\s*INSERT INTO `?{table}`?"))
    value = r"(?:'(?:[^'\\]|\\.|'')*'|[^,()']+)"
    tuples = F.regexp_extract_all("value", F.lit(rf"\(\s*{value}(?:\s*,\s*{value})*\s*\)"), F.lit(0))
    each = lines.select(F.explode(tuples).alias("t"))
    values = F.regexp_extract_all("t", F.lit(value), F.lit(0))

    def plain(v):
        v = F.trim(v)
        quoted = F.regexp_replace(F.regexp_replace(F.substring(v, F.lit(2), F.length(v) - 2), r"\\(.)", "$1"), "''", "'")
        return F.when(F.upper(v) == "NULL", F.lit(None)).when(v.startswith("'"), quoted).otherwise(v)

    return each.select(values.alias("v")).select(*(plain(F.get("v", F.lit(i))).alias(c) for i, c in enumerate(columns)))


def read_jdbc(spark: SparkSession, url: str, table: str, key: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 16) -> DataFrame:
    """A table of a relational store, read in ranges of a key where bounds are given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table)
    if key and bounds:
        reader = reader.options(partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts)
    return reader.load()


def query(spark: SparkSession, text: str, **args) -> DataFrame:
    """SQL with named parameters (:name), which are bound, not pasted."""
    return spark.sql(text, args=args)
