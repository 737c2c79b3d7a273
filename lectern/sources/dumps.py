"""SQL dumps of any size: statements may span lines, and columns are those that the dump declares."""

from __future__ import annotations

import re

from lectern.operators.ranks import before_part, joined_by_part, ranged
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What ends a statement, with the line end after it.
END = ";\n"
_STRING = r"'[^'\\]*+(?:(?:\\[\s\S]|'')[^'\\]*+)*+'|\"[^\"\\]*+(?:(?:\\[\s\S]|\"\")[^\"\\]*+)*+\""
_VALUE = rf"(?:\s*+(?:{_STRING})\s*+|[^,()'\"]++)"
_NAME = r"[`\"]?{}[`\"]?"
# What a backslash and a letter stand for inside a string.
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "0": "\0", "Z": "\x1a"}
_NO_COLUMN = {"PRIMARY", "KEY", "INDEX", "UNIQUE", "CONSTRAINT", "FOREIGN", "FULLTEXT", "SPATIAL", "CHECK"}


def statements(spark: SparkSession, path: str) -> DataFrame:
    """(file, nth, statement) of dumps, in order within a file.

    Text is read in parts that end where a line ends with a semicolon. Such a part is a statement unless that semicolon
    stands inside a string: what quotes are open is carried from part to part, in ranges of a file, and parts are joined
    up to where none is. Lines that begin with -- are comments; a string should have none with one quote in it.
    """
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    parts = spark.read.option("lineSep", END).text(path).select(place.alias("p"), "value").select("p.*", F.monotonically_increasing_id().alias("id"), "value")
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace("value", r"(?m)^--.*$", ""), r"\\[\s\S]", ""), r'"[^"\']*"', "")
    parts = ranged(parts.withColumn("odd", F.length(bare) - F.length(F.replace(bare, F.lit("'"), F.lit("")))).withColumn("odd", F.col("odd") % 2), ["file"], ["start", "id"])
    earlier = Window.partitionBy("file", "_part").orderBy("start", "id").rowsBetween(Window.unboundedPreceding, -1)
    into = before_part(parts.groupBy("file", "_part").agg(F.sum("odd").alias("_odd"), F.count("*").alias("_n")), ["file"], _open=lambda w: F.sum("_odd").over(w), _nth=lambda w: F.sum("_n").over(w))
    told = joined_by_part(parts.withColumn("_own", F.coalesce(F.sum("odd").over(earlier), F.lit(0))).withColumn("_row", F.count("*").over(earlier)), into, ["file"], ["_open", "_nth"])
    told = told.withColumn("begins", ((F.col("_own") + F.coalesce("_open", F.lit(0))) % 2 == 0)).withColumn("nth", F.col("_row") + F.coalesce("_nth", F.lit(0)))
    whole = told.filter("begins and odd = 0").select("file", "nth", F.col("value").alias("statement"))
    # Parts that a string holds together: few, and each run of them is as long as one statement.
    cut = told.filter("not begins or odd = 1").select("file", "nth", "begins", "value")
    run = Window.partitionBy("file").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    joined = cut.withColumn("of", F.sum(F.col("begins").cast("int")).over(run)).groupBy("file", "of")
    joined = joined.agg(F.min("nth").alias("nth"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", "value"))), lambda x: x["value"]), END).alias("statement"))
    return whole.unionByName(joined.select("file", "nth", "statement"))


def _declared(statement: str) -> list[tuple[str, str]]:
    """(column, type) of a CREATE TABLE statement, types in Spark's terms."""
    body = re.search(r"\((.*)\)", statement, re.S)[1]
    found = []
    for piece in re.findall(r"(?:[^,(]|\([^)]*\))+", body):
        m = re.match(r"\s*[`\"]?(\w+)[`\"]?\s+(\w+)", piece)
        if not m or m[1].upper() in _NO_COLUMN:
            continue
        kind = m[2].lower()
        to = "long" if "int" in kind and "point" not in kind else "double" if kind in ("float", "double", "real", "decimal", "numeric") else "string"
        found.append((m[1], to))
    return found


def dump_tables(found: DataFrame) -> dict[str, list[tuple[str, str]]]:
    """Columns and types of each table that statements declare."""
    created = found.filter(F.col("statement").rlike(r"(?i)^[\s\S]{0,2000}?\bCREATE\s+TABLE\b") & ~F.col("statement").rlike(r"(?i)^\s*INSERT\b"))
    out = {}
    for r in created.select("statement").collect():
        m = re.search(r"(?i)CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?[`\"]?(\w+)[`\"]?\s*\(", r["statement"])
        if m:
            out[m[1]] = _declared(r["statement"][m.start() :])
    return out


def _plain(value: Column) -> Column:
    """A value of a statement as text: without its quotes, and with what was escaped."""
    v = F.trim(F.regexp_replace(value, r"^\s+|\s+$", ""))
    quote = F.substring(v, 1, 1)
    inner = F.substring(v, F.lit(2), F.length(v) - 2)
    inner = F.replace(F.replace(inner, F.lit("\\\\"), F.lit("\u0001")), F.concat(quote, quote), quote)
    for letter, char in _ESCAPES.items():
        inner = F.replace(inner, F.lit(f"\\{letter}"), F.lit(char))
    inner = F.replace(F.regexp_replace(inner, r"\\([\s\S])", "$1"), F.lit("\u0001"), F.lit("\\"))
    return F.when(F.upper(v) == "NULL", F.lit(None)).when(quote.isin("'", '"'), inner).otherwise(v)


def read_dump(spark: SparkSession, path: str, table: str, columns: list[tuple[str, str]] | None = None) -> DataFrame:
    """Rows of a table's INSERT statements, with the columns and types that the dump's CREATE TABLE declares, or those
    given where it declares none. A statement's own list of columns says which of them it fills; others are null."""
    found = statements(spark, path)
    declared = columns or next((c for name, c in dump_tables(found).items() if name.lower() == table.lower()), None)
    if declared is None:
        raise ValueError(f"the dump declares no table {table}")
    names = [c for c, _ in declared]
    head = rf"(?i)^[\s\S]*?\bINSERT\s+(?:IGNORE\s+)?INTO\s+{_NAME.format(re.escape(table))}\s*(\([^()]*\))?\s*VALUES\s*"
    told = found.filter(F.col("statement").rlike(rf"(?i)\bINSERT\s+(?:IGNORE\s+)?INTO\s+{_NAME.format(re.escape(table))}[\s(]"))
    own = F.regexp_extract("statement", head, 1)
    listed = F.transform(F.split(F.regexp_replace(own, r"[()`\"\s]", ""), ","), F.lower)
    order = F.when(own == "", F.array(*(F.lit(n.lower()) for n in names))).otherwise(listed)
    tuples = F.regexp_extract_all(F.regexp_replace("statement", head, ""), F.lit(rf"\(\s*{_VALUE}(?:\s*,\s*{_VALUE})*+\s*\)"), F.lit(0))
    rows = told.select(order.alias("o"), F.explode(tuples).alias("t"))
    values = F.transform(F.regexp_extract_all(F.substring("t", F.lit(2), F.length("t") - 2), F.lit(_VALUE), F.lit(0)), _plain)
    rows = rows.select("o", values.alias("v"))
    at = {n: F.array_position("o", n.lower()) for n in names}
    return rows.select(*(F.when(at[n] > 0, F.get("v", (at[n] - 1).cast("int"))).try_cast(t).alias(n) for n, t in declared))
