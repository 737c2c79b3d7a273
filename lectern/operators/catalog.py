"""Catalog queries: filters, facets, histograms, nested children, pages of results."""

from __future__ import annotations

from functools import reduce

from lectern.operators.ranks import numbered
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def all_of(*conditions: Column | None) -> Column:
    """AND of the conditions that are given; true without any."""
    return reduce(lambda a, b: a & b, [c for c in conditions if c is not None], F.lit(True))


def keys_in(df: DataFrame, keys: DataFrame, on: list[str], exclude: bool = False) -> DataFrame:
    """Rows whose key, of any number of columns, is (not) among keys."""
    return df.join(keys.select(*on).distinct(), on, "left_anti" if exclude else "left_semi")


def facets(df: DataFrame, filters: dict[str, Column], counted: dict[str, Column]) -> DataFrame:
    """(facet, value, n): counts of each facet's values among rows that pass all filters but the facet's own.

    One pass: each row gives its facets' values where the other filters hold, and counts combine in each task.
    """
    parts = []
    for name, value in counted.items():
        others = all_of(*(c for f, c in filters.items() if f != name))
        parts.append(F.when(F.coalesce(others, F.lit(False)), F.struct(F.lit(name).alias("facet"), value.cast("string").alias("value"))))
    each = df.select(F.explode(F.array_compact(F.array(*parts))).alias("f")).select("f.*")
    return each.filter("value is not null").groupBy("facet", "value").agg(F.count("*").alias("n"))


def feature_counts(df: DataFrame, filters: dict[str, Column], features: dict[str, Column]) -> DataFrame:
    """One row: for each feature, rows that have it and pass all filters but its own."""
    return df.agg(*(F.count_if(all_of(*(c for f, c in filters.items() if f != name)) & has).alias(name) for name, has in features.items()))


def histogram(df: DataFrame, bucket: Column, domain: DataFrame, name: str = "bucket") -> DataFrame:
    """(bucket, n) for every bucket of a domain, zero where there are no rows."""
    found = df.groupBy(bucket.alias(name)).agg(F.count("*").alias("n"))
    return domain.select(name).join(found, name, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def with_child_counts(parents: DataFrame, children: DataFrame, key: str, child_key: str, name: str = "n_children") -> DataFrame:
    counts = children.groupBy(F.col(child_key).alias(key)).agg(F.count("*").alias(name))
    return parents.join(counts, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def with_children(parents: DataFrame, children: DataFrame, key: str, child_key: str, order: list[str], fields: list[str], name: str = "children") -> DataFrame:
    """parents with an array of their children's fields, in order."""
    item = F.struct(*order, *[f for f in fields if f not in order])
    gathered = children.groupBy(F.col(child_key).alias(key)).agg(F.array_sort(F.collect_list(item)).alias(name))
    gathered = gathered.withColumn(name, F.transform(name, lambda x: F.struct(*(x[f].alias(f) for f in fields))))
    return parents.join(gathered, key, "left")


def map_of(df: DataFrame, per: str, key: str, value: Column, name: str = "map") -> DataFrame:
    """(per, map) with keys in ascending order; value is an aggregate of each key's rows."""
    inner = df.groupBy(per, key).agg(value.alias("_v"))
    return inner.groupBy(per).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "_v")))).alias(name))


def complete_values(df: DataFrame, per: str, value: str, item: str, total: DataFrame) -> DataFrame:
    """(per, values): values that cover all of per's items: those of which count(distinct item) equals total.n."""
    counts = df.groupBy(per, value).agg(F.countDistinct(item).alias("_c"))
    whole = counts.join(total, per).filter(F.col("_c") == F.col("n"))
    return whole.groupBy(per).agg(F.array_sort(F.collect_list(value)).alias("values"))


def page(df: DataFrame, order: list[Column | str], limit: int, offset: int = 0) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


def page_with_total(df: DataFrame, order: list[Column | str], limit: int, offset: int = 0) -> DataFrame:
    """A page of rows, each with the total number of rows; none where the offset lies beyond the last."""
    return page(df, order, limit, offset).join(F.broadcast(df.agg(F.count("*").alias("total"))))  # the total is one row


def numeric_order(id_column: str) -> list[Column]:
    """Order of string ids by their number; others after all numbers, by text."""
    return [F.col(id_column).try_cast("long").asc_nulls_last(), F.col(id_column).asc()]


def first_per_group(df: DataFrame, per: list[str], order: list[Column | str], n: int = 1) -> DataFrame:
    """The first n rows of each group in an explicit order; Spark cuts each task's rows to n before the shuffle."""
    w = Window.partitionBy(*per).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(w)).filter(F.col("_row") <= n).drop("_row")


def every_nth(df: DataFrame, order: list[str], per: list[str], samples: int = 50) -> DataFrame:
    """Of each group every ceil(n / samples)-th row, the first included; groups are numbered in parts."""
    rows = numbered(df, per, order, "_number", "_rows")
    return rows.filter((F.col("_number") - 1) % F.ceil(F.col("_rows") / samples) == 0).drop("_number", "_rows")


def last_wins(left: DataFrame, right: DataFrame, on: list[str], ordinal: str, columns: list[str]) -> DataFrame:
    """left with columns of the matching right row; of several with one key the highest ordinal counts."""
    latest = right.groupBy(*on).agg(*(F.max_by(c, ordinal).alias(c) for c in columns))
    return left.join(latest, on, "left")


def counts(**tables: DataFrame) -> DataFrame:
    """(name, n) of several tables, counted in one job."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: rows, and non-null values of each column."""
    return df.agg(F.count("*").alias("rows"), *(F.count(c).alias(c) for c in columns))


def indexed_everywhere(stored: DataFrame, indexed: DataFrame, embedded: DataFrame, key: str, always: list | None = None) -> DataFrame:
    """Keys whose counts (n) in the index and among vectors reach the stored count, and some fixed ones."""
    joined = stored.select(key, "n").join(indexed.select(key, F.col("n").alias("i")), key).join(embedded.select(key, F.col("n").alias("e")), key)
    found = joined.filter("i >= n and e >= n").select(key)
    if always:
        found = found.unionByName(stored.sparkSession.createDataFrame([(k,) for k in always], found.schema))
    return found.distinct()
