"""What surrounds an external reranker: parsing its answer, applying a ranking, merging types."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Reranker(Protocol):
    """An external model: for a query and texts in order, the texts' positions (from 1), best first."""

    def __call__(self, query: str, texts: list[str]) -> list[int]: ...


def ranked(df: DataFrame, order: list[Column | str], per: list[str] | None = None, rank: str = "rank") -> DataFrame:
    """df with ranks from 1 within each group, or overall of a result that a limit has made small."""
    w = Window.partitionBy(*(per or [F.lit(0)])).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w))


def parse_ranking(answer: str, n: int) -> list[int]:
    """Positions of a model's answer such as [3, 1, 2]: those from 1 to n, each once, in order."""
    found = re.search(r"\[[\d,\s]*\]", answer or "")
    try:
        numbers = json.loads(found[0]) if found else []
    except json.JSONDecodeError:
        numbers = []
    return list(dict.fromkeys(i for i in numbers if 1 <= i <= n))


def apply_ranking(df: DataFrame, ranking: list[int], top_n: int, fill: bool = True) -> DataFrame:
    """Rows (rank, ...) in the order of a ranking of their ranks; fill: rows that it leaves out follow in old order."""
    order = df.sparkSession.createDataFrame([(old, new) for new, old in enumerate(ranking, 1)], "rank int, _new int")
    joined = df.join(F.broadcast(order), "rank", "left" if fill else "inner")
    return ranked(joined.withColumnRenamed("rank", "old_rank"), [F.col("_new").asc_nulls_last(), "old_rank"]).drop("_new").filter(F.col("rank") <= top_n)


def rerank(df: DataFrame, query: str, text: Callable[[DataFrame], Column], model: Reranker, top_n: int, most: int = 100) -> DataFrame:
    """Send the first `most` rows' texts to a model and apply its ranking. Those rows reach the driver, and no others."""
    head = df.filter(F.col("rank") <= most)
    texts = [r["t"] for r in head.orderBy("rank").select(text(head).alias("t")).collect()]
    return apply_ranking(head, [i for i in model(query, texts) if 1 <= i <= len(texts)], top_n)


def unified(parts: dict[str, DataFrame], ranking: list[tuple[str, str]] | None, limits: dict[str, int], keys: str = "doc_key") -> DataFrame:
    """One list of several types' results (doc_key, score): type, rank, score.

    ranking lists (type, doc_key), best first; what it leaves out is dropped, and scores become 1 - rank / 100. With no
    ranking, or under three rows in it, results stay as they are. Each type keeps at most its limit.
    """
    out = None
    for name, df in parts.items():
        each = df.select(F.lit(name).alias("type"), F.col(keys).cast("string").alias("doc_key"), F.col("score").cast("double").alias("score"))
        out = each if out is None else out.unionByName(each)
    if ranking and len(ranking) >= 3:
        told = out.sparkSession.createDataFrame([(t, k, i) for i, (t, k) in enumerate(ranking, 1)], "type string, doc_key string, place int")
        out = out.join(F.broadcast(told), ["type", "doc_key"]).withColumn("score", 1 - F.col("place") / 100).drop("place")
    out = ranked(out, [F.col("score").desc(), "doc_key"], ["type"])
    for name, most in limits.items():
        out = out.filter((F.col("type") != name) | (F.col("rank") <= most))
    return out


def top_breakdown(parts: dict[str, DataFrame], k: int = 5) -> DataFrame:
    """The k best rows over all types: type, doc_key, score, rank."""
    out = unified(parts, None, {}).select("type", "doc_key", "score")
    return ranked(out.orderBy(F.col("score").desc(), "type", "doc_key").limit(k), [F.col("score").desc(), "type", "doc_key"])


def boost(results: DataFrame, confirmed: DataFrame, keys: list[str], by: float = 0.05) -> DataFrame:
    """Scores of rows that the graph confirms, raised, to 1 at most."""
    flag = confirmed.select(*keys).distinct().withColumn("_hit", F.lit(True))
    score = F.when(F.col("_hit"), F.least(F.lit(1.0), F.col("score") + by)).otherwise(F.col("score"))
    return results.join(flag, keys, "left").withColumn("score", score).withColumn("confirmed", F.col("_hit").isNotNull()).drop("_hit")
