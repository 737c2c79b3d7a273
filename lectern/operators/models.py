"""External models inside a plan: requests are batches of map tasks, and answers a table that later runs read."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from lectern.sources.store import delete_table, exists, table_path
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What a model is here: texts of requests to texts of answers, as many and in the same order. It runs on executors.
Model = Callable[[list[str]], list[str]]

#: Requests of one call; calls of a batch before it is given up; seconds before the second, doubled for each further one.
BATCH, ATTEMPTS, WAIT = 16, 4, 0.5


def answered(requests: DataFrame, model: Model, path: str, name: str, request: str = "request", batch: int = BATCH, attempts: int = ATTEMPTS, wait: float = WAIT, parts: int | None = None) -> DataFrame:
    """requests with `answer`, null where no attempt had one.

    Answers are kept in a table (key, answer) at path, by a hash of the model's name and the request: what is there is
    not asked again, in this run or a later one, and equal requests are asked once. Those that are new are dealt to
    `parts` tasks, the number of calls that may run at a time; a batch that raises is tried again after a pause. A task
    that Spark repeats may ask again what it had asked, and its answers are stored once.
    """
    spark = requests.sparkSession
    keyed = requests.withColumn("_key", F.sha2(F.concat_ws("\u0000", F.lit(name), F.col(request)), 256))
    new = keyed.filter(F.col(request).isNotNull()).groupBy("_key").agg(F.first(request).alias("request"))
    if exists(spark, path):
        new = new.join(spark.read.parquet(path).select(F.col("key").alias("_key")), "_key", "left_anti")

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for i in range(0, rows.num_rows, batch):
                some = rows.slice(i, batch)
                texts, answers = some.column(1).to_pylist(), None
                for attempt in range(attempts):
                    try:
                        answers = model(texts)
                        if len(answers) != len(texts):
                            raise ValueError(f"{len(texts)} requests, {len(answers)} answers")
                        break
                    except Exception:
                        answers = None
                        if attempt + 1 < attempts:
                            time.sleep(wait * 2**attempt)
                if answers is not None:
                    yield pa.RecordBatch.from_arrays([some.column(0), pa.array(answers, pa.string())], ["key", "answer"])

    dealt = new.select("_key", "request").repartition(parts or spark.sparkContext.defaultParallelism, "_key")
    aside = table_path(spark, "answers")
    dealt.mapInArrow(ask, "key string, answer string").write.parquet(aside)
    spark.read.parquet(aside).write.mode("append").parquet(path)
    delete_table(spark, aside)
    told = spark.read.parquet(path).groupBy(F.col("key").alias("_key")).agg(F.min("answer").alias("answer"))
    return keyed.join(told, "_key", "left").drop("_key")


def ranking_request(query: Column, texts: Column) -> Column:
    """A request as JSON: the query, and the texts in order."""
    return F.to_json(F.struct(query.alias("query"), texts.alias("texts")))


def parsed_ranking(answer: Column, n: Column) -> Column:
    """Positions of an answer such as [3, 1, 2], from 1 to n, each once, in order; empty without a list of numbers."""
    found = F.regexp_extract(F.coalesce(answer, F.lit("")), r"\[[\d,\s]*\]", 0)
    numbers = F.coalesce(F.from_json(found, "array<int>"), F.array().cast("array<int>"))
    return F.array_distinct(F.filter(numbers, lambda i: (i >= 1) & (i <= n)))


def rerank_all(results: DataFrame, queries: DataFrame, model: Model, path: str, name: str, text: Column | str, top_n: int, most: int = 100, fill: bool = True, **options) -> DataFrame:
    """results (qid, rank, ...) of all queries (qid, query) in the order of a model's rankings: one plan, in which no
    result reaches the driver.

    The first `most` rows of each query are one request; rows that its answer leaves out follow in their old order, or
    go if fill is false. Without an answer a query keeps its order. old_rank is the rank before; top_n rows stay.
    """
    head = results.filter(F.col("rank") <= most)
    shown = F.col(text) if isinstance(text, str) else text
    texts = head.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("rank", F.coalesce(shown, F.lit("")).alias("t")))).alias("_l"))
    asked = texts.join(queries.select("qid", "query"), "qid").select("qid", ranking_request(F.col("query"), F.col("_l.t")).alias("request"), F.col("_l.rank").alias("ranks"))
    told = answered(asked, model, path, name, **options)
    order = told.select("qid", F.posexplode(parsed_ranking(F.col("answer"), F.size("ranks"))).alias("_new", "_place"), "ranks")
    order = order.select("qid", "_new", F.element_at("ranks", F.col("_place")).alias("rank"))
    silent = told.select("qid", (F.size(parsed_ranking(F.col("answer"), F.size("ranks"))) == 0).alias("_silent"))
    joined = head.join(order, ["qid", "rank"], "left").join(silent, "qid", "left")
    if not fill:
        joined = joined.filter(F.col("_new").isNotNull() | F.coalesce("_silent", F.lit(True)))
    w = Window.partitionBy("qid").orderBy(F.col("_new").asc_nulls_last(), "old_rank")
    out = joined.withColumnRenamed("rank", "old_rank").withColumn("rank", F.row_number().over(w))
    return out.filter(F.col("rank") <= top_n).drop("_new", "_silent")


def expanded(queries: DataFrame, model: Model, path: str, name: str, most: int = 3, **options) -> DataFrame:
    """(qid, wording, text, weight) of queries (qid, query): the query itself with weight 1, then what the model's
    answer, a JSON list of (query, weight), adds, `most` wordings in all. Without a usable answer the query stands alone."""
    told = answered(queries.select("qid", "query"), model, path, name, request="query", **options)
    found = F.from_json(F.regexp_extract(F.coalesce("answer", F.lit("")), r"(?s)\[.*\]", 0), "array<struct<query:string,weight:double>>")
    others = F.filter(F.coalesce(found, F.array().cast("array<struct<query:string,weight:double>>")), lambda x: x["query"].isNotNull() & (F.trim(x["query"]) != "") & (x["query"] != F.col("query")))
    own = F.array(F.struct(F.col("query").alias("query"), F.lit(1.0).alias("weight")))
    listed = F.slice(F.concat(own, F.transform(others, lambda x: F.struct(x["query"].alias("query"), F.coalesce(x["weight"], F.lit(0.5)).alias("weight")))), 1, most)
    return told.select("qid", F.posexplode(listed).alias("wording", "w")).select("qid", "wording", F.col("w.query").alias("text"), F.col("w.weight").alias("weight"))
