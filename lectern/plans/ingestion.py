"""Streams into tables, and external models inside plans."""

from __future__ import annotations

from lectern.operators import models
from lectern.plans.registry import query, table
from lectern.sources.dumps import read_dump
from lectern.sources.store import table_path
from lectern.streaming.ingest import UpsertTable, searches_with_clicks
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@query(
    """SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY (event_id * 4) // (SELECT count(*) FROM events) DESC, ts DESC, value DESC NULLS LAST, event_id DESC) = 1"""
)
def streamed_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user, from a stream of four batches; the last is replayed, and changes nothing."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "value", "event_id", "event_type")
    folder, n = table_path(spark, "stream"), events.count()
    batch = lambda b: events.filter(F.floor(F.col("event_id") * 4 / n) == b)
    for b in range(4):
        batch(b).coalesce(1).write.parquet(f"{folder}/in/{b}")
    held = UpsertTable(spark, f"{folder}/table", ["user_id"], "ts")
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(f"{folder}/in/*")
    held.stream(arriving, f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    held.write(batch(3), 3)
    return held.rows().select("user_id", "event_id", "event_type", "value")


@query(
    """WITH s AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'view'), c AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'click')
SELECT s.event_id AS search_event, coalesce(c.event_id, -1) AS click_event FROM s LEFT JOIN c ON s.user_id = c.user_id AND c.ts >= s.ts AND c.ts <= s.ts + INTERVAL 6 HOURS"""
)
def views_with_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each view with its user's clicks of the six hours after it, or -1, as the streams join them."""
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("search_id"), "ts", "event_id", "event_type")
    views = events.filter("event_type = 'view'").select("search_id", "ts", F.col("event_id").alias("search_event"))
    clicks = events.filter("event_type = 'click'").select("search_id", "ts", F.col("event_id").alias("click_event"))
    return searches_with_clicks(views, clicks, "6 hours").select("search_event", F.coalesce("click_event", F.lit(-1)).alias("click_event"))


def _by_first_words(requests: list[str]) -> list[str]:
    """A model that puts texts in the order of their beginnings, and says no more about a request's last one."""
    import json

    found = []
    for r in requests:
        texts = json.loads(r)["texts"]
        order = sorted(range(len(texts)), key=lambda i: (texts[i].encode(), i))
        found.append(f"Best first: {[i + 1 for i in order if i + 1 < len(texts) or len(texts) == 1]}")
    return found


@query(
    """WITH r AS (SELECT source AS qid, doc_id, substr(text, 1, 40) AS t, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS old_rank FROM documents WHERE source IS NOT NULL QUALIFY old_rank <= 25),
n AS (SELECT *, count(*) OVER (PARTITION BY qid) AS n FROM r),
k AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY CASE WHEN old_rank < n OR n = 1 THEN 0 ELSE 1 END, encode(coalesce(t, '')), old_rank) AS rank FROM n)
SELECT qid, doc_id, CAST(old_rank AS INTEGER) AS old_rank, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= 10"""
)
def reranked_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest documents of each source, reranked by a model that is called in map tasks: one plan for all sources."""
    from pyspark.sql import Window

    order = Window.partitionBy("source").orderBy(F.col("n_chars").desc(), "doc_id")
    docs = table(spark, sf_dir, "documents").filter("source is not null").withColumn("rank", F.row_number().over(order)).filter("rank <= 25")
    results = docs.select(F.col("source").alias("qid"), "doc_id", "rank", F.substring("text", 1, 40).alias("t"))
    queries = results.select("qid").distinct().withColumn("query", F.lit("which is best?"))
    found = models.rerank_all(results, queries, _by_first_words, table_path(spark, "answers"), "by-first-words", "t", 10)
    return found.select("qid", "doc_id", "old_rank", "rank")


@query("SELECT c_custkey, c_name || ';' || chr(10) || ' its customer''s' AS c_name, c_acctbal FROM customer")
def dumped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by way of a SQL dump, whose statements span lines and whose columns the dump declares."""
    path = table_path(spark, "dump")
    created = "CREATE TABLE `customer` (\n  `c_custkey` bigint NOT NULL,\n  `c_name` text,\n  `c_acctbal` decimal(12,2),\n  PRIMARY KEY (`c_custkey`)\n)"
    spark.createDataFrame([(created,)], "value string").write.option("lineSep", ";\n").text(path)
    row = F.concat(F.lit("INSERT INTO `customer` VALUES\n("), "c_custkey", F.lit(", '"), "c_name", F.lit(";\n its customer''s', "), "c_acctbal", F.lit(")"))
    table(spark, sf_dir, "customer").select(row.alias("value")).write.mode("append").option("lineSep", ";\n").text(path)
    return read_dump(spark, path, "customer")
