"""External models in map tasks, and streams into tables."""

from __future__ import annotations

import datetime
import json
import os

import pytest
from lectern.operators import models
from lectern.sources import readers
from lectern.streaming.ingest import UpsertTable, searches_with_clicks
from pyspark.sql import functions as F


def counting(folder):
    """A model that notes each request it gets in a file of its own, and turns texts round."""

    def model(texts):
        for t in texts:
            with open(os.path.join(folder, f"{abs(hash(t))}-{os.getpid()}-{os.urandom(4).hex()}"), "w") as f:
                f.write(t)
        return [t[::-1] for t in texts]

    return model


def test_answers_are_asked_once(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    rows = [(i, f"text {i % 30}") for i in range(100)] + [(200, None)]
    df = spark.createDataFrame(rows, "id int, request string")
    ask = lambda d, name="m": {r["id"]: r["answer"] for r in models.answered(d, counting(str(calls)), str(tmp_path / "answers"), name, wait=0.01).collect()}
    assert ask(df) == {i: t and t[::-1] for i, t in rows} and len(list(calls.iterdir())) == 30
    assert ask(df)[5] == "5 txet" and len(list(calls.iterdir())) == 30
    more = df.unionByName(spark.createDataFrame([(300, "new")], "id int, request string"))
    assert ask(more)[300] == "wen" and len(list(calls.iterdir())) == 31
    assert ask(df, "another model")[5] == "5 txet" and len(list(calls.iterdir())) == 61
    assert ask(df.limit(0)) == {}


def test_models_are_tried_again(spark, tmp_path):
    marks = str(tmp_path)

    def shaky(texts):
        mark = os.path.join(marks, "seen-" + str(len(texts)) + texts[0].replace(" ", "_"))
        if any(t == "bad" for t in texts):
            raise ValueError("never")
        if not os.path.exists(mark):
            open(mark, "w").close()
            raise TimeoutError("once")
        return [t.upper() for t in texts]

    df = spark.createDataFrame([(i, f"t {i}") for i in range(20)] + [(99, "bad")], "id int, request string")
    got = {r["id"]: r["answer"] for r in models.answered(df, shaky, str(tmp_path / "answers"), "m", batch=1, wait=0.01).collect()}
    assert got == {i: f"T {i}" for i in range(20)} | {99: None}
    wrong = {r["id"]: r["answer"] for r in models.answered(df, lambda t: [], str(tmp_path / "others"), "m", attempts=2, wait=0.01).collect()}
    assert set(wrong.values()) == {None}


def test_a_thousand_queries_in_one_plan(spark, tmp_path):
    results = spark.range(1000).select(F.col("id").alias("qid"), F.explode(F.sequence(F.lit(1), F.lit(12))).alias("rank")).withColumn("doc", F.concat("qid", F.lit("-"), "rank"))
    queries = spark.range(1000).select(F.col("id").alias("qid"), F.concat(F.lit("query "), "id").alias("query"))

    def model(requests):
        out = []
        for r in map(json.loads, requests):
            n, q = len(r["texts"]), int(r["query"].split()[1])
            out.append(["no list", f"x [3, 1, 3, {n + 5}, 0]", f"{[*range(n, 0, -1)]}", "[]"][q % 4])
        return out

    def ranks(fill):
        found = models.rerank_all(results, queries, model, str(tmp_path / "answers"), "m", "doc", 5, most=10, fill=fill)
        out = {}
        for r in found.orderBy("qid", "rank").collect():
            out.setdefault(r["qid"], []).append(r["old_rank"])
        return out

    got = ranks(True)
    assert len(got) == 1000 and got[0] == got[3] == [1, 2, 3, 4, 5] and got[1] == [3, 1, 2, 4, 5] and got[2] == [10, 9, 8, 7, 6]
    got = ranks(False)
    assert got[0] == [1, 2, 3, 4, 5] and got[1] == [3, 1] and got[2] == [10, 9, 8, 7, 6]


def test_wordings_of_a_model(spark, tmp_path):
    answers = {"a": 'Sure: [{"query": "b", "weight": 0.7}, {"query": "a"}, {"query": " "}, {"query": "c"}, {"query": "d", "weight": 0.1}]', "x": "nothing"}
    df = spark.createDataFrame([(1, "a"), (2, "x")], "qid int, query string")
    found = models.expanded(df, lambda texts: [answers[t] for t in texts], str(tmp_path / "answers"), "m")
    assert sorted((r["qid"], r["wording"], r["text"], r["weight"]) for r in found.collect()) == [(1, 0, "a", 1.0), (1, 1, "b", 0.7), (1, 2, "c", 0.5), (2, 0, "x", 1.0)]


def test_replayed_batches_change_nothing(spark, tmp_path):
    held = UpsertTable(spark, str(tmp_path / "table"), ["k"], "at")
    make = lambda rows: spark.createDataFrame(rows, "k string, at int, v string")
    rows = lambda: sorted(map(tuple, held.rows().collect()))
    assert held.rows() is None
    first, second = make([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), ("b", 1, "zz")]), make([("b", 0, "new"), ("c", None, None)])
    held.write(first, 0)
    assert rows() == [("a", 2, "y"), ("b", 1, "zz")]
    held.write(second, 1)
    want = [("a", 2, "y"), ("b", 0, "new"), ("c", None, None)]
    assert [tuple(r) for r in held.rows().orderBy("k").collect()] == want
    held.write(second, 1)
    held.write(first, 0)
    assert [tuple(r) for r in held.rows().orderBy("k").collect()] == want
    held.merge()
    held.write(first, 0)  # a replay of what the base already holds
    held.write(second, 1)
    assert [tuple(r) for r in held.rows().orderBy("k").collect()] == want
    held.write(make([("a", 9, "later")]), 2)
    held.merge()
    assert [tuple(r) for r in held.rows().orderBy("k").collect()][0] == ("a", 9, "later")


def test_a_stream_is_upserted(spark, tmp_path):
    for b, rows in enumerate(([("a", 1), ("b", 1)], [("a", 2)], [("c", 5), ("b", 3)])):
        spark.createDataFrame(rows, "k string, at int").coalesce(1).write.parquet(str(tmp_path / "in" / str(b)))
    held = UpsertTable(spark, str(tmp_path / "table"), ["k"], "at")
    arriving = spark.readStream.schema("k string, at int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    held.stream(arriving, str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(map(tuple, held.rows().collect())) == [("a", 2), ("b", 3), ("c", 5)] and len(os.listdir(tmp_path / "table" / "batches")) == 3
    held.stream(arriving, str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    assert len(os.listdir(tmp_path / "table" / "batches")) == 3


def test_searches_meet_later_clicks_in_streams(spark, tmp_path):
    at = lambda m: datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=m)
    searches = [[("s1", at(0), "q1"), ("s2", at(1), "q2")], [("s3", at(50), "q3")], [("s4", at(300), "q4")], [("s6", at(310), "q6")], [("s5", at(600), "q5")]]
    clicks = [[("s1", at(5), 1)], [("s1", at(25), 2), ("s2", at(45), 1), ("s3", at(52), 4)], [("s4", at(301), 1)], [("s1", at(6), 3)], [("s9", at(600), 1)]]
    for i, (s, c) in enumerate(zip(searches, clicks, strict=True)):
        spark.createDataFrame(s, "search_id string, ts timestamp, text string").coalesce(1).write.parquet(str(tmp_path / f"s/{i}"))
        spark.createDataFrame(c, "search_id string, ts timestamp, rank int").coalesce(1).write.parquet(str(tmp_path / f"c/{i}"))
    read = lambda name, schema: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name / "*"))
    joined = searches_with_clicks(read("s", "search_id string, ts timestamp, text string"), read("c", "search_id string, ts timestamp, rank int"))
    joined.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    found = {(r["search_id"], r["rank"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert {("s1", 1), ("s1", 2), ("s2", None), ("s3", 4), ("s4", 1)} <= found
    assert ("s2", 1) not in found  # 44 minutes after its search
    assert ("s1", 3) not in found  # hours behind the latest click when it came
    batch = searches_with_clicks(*(spark.read.parquet(str(tmp_path / n / "*")) for n in "sc"))
    assert {(r["search_id"], r["rank"]) for r in batch.collect()} == {("s1", 1), ("s1", 2), ("s1", 3), ("s2", None), ("s3", 4), ("s4", 1), ("s6", None), ("s5", None)}


def test_tables_of_a_relational_store(spark, tmp_path):
    jars = os.path.join(os.path.dirname(__import__("pyspark").__file__), "jars")
    if not any(j.startswith("derby") for j in os.listdir(jars)):
        pytest.skip("no relational store here")
    url = f"jdbc:derby:{tmp_path / 'db'};create=true"
    spark.range(100).select("id", F.concat(F.lit("word"), "id").alias("word")).write.option("driver", "org.apache.derby.iapi.jdbc.AutoloadedDriver").jdbc(url, "nouns")
    whole = readers.read_jdbc(spark, url, "nouns")
    parts = readers.read_jdbc(spark, url, "nouns", "id", (0, 100), 4)
    assert parts.rdd.getNumPartitions() == 4
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect())) and whole.count() == 100
