"""Catalog, batch preparation, graph, evaluation, sources and streams."""

import math
import os

import pytest
from lectern.operators import catalog, etl, evaluate, graph
from lectern.sources import readers, writers
from lectern.streaming import events as ev
from pyspark.sql import functions as F


def test_facets_exclude_their_own_filter(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), (None, "x")], "p string, q string")
    got = {(r["facet"], r["value"]): r["n"] for r in catalog.facets(df, {"p": F.col("p") == "a", "q": F.col("q") == "x"}, {"p": F.col("p"), "q": F.col("q")}).collect()}
    assert got == {("p", "a"): 1, ("p", "b"): 1, ("q", "x"): 1, ("q", "y"): 1}


def test_metrics_by_hand(spark):
    got = spark.createDataFrame([("q", d, r) for r, d in enumerate("abcde", 1)], "qid string, doc_id string, rank int")
    gold = spark.createDataFrame([("q", "b"), ("q", "e"), ("q", "z"), ("none", "a")], "qid string, doc_id string")
    rows = {r["qid"]: r for r in evaluate.query_metrics(got, gold).collect()}
    q = rows["q"]
    assert q["recall_at_1"] == 0 and q["recall_at_5"] == pytest.approx(2 / 3) and q["precision_at_5"] == pytest.approx(0.4)
    assert q["reciprocal_rank"] == 0.5 and q["first_relevant_rank"] == 2 and q["hit"]
    ideal = 1 + 1 / math.log2(3) + 1 / 2
    assert q["ndcg_at_10"] == pytest.approx((1 / math.log2(3) + 1 / math.log2(6)) / ideal)
    assert rows["none"]["recall_at_20"] == 0 and not rows["none"]["hit"]


def test_latency(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(20)], "config string, ms double")
    row = evaluate.latency(df, "config", "ms").first()
    assert row["avg_ms"] == 9.5 and row["p95_ms"] == 19.0


def test_letter_suffix(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 26, 27, 52, 702, 703)], "n long").select(etl.letter_suffix(F.col("n")).alias("s"))
    assert [r["s"] for r in df.collect()] == ["", "a", "z", "aa", "az", "zz", "aaa"]


def test_chunks(spark):
    df = spark.createDataFrame([(1, i, n) for i, n in enumerate([5, 5, 20, 1, 1])], "g int, i int, tokens long")
    assert [r["chunk"] for r in etl.budget_chunks(df, ["g"], "i", "tokens", 10).orderBy("i").collect()] == [0, 0, 1, 2, 2]
    rows = spark.createDataFrame([(1, i) for i in range(7)], "g int, i int")
    chunks = {}
    for r in etl.overlapping_chunks(rows, ["g"], "i", 4, 1).collect():
        chunks.setdefault(r["chunk"], []).append(r["i"])
    assert {k: sorted(v) for k, v in chunks.items()} == {1: [0, 1, 2, 3], 2: [3, 4, 5, 6], 3: [6]}


def test_winners(spark):
    df = spark.createDataFrame([("k", 1, "long text"), ("k", 2, "other txt"), ("k", 3, "s")], "k string, i int, t string")
    assert etl.first_wins(df, ["k"], "i").first()["i"] == 1
    assert etl.latest_wins(df, ["k"], "i").first()["i"] == 3
    assert etl.longest_wins(df, ["k"], "t", "i").first()["i"] == 1


def test_incremental(spark):
    old = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (3, "c")], "k int, v string")
    assert [tuple(r) for r in etl.insert_new(new, old, ["k"]).collect()] == [(3, "c")]
    assert [tuple(r) for r in etl.changed_only(old, new, ["k"], ["v"]).collect()] == [(2, "b")]
    assert sorted(tuple(r) for r in etl.upsert(old, new.distinct(), ["k"]).collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_validation_and_segments(spark):
    df = spark.createDataFrame([(None, "x"), (1, ""), (2, "y")], "id int, title string")
    rules = {"missing id": F.col("id").isNull(), "missing title": F.col("title") == ""}
    assert [r["errors"] for r in etl.validated(df, rules).collect()] == [["missing id"], ["missing title"], []]
    assert {r["reason"]: r["n"] for r in etl.reject_reasons(df, rules).collect()} == {"missing id": 1, "missing title": 1, "ok": 1}
    got = spark.range(1).select(etl.segments_between(F.lit("intro 1 - first 2 - second"), r"(\d+) - ").alias("s")).first()["s"]
    assert [(x["number"], x["body"]) for x in got] == [("1", "first"), ("2", "second")]


def test_ranges(spark):
    refs = spark.createDataFrame([("28:7",), ("28:36-37",), ("x",), ("3:5-4",), ("1:2:3",)], "ref string")
    assert sorted((r["ref"], r["chapter"], r["verse"]) for r in graph.expand_ranges(refs).collect()) == [("28:36-37", 28, 36), ("28:36-37", 28, 37), ("28:7", 28, 7)]


def test_markers(spark):
    verses = spark.createDataFrame([(1, 1, "one"), (1, 2, "two")], "chapter int, verse int, text string")
    texts = spark.createDataFrame([(1, "see {{Q:1:1-2}} and {{Q:9:9}}"), (2, None)], "id int, text string")
    got = {r["id"]: r["text"] for r in graph.substitute_markers(texts, verses, "id").collect()}
    assert got == {1: "see one two and {{Q:9:9}}", 2: None}


def test_sources_and_near_ids(spark):
    raw = spark.createDataFrame([('[{"type":"quran","ref":"1:1"},{"type":"x","ref":"2"},{"type":"book"}]',), ("bad",), (None,)], "s string")
    assert [len(r["p"]) for r in raw.select(graph.parse_sources("s").alias("p")).collect()] == [1, 0, 0]
    ids = spark.createDataFrame([("person:musa",), ("person:mousa",), ("place:musa",), ("person:musa-b",)], "id string")
    assert sorted((r["a"], r["b"]) for r in graph.near_duplicate_ids(ids).collect()) == [("person:mousa", "person:musa"), ("person:musa", "person:musa-b")]


def test_entity_merge_and_search(spark):
    df = spark.createDataFrame([("a", 1, "A", ["x"]), ("a", 2, "B", ["y", "x"])], "id string, ordinal int, name string, sources array<string>")
    row = graph.merge_entities(df).first()
    assert row["name"] == "A" and row["sources"] == ["x", "y"]
    nodes = spark.createDataFrame([("1", "red house", "rot"), ("2", "blue", "haus")], "id string, en string, de string")
    queries = spark.createDataFrame([("q", ["house"])], "qid string, terms array<string>")
    assert [r["id"] for r in graph.search_entities(nodes, ["en", "de"], queries, least=0.0).collect()] == ["1"]


def test_readers(spark, tmp_path):
    (tmp_path / "gold.jsonl").write_text('{"query":"a","relevant":["x","y"],"language":"en"}\n{"query":"b","relevant":[{"id":"z"}]}\n')
    got = {r["query"]: r["relevant"] for r in readers.read_gold_queries(spark, str(tmp_path / "gold.jsonl")).collect()}
    assert got == {"a": ["x", "y"], "b": ["z"]}
    (tmp_path / "t.tsv").write_text("a\tb\n1\t\n")
    assert readers.read_tsv(spark, str(tmp_path / "t.tsv")).first().asDict() == {"a": "1", "b": ""}
    (tmp_path / "d.sql").write_text("CREATE TABLE x;\nINSERT INTO `w` VALUES (1,'it''s (a)',NULL),(2,'b\\'c','d');\n")
    rows = readers.read_sql_dump(spark, str(tmp_path / "d.sql"), "w", ["i", "t", "u"]).collect()
    assert [tuple(r) for r in rows] == [("1", "it's (a)", None), ("2", "b'c", "d")]
    assert readers.query(spark, "SELECT :x + 1 AS y", x=1).first()["y"] == 2


def test_writers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(path)
    writers.append_new(spark.createDataFrame([(1, "z"), (2, "b")], "k int, v string"), path, ["k"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b")]


def test_stream(spark, tmp_path):
    batch = spark.createDataFrame([("2024-01-01 00:00:10", "a"), ("2024-01-01 00:00:50", "a"), ("2024-01-01 00:02:00", "b")], "ts string, kind string")
    batch.withColumn("ts", F.to_timestamp("ts")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, kind string").parquet(str(tmp_path / "in"))
    query = ev.windowed_counts(stream, "ts", ["kind"], "1 minute").writeStream.format("memory").queryName("counts").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    assert sorted((r["kind"], r["n"]) for r in spark.table("counts").collect()) == [("a", 2), ("b", 1)]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the driver's tables")
def test_registered_queries_match_their_sql(spark):
    import duckdb
    from lectern.plans import ORACLE_SQL, QUERIES

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    rows = lambda df: sorted(map(repr, df[sorted(df.columns)].astype(object).itertuples(index=False, name=None)))
    wrong = [name for name, sql in ORACLE_SQL.items() if rows(QUERIES[name](spark, d).toPandas()) != rows(con.execute(sql).df())]
    assert not wrong
