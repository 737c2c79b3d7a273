"""Operators against plain Python."""

import random

import pytest
from lectern.functions import parsing, text
from lectern.operators import catalog, etl, evaluate, graph, keyword, ranks
from lectern.operators.index import Index
from lectern.operators.query import has_quotes, is_arabic, parse_query, query_parts, query_rules, similarity_floor, skips_semantic, strategy
from lectern.sources import readers
from lectern.streaming import events as ev
from pyspark.sql import functions as F

def test_rows_are_numbered_in_parts(spark):
    r = random.Random(1)
    rows = [(r.choice(["a", "a", "a", "b", None]), r.choice([None, 1.5, *range(50)]), i, "x") for i in range(600)]
    df = spark.createDataFrame([(g, None if v is None else float(v), i, x) for g, v, i, x in rows], "g string, v double, i int, _before string")
    got = {x["i"]: (x["n"], x["t"]) for x in ranks.numbered(df, ["g"], ["v", "i"], "n", "t").collect()}
    for g in ("a", "b", None):
        mine = sorted((x for x in rows if x[0] == g), key=lambda x: (x[1] is not None, x[1] or 0, x[2]))
        assert [got[x[2]] for x in mine] == [(k + 1, len(mine)) for k in range(len(mine))]
    sampled = {x["i"] for x in catalog.every_nth(df, ["i"], ["g"], 10).collect()}
    for g in ("a", "b"):
        mine = [x[2] for x in rows if x[0] == g]
        assert sampled & set(mine) == set(mine[:: -(-len(mine) // 10)])
    assert ranks.numbered(df.filter("i < 0"), ["g"], ["v"], "n").count() == 0


def test_latency_counts_equal_values(spark):
    r = random.Random(2)
    rows = [("a", float(r.randrange(20))) for _ in range(500)] + [("b", 1.0), ("c", 2.0), ("c", 4.0)]
    got = {x["g"]: (x["avg_v"], x["p95_v"]) for x in evaluate.latency(spark.createDataFrame(rows, "g string, v double"), "g", "v").collect()}
    for g in "abc":
        vs = sorted(v for k, v in rows if k == g)
        assert got[g] == (pytest.approx(sum(vs) / len(vs)), vs[int(len(vs) * 0.95)])


@pytest.mark.parametrize("seed", range(4))
def test_chunks_by_budget_equal_a_loop(spark, seed):
    r = random.Random(seed)
    rows = [(r.choice(["a", "b", None]), i, r.choice([None, 0, 1, 3, 8, 12, 40])) for i in range(400)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7 + 50 * seed)
    try:
        got = {x["i"]: x["chunk"] for x in etl.budget_chunks(spark.createDataFrame(rows, "g string, i int, tokens long"), ["g"], "i", "tokens", 20).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for g in ("a", "b", None):
        chunk = total = 0
        for k, (_, i, n) in enumerate(x for x in rows if x[0] == g):
            if k and total + (n or 0) > 20:
                chunk, total = chunk + 1, 0
            total += n or 0
            assert got[i] == chunk


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_near_duplicate_ids_equal_all_pairs(spark):
    r = random.Random(4)
    ids = sorted({f"{r.choice('pq')}:{''.join(r.choice('abc') for _ in range(r.randrange(0, 8)))}" for _ in range(60)})
    expected = set()
    for a in ids:
        for b in ids:
            s, t = a[2:], b[2:]
            if a < b and a[0] == b[0] and (s in t or t in s or levenshtein(s, t) <= 2):
                expected.add((a, b))
    got = {tuple(x) for x in graph.near_duplicate_ids(spark.createDataFrame([(i,) for i in ids], "id string")).collect()}
    assert got == expected


def test_stored_index_equals_the_built_one(spark, tmp_path):
    r = random.Random(5)
    words = "alpha beta gamma delta epsilon zeta the of".split()
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randrange(0, 30))), "en") for i in range(80)]
    built = Index.build(spark.createDataFrame(rows, "id int, t string, lang string"), "id", "t", ["lang"])
    built.write(str(tmp_path / "index"))
    stored = Index.read(spark, str(tmp_path / "index"))
    queries = spark.createDataFrame([("a", ["alpha", "beta", "beta"], ["of the", "alpha alpha"]), ("b", ["absent"], []), ("c", [], ["the of the"])], "qid string, terms array<string>, phrases array<string>")
    rounded = lambda df: sorted((x["qid"], x["doc_id"], round(x["score"], 9)) for x in df.collect())
    assert rounded(keyword.bm25_scores(built, queries)) == rounded(keyword.bm25_scores(stored, queries)) != []
    phrases = rounded(keyword.phrase_scores(built, queries))
    assert phrases == rounded(keyword.phrase_scores(stored, queries))
    held = lambda t, p: f" {p} " in f" {t} "
    assert {(q, d) for q, d, _ in phrases} == {("a", i) for i, t, _ in rows if held(t, "of the") and held(t, "alpha alpha")} | {("c", i) for i, t, _ in rows if held(t, "the of the")}
    near = lambda index: sorted(tuple(x) for x in keyword.fuzzy_terms(index, queries.select("qid", F.array(F.lit("alpah")).alias("terms"))).collect())
    assert near(built) == near(stored)
    assert sorted(map(tuple, built.term_stats().collect())) == sorted(map(tuple, stored.term_stats().collect()))
    with pytest.raises(ValueError, match="stored"):
        stored.where("lang = 'en'")


def test_phrases_may_overlap(spark):
    index = Index.build(spark.createDataFrame([(1, "a a a b"), (2, "a b a")], "id int, t string"), "id", "t")
    counted = keyword.phrase_scores(index, spark.createDataFrame([(0, ["a a"])], "qid int, phrases array<string>")).collect()
    assert [x["doc_id"] for x in counted] == [1]


QUERIES_READ = ['"one two" three', "«كتاب العلم» باب", '"one" two', "a", "", "abc def", "نص", 'x "" y', "word-with-marks!", "   ", '"a\nb"', "sufficiently long query of words"]


def test_queries_as_rows_equal_queries_as_literals(spark):
    df = spark.createDataFrame([(q,) for q in QUERIES_READ], "q string").select("q", query_parts("q").alias("p"), query_rules("q", 0.25).alias("r"))
    for x in df.collect():
        q, parsed = x["q"], parse_query(x["q"])
        assert (x["p"]["phrases"], x["p"]["terms"]) == (parsed.phrases, parsed.terms), q
        assert tuple(x["r"]) == (is_arabic(q), strategy(q), has_quotes(q), skips_semantic(q), pytest.approx(similarity_floor(q, 0.25))), q


def test_small_functions(spark):
    one = lambda c: spark.range(1).select(c.alias("v")).first()["v"]
    assert one(text.text_with_breaks(F.lit("<p>a  <b>b</b></p><br/>c<div></div>\n\n\n\nd"))) == "a b\n\nc\n\nd"
    assert one(parsing.definition_after(F.lit("(كتب) معنى"), "leading_parens")) == " معنى"
    long = "ا" * 3000 + " قَالَ كذا"
    assert one(parsing.split_at(F.lit(long), F.lit("قال كذا"))) == 3001
    segments = F.array(F.struct(F.lit(1).alias("word"), F.lit(700).alias("start"), F.lit(900).alias("end")))
    assert [tuple(x) for x in one(etl.relative_timing(segments, F.lit(500)))] == [(0, 200, 400)]
    assert set(parsing.TECHNIQUES) >= {"baseline", "roots", "light10_stem"}


def test_relational_and_json_sources(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path / 'db'};create=true"
    rows = spark.range(100).select(F.col("id").cast("int").alias("K"), F.concat(F.lit("n"), "id").alias("NAME"))
    rows.write.jdbc(url, "T", properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    got = readers.read_jdbc(spark, url, "T", "K", (0, 100), 4)
    assert got.rdd.getNumPartitions() == 4 and sorted(r["K"] for r in got.collect()) == list(range(100))
    (tmp_path / "json").mkdir()
    (tmp_path / "json" / "a.json").write_text('{"id": 1,\n "names": ["x", "y"]}')
    assert readers.read_json_documents(spark, str(tmp_path / "json"), "id int, names array<string>").first()["names"] == ["x", "y"]


def test_session_counts_and_distinct_events(spark):
    rows = [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:04:00"), (1, "2024-01-01 01:00:00"), (2, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "u int, ts string").withColumn("ts", F.to_timestamp("ts"))
    assert sorted((x["u"], x["n"]) for x in ev.session_counts(df, "ts", ["u"], "5 minutes").collect()) == [(1, 1), (1, 2), (2, 2)]
    assert ev.deduplicated(df, ["u", "ts"], "ts").count() == 4
