"""Fusion, queries, keyword and vector search: arithmetic by hand, and properties."""

import math

import pytest
from hypothesis import given
from hypothesis import strategies as st
from lectern.operators import fusion, keyword, rerank, vector
from lectern.operators import index as index_module
from lectern.operators.index import Index, analyze
from lectern.operators.query import SearchParams, is_arabic, parse_query, parse_range_list, similarity_floor, skips_semantic, strategy
from pyspark.sql import functions as F


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.mark.parametrize(
    ("ranks", "expected"),
    [([None, None], 0), ([1, None], 1 / 61), ([0, None], 1 / 60), ([1, 5], 1 / 61 + 1 / 65), ([None, 3], 1 / 63)],
)
def test_rrf(spark, ranks, expected):
    got = one(spark, fusion.rrf(*(F.lit(r).cast("int") for r in ranks)))[0]
    assert got == pytest.approx(expected)


@pytest.mark.parametrize(("score", "k", "expected"), [(0, 5, 0), (-5, 5, 0), (5, 5, 0.5), (10, 5, 2 / 3), (10, 10, 0.5)])
def test_bm25_normalised(spark, score, k, expected):
    assert one(spark, fusion.normalize_bm25(F.lit(float(score)), k))[0] == pytest.approx(expected)


def test_bm25_normalised_rises_below_one(spark):
    rows = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 5, 10, 20, 50, 100)], "s double").select(fusion.normalize_bm25(F.col("s")).alias("n")).collect()
    values = [r["n"] for r in rows]
    assert values == sorted(values) and values[-1] < 1


def sides(spark):
    semantic = spark.createDataFrame([("a", 1, 0.8), ("b", 2, 0.7)], "id string, semantic_rank int, semantic_score double")
    words = spark.createDataFrame([("a", 1, 10.0), ("c", 2, 3.0)], "id string, keyword_rank int, bm25_score double")
    return semantic, words


def test_merge(spark):
    rows = {r["id"]: r for r in fusion.merge(*sides(spark), ["id"]).collect()}
    assert rows["a"]["fused_score"] == pytest.approx(0.4 * 0.8 + 0.7 * 10 / 13)
    assert rows["b"]["fused_score"] == pytest.approx(0.7)
    assert rows["c"]["fused_score"] == pytest.approx(0.5)
    assert [rows[i]["match_type"] for i in "abc"] == ["both", "semantic", "keyword"]
    assert rows["a"]["rrf_score"] == pytest.approx(2 / 61)


def test_merge_does_not_depend_on_input_order(spark):
    semantic, words = sides(spark)
    a = fusion.ordered(fusion.merge(semantic, words, ["id"]), ["id"]).collect()
    b = fusion.ordered(fusion.merge(semantic.orderBy(F.desc("id")), words.orderBy(F.desc("id")), ["id"]), ["id"]).collect()
    assert a == b


def test_keyword_snippet_wins_on_merge(spark):
    semantic, words = sides(spark)
    out = fusion.merge(semantic.withColumn("highlighted_snippet", F.lit("s")), words.withColumn("highlighted_snippet", F.lit("k")), ["id"])
    assert {r["id"]: r["highlighted_snippet"] for r in out.collect()} == {"a": "k", "b": "s", "c": "k"}


def test_weighted_queries(spark):
    rows = [("x", 0, 1.0, 1, 0.5, "t", "t"), ("x", 1, 0.5, 2, 0.9, "t", "<mark>t</mark>"), ("y", 1, 0.5, 1, 0.1, "u", "u")]
    df = spark.createDataFrame(rows, "id string, qid int, weight double, rank int, semantic_score double, text_snippet string, highlighted_snippet string")
    out = {r["id"]: r for r in fusion.merge_queries(df, ["id"]).collect()}
    assert out["x"]["weighted_rrf"] == pytest.approx(1 / 61 + 0.5 / 62)
    assert out["x"]["semantic_score"] == 0.9 and out["x"]["highlighted_snippet"] == "<mark>t</mark>"
    assert out["y"]["weighted_rrf"] == pytest.approx(0.5 / 61) and out["y"]["highlighted_snippet"] == "u"


def test_modes(spark):
    semantic, words = sides(spark)
    ids = lambda mode: {r["id"] for r in fusion.by_mode(mode, semantic, words, ["id"], 10).collect()}
    assert ids("semantic") == {"a", "b"} and ids("keyword") == {"a", "c"} and ids("hybrid") == {"a", "b", "c"}


def test_parse_query():
    parsed = parse_query('الصلاة "صلاة الفجر" word! «واحد»')
    assert parsed.phrases == ["صلاه الفجر"]
    assert parsed.terms == ["الصلاه", "word", "واحد"]
    assert parse_query("hello! world?").terms == ["hello", "world"]
    assert parse_query("").terms == [] and parse_query("  ").phrases == []
    assert parse_query("“two words”").phrases == ["two words"]


def test_query_rules():
    assert is_arabic("abc صلاة") and not is_arabic("abc")
    assert strategy("prayer") == "semantic_only" and strategy("صلاة") == "hybrid"
    assert skips_semantic('"exact words"') and skips_semantic("abc") and not skips_semantic("abcd")
    assert similarity_floor("abc", 0.2) == 0.55
    assert similarity_floor("abcdefghijkl mn", 0.2) == 0.2
    assert similarity_floor("ab", 0.6) == 0.6
    assert similarity_floor("abcdefghijklmnop", 0.2) == 0.40
    assert parse_range_list("1, 16,x,3", 1, 15) == [1, 3]


def test_params():
    assert not SearchParams("q").refines and SearchParams("q", refine=True).refines
    with pytest.raises(ValueError):
        SearchParams("q", mode="other")


def test_many_terms_are_joined(spark, monkeypatch, tmp_path):
    Index.build(docs(spark), "doc_id", "text").write(str(tmp_path / "index"))
    asked = queries(spark, q="cat dog the", r="mat")
    few = sorted(map(tuple, keyword.bm25_scores(Index.read(spark, str(tmp_path / "index")), asked).collect()))
    monkeypatch.setattr(index_module, "MAX_NAMED_TERMS", 1)
    many = sorted(map(tuple, keyword.bm25_scores(Index.read(spark, str(tmp_path / "index")), asked).collect()))
    assert [x[:2] for x in many] == [x[:2] for x in few] and [x[2] for x in many] == pytest.approx([x[2] for x in few])


def docs(spark):
    rows = [(1, "the cat sat on the mat"), (2, "the dog"), (3, "cat and dog and cat"), (4, None), (5, "")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def queries(spark, **texts):
    return spark.createDataFrame([(q, t.split()) for q, t in texts.items()], "qid string, terms array<string>")


def test_bm25_by_hand(spark):
    index = Index.build(docs(spark), "doc_id", "text")
    got = {r["doc_id"]: r["score"] for r in keyword.bm25_scores(index, queries(spark, q="cat")).collect()}
    idf, avgdl = math.log(1 + (5 - 2 + 0.5) / 2.5), (6 + 2 + 5) / 5
    score = lambda tf, dl: idf * tf / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))
    assert got == {1: pytest.approx(score(1, 6)), 3: pytest.approx(score(2, 5))}


def test_batch_equals_single(spark):
    index = Index.build(docs(spark), "doc_id", "text")
    both = keyword.bm25_scores(index, queries(spark, a="cat dog", b="mat")).filter("qid = 'a'").drop("qid")
    assert sorted(both.collect()) == sorted(keyword.bm25_scores(index, queries(spark, a="cat dog")).drop("qid").collect())


def test_phrase(spark):
    index = Index.build(docs(spark), "doc_id", "text")
    assert {r["doc_id"] for r in keyword.phrase_search(index, ["the cat"]).collect()} == {1}
    assert keyword.phrase_search(index, ["cat the"]).count() == 0


def test_fuzzy_only_where_exact_missed(spark):
    index = Index.build(docs(spark), "doc_id", "text")
    out = keyword.with_fuzzy_fallback(index, queries(spark, hit="cat", near="cag")).collect()
    assert {(r["qid"], r["doc_id"], r["fuzzy"]) for r in out} == {("hit", 1, False), ("hit", 3, False), ("near", 1, True), ("near", 3, True)}


def test_analyze_drops_stop_words_after_folding(spark):
    terms = one(spark, analyze(F.lit("قَالَ مُحَمَّدٌ في المدرسة"), ["في", "قال"]))[0]
    assert terms == ["محمد", "المدرسه"]


def test_highlight(spark):
    assert one(spark, keyword.highlight(F.lit("a big cat sat"), ["cat"]))[0] == "a big <mark>cat</mark> sat"
    assert one(spark, keyword.highlight(F.lit("a big dog"), ["cat"]))[0] is None


def test_id_search(spark):
    df = spark.createDataFrame([("12",), ("123",), ("3",)], "id string")
    assert {r["doc_id"]: r["score"] for r in keyword.id_search(df, "id", "12").collect()} == {"12": 110, "123": 10}


def test_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0]), (4, [0.0, 0.0])], "vec_id long, embedding array<float>")
    got = vector.nearest(df, [1.0, 0.0], 2).collect()
    assert [(r["vec_id"], r["rank"]) for r in got] == [(1, 1), (3, 2)]
    assert got[1]["score"] == pytest.approx(math.sqrt(0.5))
    assert [r["vec_id"] for r in vector.nearest(df, [1.0, 0.0], 5, least=0.5, excluded=[1]).collect()] == [3]


def test_rerank():
    assert rerank.parse_ranking("order: [3, 1, 3, 9]", 3) == [3, 1]
    assert rerank.parse_ranking("none", 3) == []


def test_apply_ranking(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "rank int, id string")
    assert [r["id"] for r in rerank.apply_ranking(df, [3, 1], 3).orderBy("rank").collect()] == ["c", "a", "b"]
    assert [r["id"] for r in rerank.apply_ranking(df, [3, 1], 3, fill=False).orderBy("rank").collect()] == ["c", "a"]
    assert [r["id"] for r in rerank.rerank(df, "q", lambda d: F.col("id"), lambda q, t: [2], 2).orderBy("rank").collect()] == ["b", "a"]


def test_unified_drops_what_the_model_leaves_out(spark):
    parts = {"x": spark.createDataFrame([("a", 0.9), ("b", 0.8)], "doc_key string, score double"), "y": spark.createDataFrame([("c", 0.7)], "doc_key string, score double")}
    out = rerank.unified(parts, [("y", "c"), ("x", "b"), ("x", "z")], {"x": 5})
    assert {(r["type"], r["doc_key"]): r["score"] for r in out.collect()} == {("y", "c"): 0.99, ("x", "b"): 0.98}
    assert rerank.unified(parts, None, {"x": 1}).count() == 2
    assert [r["doc_key"] for r in rerank.top_breakdown(parts, 2).orderBy("rank").collect()] == ["a", "b"]


def test_boost(spark):
    results = spark.createDataFrame([("a", 0.5), ("b", 0.99)], "id string, score double")
    confirmed = spark.createDataFrame([("b",)], "id string")
    assert {r["id"]: r["score"] for r in rerank.boost(results, confirmed, ["id"]).collect()} == {"a": 0.5, "b": 1.0}


@given(st.text(max_size=60))
def test_parse_query_never_fails(text):
    parsed = parse_query(text)
    assert all(" " in p for p in parsed.phrases) and all(t and " " not in t for t in parsed.terms)
