"""Searches from query to ranked results, with fake models."""

import pytest
from lectern.operators import search as S
from lectern.operators.index import Index
from lectern.operators.query import SearchParams


@pytest.fixture(scope="module")
def searcher(spark):
    rows = [(1, "red house on the hill"), (2, "blue house"), (3, "green garden with red roses"), (4, "the sea")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 1.0]), (4, [-1.0, 0.0])], "doc_id long, embedding array<double>")
    index = Index.build(docs, "doc_id", "text")
    embed = lambda texts: [[1.0, 0.0] if "house" in t else [0.0, 1.0] for t in texts]
    expand = lambda q: [(q, 1.0), ("garden", 0.5)]
    return S.Searcher({"page": S.Corpus(index, vectors), "note": S.Corpus(index, None, excluded=[1])}, embed, expand)


def params(query, **more):
    return SearchParams(query, similarity_cutoff=0.5, keyword_gate="none", **more)


def test_standard(searcher):
    got = searcher.search(params("red house"))
    page = {r["doc_id"]: r["match_type"] for r in got["page"].collect()}
    assert page == {1: "both", 2: "both", 3: "keyword"}
    assert got["page"].orderBy("rank").first()["doc_id"] == 1
    assert {r["doc_id"] for r in got["note"].collect()} == {2, 3}


def test_gate_and_modes(searcher):
    assert {r["match_type"] for r in searcher.search(SearchParams("red house", similarity_cutoff=0.5))["page"].collect()} == {"semantic"}
    assert {r["match_type"] for r in searcher.search(params("red house", mode="keyword"))["page"].collect()} == {"keyword"}
    assert {r["match_type"] for r in searcher.search(params("red house", mode="semantic"))["page"].collect()} == {"semantic"}
    quoted = searcher.search(params('"red house"'))["page"].collect()
    assert [(r["doc_id"], r["match_type"]) for r in quoted] == [(1, "keyword")]


def test_refined(searcher):
    got = searcher.search(params("red house", refine=True))
    first = {r["type"]: r["doc_key"] for r in got.filter("rank = 1").collect()}
    assert first["page"] in ("1", "3") and set(first) == {"page", "note"}
    ranking = lambda parts: [("note", "3"), ("page", "1"), ("page", "2")]
    ranked = searcher.refined(params("red house", refine=True), ranking)
    assert {(r["type"], r["doc_key"]): round(r["score"], 2) for r in ranked.collect()} == {("note", "3"): 0.99, ("page", "1"): 0.98, ("page", "2"): 0.97}


def test_formatting_and_enrichment(spark, searcher):
    docs = searcher.corpora["page"].index.docs.select("doc_id").withColumn("text", S.F.concat(S.F.lit("t"), "doc_id"))
    found = searcher.search(params("red house"))["page"].join(docs, "doc_id")
    assert [r["text_snippet"] for r in S.formatted(found, "hybrid").collect()] == ["t1", "t2", "t3"]
    translations = spark.createDataFrame([(1, "en", "en-a", "one"), (1, "en", "en-b", "uno"), (2, "fr", "fr-a", "deux")], "doc_id long, language string, edition string, text string")
    got = {r["doc_id"]: r["translation"] for r in S.with_translations(docs, translations, ["doc_id"], language="en").collect()}
    assert got == {1: "uno", 2: None, 3: None, 4: None}
    verses = spark.createDataFrame([(28, 36, 0.5), (28, 7, 0.5)], "chapter int, verse int, score double")
    refs = spark.createDataFrame([("28:36-37",)], "ref string")
    score = lambda **k: {r["verse"]: (r["score"], r["confirmed"]) for r in S.graph_boosted(verses, refs, ["chapter", "verse"], **k).collect()}
    assert score() == {36: (0.5, True), 7: (0.5, False)} and score(apply=True)[36][0] == 0.55 and not score(expand=False)[36][1]
    authors = spark.createDataFrame([(1, "Ann Lee"), (2, "Lee Ann"), (3, "Bo")], "id long, name string")
    books = spark.createDataFrame([(2,), (2,), (1,)], "author_id long")
    assert [r["id"] for r in S.authors_by_name(authors, books, "ann", 5).collect()] == [2, 1]
