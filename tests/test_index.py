"""The stored index after changes equals one made anew; near terms and highlights equal brute force."""

from __future__ import annotations

import random

import pytest
from lectern.functions import edits, highlights
from lectern.operators import keyword
from lectern.operators.index import Index
from lectern.operators.segments import SegmentedIndex
from lectern.sources.store import fingerprint
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string"
WORDS = "river stone house light water green north winter bread salt market garden letter window silver paper".split()


def texts(seed, ids):
    r = random.Random(seed)
    return [(i, " ".join(r.choice(WORDS) for _ in range(r.randrange(0, 40))) if i % 11 else None, f"l{i % 3}") for i in ids]


def scores(index, spark):
    queries = spark.createDataFrame([("a", ["river", "salt"]), ("b", ["winter", "winter", "zzz"])], "qid string, terms array<string>")
    phrases = spark.createDataFrame([("p", ["green north"])], "qid string, phrases array<string>")
    found = [(r["qid"], r["doc_id"], round(r["score"], 9)) for r in keyword.bm25_scores(index, queries).collect()]
    return sorted(found + [(r["qid"], r["doc_id"], round(r["score"], 9)) for r in keyword.phrase_scores(index, phrases).collect()])


def same(index, rows, spark):
    df = spark.createDataFrame(rows, SCHEMA)
    fresh = Index.build(df, "doc_id", "text", ["lang"])
    assert scores(index, spark) == scores(fresh, spark)
    assert sorted(map(tuple, index.term_stats().collect())) == sorted(map(tuple, fresh.term_stats().collect()))
    assert [round(x, 9) for x in index.corpus_stats().first()] == [round(x, 9) for x in fresh.corpus_stats().first()]
    assert sorted(map(tuple, index.docs.select("doc_id", "lang", "dl").collect())) == sorted(map(tuple, fresh.docs.select("doc_id", "lang", "dl").collect()))


def test_index_follows_changes(spark, tmp_path):
    index = SegmentedIndex(spark, str(tmp_path / "index"), keep=["lang"])
    with pytest.raises(ValueError):
        index.index()
    rows = {r[0]: r for r in texts(1, range(60))}
    make = lambda found: spark.createDataFrame(found, SCHEMA)
    assert index.upsert(make(list(rows.values()))) == 1
    same(index.index(), list(rows.values()), spark)
    new = texts(2, range(50, 90))
    rows |= {r[0]: r for r in new}
    assert index.upsert(make(new)) == 2
    same(index.index(), list(rows.values()), spark)
    assert index.delete(make(texts(0, range(0, 90, 4))).select("doc_id")) == 3
    rows = {i: r for i, r in rows.items() if i % 4}
    same(index.index(), list(rows.values()), spark)
    assert index.delete(make([(12345, "", "")]).select("doc_id")) == 3
    back = texts(3, range(0, 12, 4))
    rows |= {r[0]: r for r in back}
    index.upsert(make(back))
    before = index.index()
    same(before, list(rows.values()), spark)
    version = index.compact()
    same(index.index(), list(rows.values()), spark)
    assert [k for k, *_ in index.manifest()] == ["segment"] and index.version() == version == 5
    same(index.index(4), list(rows.values()), spark)  # readers of an earlier version still have it
    assert index.vacuum() == 6
    same(index.index(), list(rows.values()), spark)
    rows = {r[0]: r for r in [*[x for x in rows.values() if x[0] % 5], *texts(9, range(200, 210))]}
    rows[1] = (1, rows[1][1], "other")  # a kept column alone has changed
    index.sync(make(list(rows.values())))
    same(index.index(), list(rows.values()), spark)
    held = index.version()
    assert index.sync(make(list(rows.values()))) == held
    index.delete(make(list(rows.values())).select("doc_id"))
    assert index.index().docs.count() == 0 and scores(index.index(), spark) == []


def test_a_second_writer_fails(spark, tmp_path):
    index = SegmentedIndex(spark, str(tmp_path / "index"))
    index.upsert(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    with pytest.raises(RuntimeError):
        index._commit(0, [("segment", "x", 1, 2)])
    with pytest.raises(ValueError):
        index.upsert(spark.createDataFrame([(5, "a"), (5, "b")], "doc_id long, text string"))
    assert index.version() == 1 and index.index().docs.count() == 1


def test_large_segments_keep_their_deltas(spark, tmp_path):
    index = SegmentedIndex(spark, str(tmp_path / "index"), keep=["lang"])
    rows = texts(1, range(60))
    index.upsert(spark.createDataFrame(rows, SCHEMA))
    for part in (texts(2, range(60, 66)), texts(3, range(64, 70))):
        index.upsert(spark.createDataFrame(part, SCHEMA))
        rows = [r for r in rows if r[0] not in {x[0] for x in part}] + part
    index.delete(spark.createDataFrame([(3,), (65,)], "doc_id long"))
    rows = [r for r in rows if r[0] not in (3, 65)]
    index.compact(small=10)
    assert sorted(k for k, *_ in index.manifest()) == ["delta", "segment", "segment"]
    same(index.index(), rows, spark)


def test_changed_files_are_noticed(spark, tmp_path):
    from lectern.plans import retrieval

    path = str(tmp_path / "documents.parquet")
    save = lambda rows: spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").parquet(path)
    save([(1, "the and which", "en"), (2, "other words", "en")])
    first = fingerprint(spark, path)
    assert {r["doc_id"] for r in retrieval.bm25_topk(spark, str(tmp_path)).collect()} == {1}
    save([(3, "the words", "en"), (4, "none here", "en")])
    assert fingerprint(spark, path) != first
    assert {r["doc_id"] for r in retrieval.bm25_topk(spark, str(tmp_path)).collect()} == {3}


def alignment(a, b):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_alignment_equals_brute_force(spark):
    r = random.Random(5)
    pairs = [("".join(r.choice("abc") for _ in range(r.randrange(9))), "".join(r.choice("abc") for _ in range(r.randrange(9)))) for _ in range(400)] + [("ca", "abc"), ("", ""), ("teh", "the")]
    found = spark.createDataFrame(pairs, "a string, b string").select("a", "b", edits.alignment(F.col("a"), F.col("b")).alias("n")).collect()
    assert all(x["n"] == alignment(x["a"], x["b"]) for x in found)


@pytest.mark.parametrize("stored", [False, True])
def test_near_terms_equal_brute_force(spark, tmp_path, stored):
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcd") for _ in range(r.randrange(1, 13)))
    vocabulary = sorted({word() for _ in range(900)})
    asked = [word() for _ in range(40)] + [w[:2] + w[3:1:-1] + w[4:] for w in r.sample([v for v in vocabulary if len(v) > 5], 20)] + ["", "a", "ab"]
    index = Index.build(spark.createDataFrame([(i, w) for i, w in enumerate(vocabulary)], "doc_id int, text string"), "doc_id", "text")
    if stored:
        index.write(str(tmp_path / "index"))
        index = Index.read(spark, str(tmp_path / "index"))
    queries = spark.createDataFrame([(i, [w]) for i, w in enumerate(asked)], "qid int, terms array<string>")
    found = {(x["qid"], x["term"], x["edits"]) for x in keyword.fuzzy_terms(index, queries).collect()}
    most = lambda w: 0 if len(w) <= 2 else 1 if len(w) <= 5 else 2
    assert found == {(i, v, n) for i, w in enumerate(asked) for v in vocabulary if (n := alignment(v, w)) <= most(w)}
    plan = keyword.fuzzy_terms(index, queries)._jdf.queryExecution().optimizedPlan().toString()
    assert "variant" in plan


def fragment_brute(text, terms, size):
    found = highlights.hits(text, terms)
    best = None
    for start, _, _ in found:
        low = max(0, start - size // 4)
        inside = [h for h in found if h[0] >= low and h[1] <= low + size]
        key = (len({h[2] for h in inside}), len(inside), -low)
        if best is None or key > best[0]:
            best = (key, low, inside)
    if best is None:
        return None
    out, at = "", best[1]
    for start, end, _ in best[2]:
        out, at = out + text[at:start] + "<mark>" + text[start:end] + "</mark>", end
    return out + text[at : best[1] + size]


def test_highlights_are_of_analysed_tokens(spark):
    terms = ["قال", "رسول", "river"]
    rows = [("قَالَ رَسُولُ الله", "<mark>قَالَ</mark> <mark>رَسُولُ</mark> الله"), ("A RIVER, rivers; River.", "A <mark>RIVER</mark>, rivers; <mark>River</mark>."), ("none", None), (None, None), ("", None), ("قالوا", None)]
    df = spark.createDataFrame([(t,) for t, _ in rows], "t string")
    assert [r[0] for r in df.select(keyword.highlight("t", terms)).collect()] == [x for _, x in rows]
    by_row = spark.createDataFrame([("one two", ["two"]), ("one two", None), ("one two", [])], "t string, w array<string>")
    assert [r[0] for r in by_row.select(keyword.highlight("t", F.col("w"))).collect()] == ["one <mark>two</mark>", None, None]


def test_best_fragments_equal_brute_force():
    r = random.Random(7)
    for _ in range(400):
        text = " ".join(r.choice(["one", "TWO", "three", "filler", "x", "longer-word"]) for _ in range(r.randrange(0, 60)))
        size = r.choice([8, 20, 50, 200])
        assert highlights.fragment(text, {"one", "two", "three"}, size) == fragment_brute(text, {"one", "two", "three"}, size)
