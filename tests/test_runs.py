"""Postings are sorted in runs where documents are read; what only near terms need is written when they ask."""

import random

import pyarrow as pa
import pytest
from lectern.operators import index as module
from lectern.operators import keyword
from lectern.operators.index import Index
from lectern.operators.segments import SegmentedIndex

SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize("size", [1, 7, 1 << 21])
def test_runs_equal_brute_force(monkeypatch, size):
    monkeypatch.setattr(module, "RUN_TERMS", size)
    r = random.Random(4)
    docs = [(f"d{i}", [r.choice(["b", "é", "a", "ا", "ab", "𐍈", "ﷲ"]) for _ in range(r.randrange(0, 6))]) for i in range(40)]
    batches = [pa.record_batch([pa.array([d for d, _ in part]), pa.array([t for _, t in part], pa.list_(pa.string()))], ["doc_id", "terms"]) for part in (docs[:25], docs[25:26], docs[26:])]
    runs = list(module.sorted_runs(iter(batches)))
    found = [tuple(x.values()) for b in runs for x in b.to_pylist()]
    assert sorted(found) == sorted((t, d, len(ts), ts.count(t), [i for i, x in enumerate(ts) if x == t]) for d, ts in docs for t in set(ts))
    for b in runs:
        terms = [t.encode() for t in b.column("term").to_pylist()]
        assert terms == sorted(terms)


def test_writing_an_index_shuffles_no_postings(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"salt {i % 7} stone stone w{i}") for i in range(50)], SCHEMA)
    Index.build(docs, "doc_id", "text").write(str(tmp_path / "index"))
    assert not (tmp_path / "index" / "variants").exists()
    stored = Index.read(spark, str(tmp_path / "index"))
    assert stored.postings().filter("term = 'stone'").select("dl", "tf").distinct().collect() == [(5, 2)]
    asked = spark.createDataFrame([(1, ["stoen"])], "qid int, terms array<string>")
    assert [r["term"] for r in keyword.fuzzy_terms(stored, asked).collect()] == ["stone"]
    assert (tmp_path / "index" / "variants").exists() and sorted(p.name for p in (tmp_path / "index").iterdir()) == ["documents", "postings", "stats", "terms", "variants"]


def test_changes_send_ids_alone(spark, tmp_path):
    """Documents keep no words, and lost terms are counted from postings; compared are digests, not texts."""
    make = lambda rows: spark.createDataFrame(rows, SCHEMA)
    index = SegmentedIndex(spark, str(tmp_path / "index"))
    index.upsert(make([(1, "a b b"), (2, "b c"), (3, None)]))
    index.upsert(make([(2, "c d"), (4, "a")]))
    assert "words" not in index.documents().columns
    index.sync(make([(1, "a b b"), (2, "c e"), (5, "")]))
    assert sorted(map(tuple, index.index().term_stats().collect())) == [("a", 1), ("b", 1), ("c", 1), ("e", 1)]
    held = index.version()
    for rows in ([(1, "a b b"), (None, "x")], [(1, "z"), (1, "a")]):
        with pytest.raises(ValueError):
            index.sync(make(rows))
    assert index.version() == held and sorted(r[0] for r in index.index().docs.select("doc_id").collect()) == [1, 2, 5]
    assert not [p for p in (tmp_path / "index" / "deltas").iterdir() if p.name.startswith("_")]


def test_merged_segments_have_one_run_and_no_variants(spark, tmp_path):
    make = lambda rows: spark.createDataFrame(rows, SCHEMA)
    index = SegmentedIndex(spark, str(tmp_path / "index"))
    index.upsert(make([(i, f"w{i} w{i % 5} salt") for i in range(40)]))
    index.upsert(make([(i, f"v{i} salt") for i in range(30, 60)]))
    index.delete(make([(i, "") for i in range(0, 60, 6)]).select("doc_id"))
    index.compact()
    index.vacuum()
    (segment,) = (tmp_path / "index" / "segments").iterdir()
    assert not (segment / "variants").exists()
    (run,) = (segment / "postings").glob("*.parquet")
    keys = [(r["term"].encode(), r["doc_id"]) for r in spark.read.parquet(str(run)).collect()]
    assert keys == sorted(keys)
    counts = {r["term"]: r["df"] for r in index.index().term_stats().collect()}
    live = {i: f"v{i} salt" if i >= 30 else f"w{i} w{i % 5} salt" for i in range(60) if i % 6}
    assert counts == {t: sum(t in x.split() for x in live.values()) for t in {t for x in live.values() for t in x.split()}}
