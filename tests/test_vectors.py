"""Exact batches and the stored vector index against brute force, with ties, blanks, strings as ids, and filters."""

from __future__ import annotations


import numpy as np
import pytest
from lectern.operators import vector
from lectern.operators.vector_index import VectorIndex, fitted_cells, nearest_cells, recall
from pyspark.sql import functions as F


def brute(rows, queries, k, least=None):
    out = []
    for qid, q in queries:
        length = np.linalg.norm(q)
        found = []
        for i, v in rows:
            if v is None or not np.any(v) or not length:
                continue
            score = round(round(float(np.dot(v, q) / np.linalg.norm(v) / length), 12), 8)
            if least is None or score >= least:
                found.append((-score, i))
        out += [(qid, i, n, -s) for n, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def clustered(seed, n, width=16, clusters=20):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((clusters, width)) * 2
    return [(i, (centres[i % clusters] + r.standard_normal(width)).tolist()) for i in range(n)]


def got(df):
    return sorted((r["qid"], r[1], r["rank"], round(r["score"], 8)) for r in df.select("qid", df.columns[1], "rank", "score").collect())


@pytest.mark.parametrize("query_bytes", [32 << 20, 500])
def test_batches_equal_brute_force(spark, query_bytes):
    rows = clustered(0, 300)
    rows += [(300 + i, rows[5][1]) for i in range(30)] + [(400, None), (401, [0.0] * 16)]  # ties, no vector, no direction
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    queries = [(i, rows[i][1]) for i in range(0, 40, 5)] + [(99, [0.0] * 16)]
    asked = spark.createDataFrame(queries, "qid long, qvec array<double>")
    assert got(vector.nearest_batch(df, asked, 10, query_bytes=query_bytes)) == brute(rows, queries, 10)
    assert got(vector.nearest_batch(df, asked, 500, least=0.3, query_bytes=query_bytes)) == brute(rows, queries, 500, 0.3)
    assert vector.nearest_batch(df.limit(0), asked, 3).count() == 0 and vector.nearest_batch(df, asked.limit(0), 3).count() == 0


def test_batches_of_strings(spark):
    rows = [(f"v{i:03}", v) for i, v in clustered(1, 120)] + [("w", None)]
    queries = [(f"q{i}", rows[i][1]) for i in (0, 3)]
    df = spark.createDataFrame(rows, "key string, v array<float>")
    asked = spark.createDataFrame(queries, "qid string, qvec array<double>")
    found = vector.nearest_batch(df, asked, 4, vec_id="key", vector="v")
    single = [(i, None if v is None else np.float32(v).astype(float).tolist()) for i, v in rows]
    assert got(found) == brute(single, queries, 4)


def test_one_vector_and_a_batch_agree(spark):
    rows = clustered(2, 200)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    one = [(r["vec_id"], r["rank"]) for r in vector.nearest(df, rows[3][1], 12).orderBy("rank").collect()]
    many = vector.nearest_batch(df, spark.createDataFrame([(3, rows[3][1])], "qid long, qvec array<double>"), 12)
    assert [(r["vec_id"], r["rank"]) for r in many.orderBy("rank").collect()] == one


def test_cells_are_unit_centres_of_their_rows():
    r = np.random.default_rng(3)
    units = r.standard_normal((500, 8))
    units /= np.linalg.norm(units, axis=1)[:, None]
    centres = fitted_cells(units, 20)
    assert np.allclose(np.linalg.norm(centres, axis=1), 1)
    own = nearest_cells(units, centres, 1)[0][:, 0]
    assert len(set(own.tolist())) > 15
    cells, scores = nearest_cells(units, centres, 5)
    assert (np.diff(scores, axis=1) <= 0).all() and (cells[:, 0] == own).all()
    same = np.repeat(units[:1], 50, axis=0)
    assert np.allclose(fitted_cells(same, 4), same[:4])


def test_index_equals_brute_force_when_all_cells_are_read(spark, tmp_path):
    rows = clustered(4, 400) + [(1000, None), (1001, [0.0] * 16)]
    rows += [(2000 + i, rows[8][1]) for i in range(20)]
    df = spark.createDataFrame([(*r, r[0] % 3) for r in rows], "vec_id long, embedding array<double>, label int").repartition(5)
    index = VectorIndex.build(df, str(tmp_path / "index"), keep=["label"])
    queries = [(i, rows[i][1]) for i in range(0, 60, 7)]
    asked = spark.createDataFrame(queries, "qid long, qvec array<double>")
    every = len(index.centres())
    assert every > 5 and index.rows().count() == len(rows)
    assert got(index.nearest(asked, 10, probes=every)) == brute(rows, queries, 10)
    kept = [r for r in rows if r[0] % 3 != 1 and r[0] not in (0, 7)]
    found = index.nearest(asked, 10, probes=every, condition="label <> 1", excluded=[0, 7], least=0.2, query_bytes=400)
    assert got(found) == brute(kept, queries, 10, 0.2)
    more = [(5000 + i, v) for i, v in clustered(5, 50)]
    index.add(spark.createDataFrame([(*r, 0) for r in more], "vec_id long, embedding array<double>, label int"))
    assert got(index.nearest(asked, 10, probes=every)) == brute(rows + more, queries, 10)


@pytest.mark.parametrize("spread", ["clustered", "even"])
def test_default_probes_reach_the_recall(spark, tmp_path, spread):
    r = np.random.default_rng(6)
    rows = clustered(6, 4000, 24, 60) if spread == "clustered" else [(i, v.tolist()) for i, v in enumerate(r.standard_normal((4000, 24)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = VectorIndex.build(df, str(tmp_path / "index"))
    asked = df.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qvec"))
    reached = recall(index.nearest(asked, 10), vector.nearest_batch(df, asked, 10))
    probes, measured = index.settings()
    assert reached >= 0.9 and measured >= 0.95
    if spread == "clustered":
        assert probes <= len(index.centres()) / 5


def test_cells_of_other_queries_are_skipped(spark, tmp_path):
    rows = clustered(7, 300)
    index = VectorIndex.build(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), str(tmp_path / "index"))
    found = index.nearest(spark.createDataFrame([(0, rows[0][1])], "qid long, qvec array<double>"), 5, probes=1)
    assert found.filter("rank = 1").first()["vec_id"] == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "cell" in plan.split("PushedFilters: [")[1].split("]")[0]


def test_index_of_few_or_no_rows(spark, tmp_path):
    schema = "vec_id long, embedding array<double>"
    asked = spark.createDataFrame([(0, [1.0, 2.0])], "qid long, qvec array<double>")
    for i, rows in enumerate(([], [(1, None)], [(1, [1.0, 2.0])])):
        index = VectorIndex.build(spark.createDataFrame(rows, schema), str(tmp_path / f"index{i}"))
        assert index.nearest(asked, 3).count() == len([r for r in rows if r[1]])
