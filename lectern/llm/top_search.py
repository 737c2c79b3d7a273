"""Exact top-k search by inner product in three phases, with a uniform threshold over lists of partial scores."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm._store import written

#: Components are taken as floor(SCALE * x). Results of a query, and one in how many identifiers asks.
SCALE, TOP, EVERY = 1024, 10, 100

#: Lists of partial scores that make up a score: equal ranges of components.
LISTS = 2

#: Bytes of queries that are broadcast at a time, and scores that one step of a task holds.
QUERY_BYTES, STEP = 32 << 20, 1 << 20

LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


class Vectors(NamedTuple):
    ids: np.ndarray
    values: np.ndarray  # a row for each; one that is shorter than the longest ends in zeros


def whole_vectors(ids: pa.Array, lists: pa.Array) -> Vectors:
    """Vectors in whole numbers, without those that are null, have no identifier or a component that is null or not
    finite."""
    offsets = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)[offsets[0] : offsets[-1]]
    bad = np.append(0, np.cumsum(~np.isfinite(flat)))[offsets - offsets[0]]
    kept = (lists.is_valid().to_numpy(zero_copy_only=False)) & ids.is_valid().to_numpy(zero_copy_only=False) & (bad[1:] == bad[:-1])
    sizes = np.where(kept, np.diff(offsets), 0)
    filled = np.arange(int(sizes.max(initial=0))) < sizes[:, None]
    out = np.zeros(filled.shape)
    out[filled] = np.floor(flat[np.repeat(kept, np.diff(offsets))] * SCALE)
    return Vectors(ids.fill_null(0).to_numpy().astype(np.int64)[kept], out[kept])


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exact: in doubles where all sums stay below 2**53, else in Python's
    integers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 1 << 53:
        return (a @ b.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return whole(a).dot(whole(b).T)


def partial_scores(queries: np.ndarray, vectors: np.ndarray, lists: int) -> list[np.ndarray]:
    """A matrix (query, candidate) of each list; components that one side lacks count as zero."""
    width = min(queries.shape[1], vectors.shape[1])
    cuts = np.linspace(0, width, lists + 1).astype(int)
    return [inner_products(queries[:, i:j], vectors[:, i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


def _long(score: np.ndarray) -> np.ndarray:
    """Scores as longs; one that no long holds is the nearest that it holds."""
    return score if score.dtype == np.int64 else np.array([min(max(x, LEAST), MOST) for x in score.ravel()], np.int64).reshape(score.shape)


def _steps(batch: pa.RecordBatch, queries: Vectors) -> Iterator[tuple[slice, Vectors]]:
    """Candidates of a batch, against so many queries at a time as STEP scores allow."""
    found = whole_vectors(batch.column(0), batch.column(1))
    size = max(1, STEP // max(1, len(found.ids)))
    for i in range(0, len(queries.ids) if len(found.ids) else 0, size):
        yield slice(i, i + size), found


def local_scores(queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, k: int, lists: int) -> np.ndarray:
    """A row of scores for each query: whole scores of the k entries that lead each list, the k greatest of them; LEAST
    fills up. own: which candidates a query must not find."""
    partial = partial_scores(queries, vectors, lists)
    chosen = np.zeros(own.shape, bool)
    for p in partial:
        ranked = np.where(own, LEAST, _long(p))
        leading = np.argpartition(ranked, -k, axis=1)[:, -k:] if own.shape[1] > k else np.broadcast_to(np.arange(own.shape[1]), own.shape)
        np.put_along_axis(chosen, leading, True, axis=1)
    score = np.where(chosen & ~own, _long(sum(partial)), LEAST)
    return np.partition(score, -k, axis=1)[:, -k:] if score.shape[1] > k else score


def gathered(candidates: DataFrame, queries, k: int, lists: int) -> DataFrame:
    """Phase 1, (query_id, score): each task goes through its lists of partial scores, and sends whole scores of entries
    that lead them: k of each query, the greatest that it has met."""

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: Vectors = queries.value
        best = np.full((len(asked.ids), k), LEAST)
        for batch in batches:
            for some, found in _steps(batch, asked):
                own = asked.ids[some][:, None] == found.ids[None, :]
                both = np.concatenate([best[some], local_scores(asked.values[some], own, found.values, k, lists)], axis=1)
                best[some] = np.partition(both, -k, axis=1)[:, -k:]
        q, place = np.nonzero(best > LEAST)
        yield pa.RecordBatch.from_arrays([pa.array(asked.ids[q]), pa.array(best[q, place])], ["query_id", "score"])

    return candidates.mapInArrow(gather, "query_id long, score long")


def sufficient(candidates: DataFrame, queries, cutoffs, lists: int) -> DataFrame:
    """Phases 2 and 3, (query_id, vec_id, score): the entries of any list whose partial score reaches an equal share of
    the query's cutoff are collected, their whole scores resolved from the other lists, and those sent that reach it.

    A sum of m partial scores reaches the cutoff only if one of them reaches an m-th of it, so that none is lost.
    """

    def collect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: Vectors = queries.value
        for batch in batches:
            for some, found in _steps(batch, asked):
                ids, cutoff = asked.ids[some], cutoffs.value[some]
                partial = partial_scores(asked.values[some], found.values, lists)
                enough = np.broadcast_to((cutoff == LEAST)[:, None], partial[0].shape).copy()
                for p in partial:
                    enough |= np.asarray(p >= (cutoff // lists)[:, None], bool)
                q, c = np.nonzero(enough & (ids[:, None] != found.ids[None, :]))
                score = _long(sum(p[q, c] for p in partial))
                kept = score >= cutoff[q]
                yield pa.RecordBatch.from_arrays([pa.array(ids[q[kept]]), pa.array(found.ids[c[kept]]), pa.array(score[kept])], ["query_id", "vec_id", "score"])

    return candidates.mapInArrow(collect, "query_id long, vec_id long, score long")


def _asking(vectors: DataFrame, every: int) -> DataFrame:
    """The vectors that ask, one of each identifier."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter((F.col("vec_id") % every == 0) & finite).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def _search(vectors: DataFrame, asked: pa.Table, k: int, lists: int) -> DataFrame:
    """Results of some queries, which are broadcast with their cutoffs."""
    context = vectors.sparkSession.sparkContext
    asked = asked.combine_chunks()
    queries = whole_vectors(asked["vec_id"].combine_chunks(), asked["embedding"].combine_chunks())
    sent = context.broadcast(queries)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"))
    known = gathered(vectors, sent, k, lists).withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k)
    safe = known.filter(F.col("nth") == k).select("query_id", "score").toArrow()
    cutoffs = np.full(len(queries.ids), LEAST)
    by_id = np.argsort(queries.ids)
    cutoffs[by_id[np.searchsorted(queries.ids, safe["query_id"].to_numpy(), sorter=by_id)]] = safe["score"].to_numpy()
    found = sufficient(vectors, sent, context.broadcast(cutoffs), lists)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(vectors: DataFrame, k: int = TOP, every: int = EVERY, lists: int = LISTS, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """The k candidates of greatest inner product for each vector (vec_id, embedding) whose vec_id is divisible by
    `every`: rows (query_id, rank, vec_id, score), ties to the smaller vec_id.

    Components are floor(1024 * x); one that the other vector lacks counts as zero. Rows without an identifier or a
    vector, and those with a component that is null or not finite, take no part. Rows of the query's own identifier are
    never found; where several have it, the least vector asks, once. Other rows that repeat are found as often as they
    stand. An empty table gives no row; a score beyond a long is the nearest one that a long holds.

    Queries are broadcast with at most about query_bytes at a time, so that a pass over the candidates serves some
    65,000 of 64 components; candidates are read where they are stored, and never moved. What is shuffled is k scores
    for each query and task, then the entries that reach the query's cutoff, which are few over k.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    asking = written(_asking(rows, every), "queries")
    n, width = asking.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()
    passes = max(1, min(n, -(-n * width * 8 // query_bytes)))
    part = F.pmod(F.xxhash64("vec_id"), F.lit(passes))
    found = [written(_search(rows, asking.filter(part == i).toArrow(), k, lists), "top") for i in range(passes)]
    return reduce(DataFrame.unionByName, found)


SQL = f"""
WITH usable AS (
    SELECT vec_id, embedding FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM usable
), queries AS (
    SELECT vec_id AS query_id, list_transform(min(embedding), lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS q FROM usable WHERE vec_id % {EVERY} = 0 GROUP BY vec_id
), scores AS (
    SELECT query_id, vec_id, CAST(list_inner_product(q, v) AS BIGINT) AS score FROM queries JOIN vectors ON vec_id <> query_id
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {TOP}
"""
