"""Exact vector search: cosine similarity of arrays, filters, thresholds, best k."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from lectern.operators.keyword import top_k
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in doubles; null for a vector of zeros."""
    length = norm(a) * norm(b)
    return F.when(length > 0, dot(a, b) / length)


def nearest(vectors: DataFrame, query: list[float], k: int, vec_id: str = "vec_id", vector: str = "embedding", least: float | None = None, condition: Column | str | None = None, excluded: list | None = None) -> DataFrame:
    """(vec_id, score, rank): the k best rows for one vector; ranks follow exclusions and the threshold.

    A scan with a bounded heap in each task: nothing but k rows of each is shuffled.
    """
    rows = vectors if condition is None else vectors.filter(condition)
    if excluded:
        rows = rows.filter(~F.col(vec_id).isin(excluded))
    scored = rows.select(vec_id, cosine(F.col(vector), F.array(*(F.lit(float(x)) for x in query))).alias("score"))
    if least is not None:
        scored = scored.filter(F.col("score") >= least)
    best = scored.orderBy(F.col("score").desc_nulls_last(), F.col(vec_id)).limit(k)
    return top_k(best.withColumn("_all", F.lit(0)), k, per="_all", key=vec_id).drop("_all")


#: Bytes of query vectors that are broadcast at a time; scores that one step of a task holds; digits of a score that count:
#: products of matrices give equal vectors scores that may differ in the last ones.
QUERY_BYTES, STEP, DIGITS = 32 << 20, 1 << 20, 12


class Asked(NamedTuple):
    """Queries of one pass: their ids, unit vectors, and the cells that each of them reads, if an index has cells."""

    qid: pa.Array
    units: np.ndarray
    cells: list[np.ndarray] | None = None


def unit_rows(lists: pa.Array) -> np.ndarray:
    """Vectors of length 1, a row each: of equal widths, filled up with zeros; those without a length are not numbers."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    offsets = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    filled = np.arange(int(sizes.max(initial=0))) < sizes[:, None]
    out = np.zeros(filled.shape)
    out[filled] = flat
    length = np.sqrt((out * out).sum(axis=1))
    length[(length == 0) | ~lists.is_valid().to_numpy(zero_copy_only=False)] = np.nan
    return out / length[:, None]


def _sortable(ids: pa.Array) -> np.ndarray:
    """Identifiers as numbers or as strings."""
    return ids.to_numpy(zero_copy_only=False) if pa.types.is_integer(ids.type) else np.array(ids.cast(pa.string()).to_pylist(), dtype=str)


def _best_columns(scores: np.ndarray, k: int) -> np.ndarray:
    """Which k scores of each row are greatest; of equal ones the first."""
    if scores.shape[1] <= k:
        return np.ones(scores.shape, bool)
    least = np.partition(scores, -k, axis=1)[:, -k, None]
    above, equal = scores > least, scores == least
    return above | (equal & (np.cumsum(equal, axis=1) <= k - above.sum(axis=1, keepdims=True)))


class Best:
    """The k best candidates so far of each query, by score, then smaller id."""

    def __init__(self, n: int, k: int):
        self.k, self.scores, self.ids = k, np.full((n, k), -np.inf), None

    def add(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """scores (query, candidate), with candidates by ascending id."""
        if self.ids is None:
            self.ids = np.zeros(self.scores.shape, ids.dtype)
        elif ids.dtype.itemsize > self.ids.dtype.itemsize:
            self.ids = self.ids.astype(ids.dtype)
        row, column = np.nonzero(_best_columns(scores, self.k))
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        new = np.full((len(queries), self.k), -np.inf), np.zeros((len(queries), self.k), self.ids.dtype)
        new[0][row, nth], new[1][row, nth] = scores[row, column], ids[column]
        both = np.concatenate([self.scores[queries], new[0]], axis=1), np.concatenate([self.ids[queries], new[1]], axis=1)
        order = np.lexsort((both[1], -both[0]), axis=1)[:, : self.k]
        self.scores[queries], self.ids[queries] = (np.take_along_axis(x, order, axis=1) for x in both)


def scanned(rows: DataFrame, asked: Asked, k: int, vec_id: str, vector: str, least: float | None) -> DataFrame:
    """(qid, vec_id, score): for each query, the k best rows of each task. rows: vec_id, vector, and cell if asked has
    cells, each of which is scored for the queries that read it alone."""
    sent = rows.sparkSession.sparkContext.broadcast(asked)
    types = dict(rows.dtypes)
    schema = pa.schema([("qid", asked.qid.type), (vec_id, pa.string() if types[vec_id] == "string" else pa.int64()), ("score", pa.float64())])

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value
        best, n = Best(len(asked.units), k), len(asked.units)
        readers: dict[int, np.ndarray] = {}
        if asked.cells is not None:
            pairs = np.array(sorted((c, q) for q, cells in enumerate(asked.cells) for c in cells.tolist()), np.int64).reshape(-1, 2)
            cells, first = np.unique(pairs[:, 0], return_index=True)
            readers = dict(zip(cells.tolist(), np.split(pairs[:, 1], first[1:]), strict=True)) if len(cells) else {}
        for batch in batches:
            ids, units = _sortable(batch.column(0)), unit_rows(batch.column(1))
            usable = ~np.isnan(units).any(axis=1)
            cell = batch.column(2).to_numpy() if asked.cells is not None else np.zeros(len(ids), np.int64)
            order = np.lexsort((ids, cell))
            order = order[usable[order]]
            for part in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1):
                queries = readers.get(int(cell[part[0]]), np.zeros(0, int)) if asked.cells is not None and len(part) else np.arange(n)
                width = min(asked.units.shape[1], units.shape[1])
                step = max(1, STEP // max(1, len(part)))
                for i in range(0, len(queries) if len(part) else 0, step):
                    some = queries[i : i + step]
                    scores = np.round(asked.units[some, :width] @ units[part, :width].T, DIGITS)
                    if least is not None:
                        scores[scores < least] = -np.inf
                    best.add(some, scores, ids[part])
        q, place = np.nonzero(best.scores > -np.inf)
        found = best.ids[q, place] if best.ids is not None else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([asked.qid.take(pa.array(q)), pa.array(found.tolist(), schema.types[1]), pa.array(best.scores[q, place])], schema=schema)

    id_type = "string" if types[vec_id] == "string" else "long"
    qid_type = "string" if pa.types.is_string(asked.qid.type) or pa.types.is_large_string(asked.qid.type) else "long"
    columns = [vec_id, vector, *(["cell"] if asked.cells is not None else [])]
    return rows.select(*columns).mapInArrow(scan, f"qid {qid_type}, `{vec_id}` {id_type}, score double")


def passes_of(queries: DataFrame, query_bytes: int = QUERY_BYTES) -> Iterator[pa.Table]:
    """Queries (qid, qvec) in passes of about query_bytes at most, dealt by a hash of qid."""
    n, width = queries.agg(F.count("*"), F.coalesce(F.max(F.size("qvec")), F.lit(1))).first()
    passes = max(1, min(n, -(-n * width * 8 // query_bytes)))
    for i in range(passes):
        yield queries.filter(F.pmod(F.xxhash64("qid"), F.lit(passes)) == i).select("qid", "qvec").toArrow().combine_chunks()


def _plain_ids(ids: pa.ChunkedArray) -> pa.Array:
    ids = ids.combine_chunks()
    return ids.cast(pa.int64() if pa.types.is_integer(ids.type) else pa.string())


def nearest_batch(vectors: DataFrame, queries: DataFrame, k: int, vec_id: str = "vec_id", vector: str = "embedding", least: float | None = None, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(qid, vec_id, score, rank) for queries (qid, qvec): k best rows of each query, ties to the smaller vec_id.

    Exact: each vector meets each query. Queries are broadcast, query_bytes of them at a time, in a pass over the
    vectors for each; vectors are read where they are stored, brought to length 1 once, and multiplied by blocks of
    queries. A task sends k rows for each query. Vectors of zeros have no direction, and are never found.
    """
    found = [scanned(vectors, Asked(_plain_ids(t["qid"]), unit_rows(t["qvec"])), k, vec_id, vector, least) for t in passes_of(queries, query_bytes)]
    return top_k(reduce(DataFrame.unionByName, found), k, key=vec_id)
