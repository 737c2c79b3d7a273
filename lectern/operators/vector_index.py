"""A stored vector index: rows lie by coarse cells, and a search reads the cells nearest to its queries."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from lectern.operators.keyword import top_k
from lectern.operators.vector import QUERY_BYTES, Asked, _plain_ids, passes_of, scanned, unit_rows
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of the sample that cells are fitted on, and bytes of the cells' centres, which are broadcast: the bounds
#: on what reaches the driver, whatever the table's size.
SAMPLE_ROWS, SAMPLE_BYTES, CENTRE_BYTES = 1 << 16, 128 << 20, 16 << 20
#: Sample rows for each cell, at least, and steps of the fit.
ROWS_PER_CELL, STEPS = 16, 12
#: Recall of the ten best that the default number of cells must reach, and queries, rows of the table, that it is measured with.
RECALL, TRIALS = 0.95, 256


def fitted_cells(units: np.ndarray, cells: int, seed: int = 0, steps: int = STEPS) -> np.ndarray:
    """Centres of length 1 by spherical k-means. A cell that loses all rows moves to the row that fits its own least."""
    r = np.random.default_rng(seed)
    centres = units[r.choice(len(units), cells, replace=False)]
    for _ in range(steps):
        near, score = nearest_cells(units, centres, 1)
        own = near[:, 0]
        total = np.zeros_like(centres)
        np.add.at(total, own, units)
        length = np.sqrt((total * total).sum(axis=1))
        empty = np.flatnonzero(length < 1e-9)
        if len(empty):
            total[empty] = units[np.argsort(score[:, 0])[: len(empty)]]
            length[empty] = 1
        centres = total / length[:, None]
    return centres


def nearest_cells(units: np.ndarray, centres: np.ndarray, n: int, step: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """The n cells of greatest similarity for each row, best first, with the similarity."""
    cells, scores = np.empty((len(units), n), np.int64), np.empty((len(units), n))
    for i in range(0, len(units), step):
        s = units[i : i + step] @ centres.T
        top = np.argpartition(s, -n, axis=1)[:, -n:] if n < s.shape[1] else np.broadcast_to(np.arange(s.shape[1]), s.shape)
        order = np.lexsort((top, -np.take_along_axis(s, top, axis=1)), axis=1)
        cells[i : i + step] = np.take_along_axis(top, order, axis=1)
        scores[i : i + step] = np.take_along_axis(s, cells[i : i + step], axis=1)
    return cells, scores


@dataclass(frozen=True)
class VectorIndex:
    """Tables in a folder: centres (cell, centre); vectors (cell, vec_id, vector, kept columns), in ranges of cells and
    sorted by cell, so that row groups of other cells are skipped; and settings (probes, recall), as measured."""

    spark: SparkSession
    path: str
    vec_id: str = "vec_id"
    vector: str = "embedding"

    @classmethod
    def build(cls, vectors: DataFrame, path: str, vec_id: str = "vec_id", vector: str = "embedding", keep: list[str] | None = None, cells: int | None = None, seed: int = 0) -> VectorIndex:
        """Write the index. cells: about the square root of the rows unless given, and no more than sample and centres
        allow. The fit sees at most SAMPLE_ROWS rows and SAMPLE_BYTES, those of least hash of vec_id; every row is
        assigned to its nearest cell, in one pass. Vectors that are null or of zeros have no direction: they lie in
        cell -1, which no search reads."""
        index = cls(vectors.sparkSession, path, vec_id, vector)
        n, width = vectors.agg(F.count("*"), F.coalesce(F.max(F.size(vector)), F.lit(1))).first()
        rows = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * max(1, width))))
        sample = vectors.filter(F.exists(vector, lambda x: x != 0)).orderBy(F.xxhash64(vec_id), vec_id).limit(rows).select(vector).toArrow()
        units = unit_rows(sample[vector]) if sample.num_rows else np.zeros((0, 1))
        units = units[~np.isnan(units).any(axis=1)]
        most = max(1, min(len(units) // ROWS_PER_CELL, CENTRE_BYTES // (8 * max(1, width))))
        wanted = min(most, cells or max(1, round(n**0.5)))
        centres = fitted_cells(units, min(wanted, len(units)), seed) if len(units) else np.zeros((0, 1))
        listed = [(i, c.tolist()) for i, c in enumerate(centres)]
        index.spark.createDataFrame(listed, "cell long, centre array<double>").coalesce(1).write.parquet(f"{path}/centres")
        index._write(vectors.select(vec_id, vector, *(keep or [])), centres)
        index._measure(centres)
        return index

    def _measure(self, centres: np.ndarray, k: int = 10) -> None:
        """Write how many cells reach RECALL: those that hold the k nearest others of TRIALS rows, found by an exact pass
        over the table, are looked up in the order in which each of these rows would read cells."""
        trials = self.rows().filter("cell >= 0").orderBy(F.xxhash64(self.vec_id, F.lit("trial")), self.vec_id).limit(TRIALS).select(F.col(self.vec_id).alias("qid"), F.col(self.vector).alias("qvec")).dropDuplicates(["qid"])
        asked = trials.toArrow().combine_chunks()
        probes, reached = 1, 1.0
        if asked.num_rows:
            units, qid = unit_rows(asked["qvec"]), _plain_ids(asked["qid"])
            exact = top_k(scanned(self.rows(), Asked(qid, units), k + 1, self.vec_id, self.vector, None), k + 1, key=self.vec_id)
            exact = exact.filter(F.col("qid") != F.col(self.vec_id))
            of = exact.join(self.rows().select(self.vec_id, "cell"), self.vec_id).groupBy("qid", self.vec_id).agg(F.min("cell").alias("cell")).select("qid", "cell").toArrow()
            order = nearest_cells(units, centres, len(centres))[0]
            nth = np.argsort(order, axis=1)
            at = {q: i for i, q in enumerate(qid.to_pylist())}
            needed = np.sort([int(nth[at[q], c]) + 1 for q, c in zip(of["qid"].to_pylist(), of["cell"].to_pylist(), strict=True)])
            if len(needed):
                probes = int(needed[max(0, int(np.ceil(RECALL * len(needed))) - 1)])
                reached = float((needed <= probes).mean())
        self.spark.createDataFrame([(probes, reached)], "probes int, recall double").coalesce(1).write.parquet(f"{self.path}/settings")

    def settings(self) -> tuple[int, float]:
        """Cells that a search reads unless told otherwise, and the recall measured with as many."""
        return tuple(self.spark.read.parquet(f"{self.path}/settings").first())

    def _write(self, vectors: DataFrame, centres: np.ndarray, mode: str = "error") -> None:
        sent = self.spark.sparkContext.broadcast(centres)
        schema = ", ".join(["cell long", *(f"`{n}` {t}" for n, t in vectors.dtypes)])
        at = vectors.columns.index(self.vector)

        def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                units, centres = unit_rows(batch.column(at)), sent.value
                usable = ~np.isnan(units).any(axis=1)
                cell = np.full(len(units), -1)
                width = min(units.shape[1], centres.shape[1])
                if len(centres) and usable.any():
                    cell[usable] = nearest_cells(units[usable][:, :width], centres[:, :width], 1)[0][:, 0]
                yield pa.RecordBatch.from_arrays([pa.array(cell), *batch.columns], ["cell", *batch.schema.names])

        placed = vectors.mapInArrow(assign, schema).repartitionByRange("cell", self.vec_id)
        placed.sortWithinPartitions("cell", self.vec_id).write.mode(mode).option("parquet.block.size", 4 << 20).parquet(f"{self.path}/vectors")

    def add(self, vectors: DataFrame) -> None:
        """More rows, with the columns of the first ones, by the cells that there are."""
        stored = self.rows().drop("cell")
        self._write(vectors.select(*stored.columns), self.centres(), "append")

    def centres(self) -> np.ndarray:
        found = self.spark.read.parquet(f"{self.path}/centres").orderBy("cell").toArrow()
        return np.array(found["centre"].to_pylist(), np.float64).reshape(found.num_rows, -1 if found.num_rows else 1)

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/vectors")

    def nearest(self, queries: DataFrame, k: int, probes: int | None = None, condition: Column | str | None = None, excluded: list | None = None, least: float | None = None, query_bytes: int = QUERY_BYTES) -> DataFrame:
        """(qid, vec_id, score, rank) for queries (qid, qvec): the k best rows of the `probes` cells nearest to each
        query; scores are exact, and ranks follow exclusions, the condition and the threshold.

        probes: as the settings say unless given; as many as there are cells make the search exact. Of the stored
        rows those of cells that some query of a pass reads are scanned, and a cell is scored for its readers alone. A
        condition may leave few rows in the cells that are read; ask for more probes where that matters.
        """
        centres = self.centres()
        probes = max(1, min(len(centres), self.settings()[0] if probes is None else probes))
        rows = self.rows() if condition is None else self.rows().filter(condition)
        if excluded:
            rows = rows.filter(~F.col(self.vec_id).isin(excluded))
        found = []
        for asked in passes_of(queries, query_bytes):
            units = unit_rows(asked["qvec"])
            usable = ~np.isnan(units).any(axis=1)
            cells = [np.zeros(0, np.int64)] * len(units)
            if len(centres) and usable.any():
                width = min(units.shape[1], centres.shape[1])
                for i, c in zip(np.flatnonzero(usable), nearest_cells(units[usable][:, :width], centres[:, :width], probes)[0], strict=True):
                    cells[i] = c
            wanted = sorted({int(c) for each in cells for c in each})
            read = rows.filter(F.col("cell") >= 0) if len(wanted) == len(centres) else rows.filter(F.col("cell").isin(wanted))
            found.append(scanned(read, Asked(_plain_ids(asked["qid"]), np.nan_to_num(units), cells), k, self.vec_id, self.vector, least))
        return top_k(reduce(DataFrame.unionByName, found), k, key=self.vec_id)


def recall(found: DataFrame, exact: DataFrame, vec_id: str = "vec_id") -> float:
    """Share of the exact results (qid, vec_id) that are found."""
    both = exact.select("qid", vec_id).join(found.select("qid", vec_id, F.lit(1).alias("hit")), ["qid", vec_id], "left")
    return both.agg(F.count("hit") / F.count("*")).first()[0]
