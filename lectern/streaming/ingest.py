"""Streams into tables: upserts that a replayed batch does not repeat, and searches joined with their clicks."""

from __future__ import annotations

from lectern.sources.store import delete_table, exists
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


class UpsertTable:
    """Rows by key, in a folder: each batch of a stream is a folder of its own, by the batch's id, and of rows with one
    key that of the latest batch counts. A batch that is replayed writes the same folder again, and changes nothing.

    merge() folds batches into a base, by the last id that it holds; batches up to it are passed over if they come again.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], order: str):
        self.spark, self.path, self.key, self.order = spark, path, key, order

    def _folders(self, kind: str) -> list[int]:
        if not exists(self.spark, f"{self.path}/{kind}"):
            return []
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        files = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath() for s in files.listStatus(target)]
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(int(p.getName()) for p in names if p.getName().isdigit() and files.exists(done(p, "_SUCCESS")))

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """A batch: of rows with one key the last by `order` stays, and of equal ones the greatest by the other columns."""
        if self._folders("base")[-1:] >= [batch_id]:
            return
        others = [F.col(c).desc_nulls_last() for c in batch.columns if c not in self.key]
        latest = Window.partitionBy(*self.key).orderBy(F.col(self.order).desc_nulls_last(), *others)
        rows = batch.withColumn("_row", F.row_number().over(latest)).filter("_row = 1").drop("_row")
        rows.write.mode("overwrite").parquet(f"{self.path}/batches/{batch_id}")

    def rows(self) -> DataFrame | None:
        """The table as of the last batch; None before the first."""
        base = self._folders("base")[-1:]
        batches = [b for b in self._folders("batches") if [b] > base]
        parts = [self.spark.read.parquet(f"{self.path}/base/{b}").withColumn("_batch", F.lit(-1)) for b in base]
        parts += [self.spark.read.parquet(f"{self.path}/batches/{b}").withColumn("_batch", F.lit(b)) for b in batches]
        if not parts:
            return None
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p, allowMissingColumns=True)
        columns = [c for c in out.columns if c not in (*self.key, "_batch")]
        latest = out.groupBy(*self.key).agg(F.max_by(F.struct(*columns), "_batch").alias("_r"))
        return latest.select(*self.key, *(F.col(f"_r.`{c}`").alias(c) for c in columns))

    def merge(self) -> None:
        """Batches so far become the base; what it was made of is deleted."""
        base, batches = self._folders("base"), self._folders("batches")
        if not batches or base[-1:] >= batches[-1:]:
            return
        self.rows().write.mode("overwrite").parquet(f"{self.path}/base/{batches[-1]}")
        for kind, ids in (("base", base), ("batches", batches)):
            for i in ids:
                delete_table(self.spark, f"{self.path}/{kind}/{i}")

    def stream(self, rows: DataFrame, checkpoint: str) -> DataStreamWriter:
        """A writer that upserts each batch of a stream."""
        return rows.writeStream.foreachBatch(self.write).option("checkpointLocation", checkpoint)


def searches_with_clicks(searches: DataFrame, clicks: DataFrame, within: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """searches (search_id, ts, ...) with the clicks (search_id, ts, ...) that follow within a time, as streams or batches:
    a row for each pair, with click_ts and the clicks' other columns, and one with nulls for a search without clicks.

    As streams both sides are remembered for as long as a partner may come: clicks up to `within` after their search, and
    either side up to `late` behind the latest seen. What is later than that is dropped; a search without clicks is given
    out once no click can come any more.
    """
    s = searches.withWatermark("ts", late) if searches.isStreaming else searches
    c = clicks.select(F.col("search_id").alias("_of"), F.col("ts").alias("click_ts"), *(x for x in clicks.columns if x not in ("search_id", "ts")))
    c = c.withWatermark("click_ts", late) if clicks.isStreaming else c
    near = F.expr(f"search_id = _of AND click_ts >= ts AND click_ts <= ts + INTERVAL {within}")
    return s.join(c, near, "left_outer").drop("_of")
