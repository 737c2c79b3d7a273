"""Event tables: batch reports, and streams with watermarks. The streams are an extension of this library."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def appended(events: DataFrame, path: str) -> None:
    """Append events to a table."""
    events.write.mode("append").parquet(path)


def click_through(searches: DataFrame, clicks: DataFrame) -> DataFrame:
    """(mode, searches, clicked, rate, mean_rank) of searches (search_id, mode) and clicks (search_id, rank)."""
    first = clicks.groupBy("search_id").agg(F.min("rank").alias("rank"))
    joined = searches.join(first, "search_id", "left")
    return joined.groupBy("mode").agg(F.count("*").alias("searches"), F.count("rank").alias("clicked"), (F.count("rank") / F.count("*")).alias("rate"), F.avg("rank").alias("mean_rank"))


def sessions(events: DataFrame, per: str, ts: str, gap_seconds: int) -> DataFrame:
    """events with session: it changes where the event before is over gap_seconds away. Batch form, by a window."""
    w = Window.partitionBy(per).orderBy(ts)
    since = F.col(ts).cast("timestamp").cast("double") - F.lag(ts).over(w).cast("timestamp").cast("double")
    starts = F.when(since.isNull() | (since > gap_seconds), 1).otherwise(0)
    return events.withColumn("_s", starts).withColumn("session", F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_s")


def windowed_counts(events: DataFrame, ts: str, per: list[str], size: str, late: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """Counts of each window of event time, of a batch or a stream; a stream drops what is later than `late`."""
    marked = events.withWatermark(ts, late) if events.isStreaming else events
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return marked.groupBy(w, *per).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *per, "n")


def session_counts(events: DataFrame, ts: str, per: list[str], gap: str, late: str = "10 minutes") -> DataFrame:
    marked = events.withWatermark(ts, late) if events.isStreaming else events
    w = F.session_window(ts, gap)
    return marked.groupBy(w, *per).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *per, "n")


def deduplicated(events: DataFrame, key: list[str], ts: str, late: str = "10 minutes") -> DataFrame:
    """Each key once; a stream remembers keys for as long as late events may come."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(key) if events.isStreaming else events.dropDuplicates(key)
