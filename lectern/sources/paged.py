"""Pages of a remote collection as a table, read by tasks through a callable, with retries."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Attempts at a page, seconds before the second, doubled for each further one, and the longest pause.
ATTEMPTS, WAIT, MOST = 9, 3.0, 60.0


class Busy(Exception):
    """What a callable raises where the other side asks to be tried again later; anything else ends the read."""


class Pages(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


def read_pages(spark: SparkSession, fetch: Callable[[int], list[tuple]], schema: str, pages: int, parts: int = 8, attempts: int = ATTEMPTS, wait: float = WAIT, most: float = MOST) -> DataFrame:
    """Rows of pages 0 to pages - 1, as fetch(page) gives them: a data source whose partitions are ranges of pages.

    fetch runs in tasks; a page that raises Busy, or a timeout, is asked for again after a pause. Pages may be read more
    than once where Spark repeats a task, so that fetch should only read.
    """

    class Reader(DataSourceReader):
        def partitions(self) -> list[InputPartition]:
            step = max(1, -(-pages // max(1, parts)))
            return [Pages(i, min(i + step, pages)) for i in range(0, pages, step)] or [Pages(0, 0)]

        def read(self, partition: Pages) -> Iterator[tuple]:
            for page in range(partition.first, partition.last):
                for attempt in range(attempts):
                    try:
                        rows = fetch(page)
                        break
                    except (Busy, TimeoutError):
                        if attempt + 1 == attempts:
                            raise
                        time.sleep(min(wait * 2**attempt, most))
                yield from rows

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return "lectern_pages"

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> DataSourceReader:
            return Reader()

    spark.dataSource.register(Source)
    return spark.read.format("lectern_pages").load()
