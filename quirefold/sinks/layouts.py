"""Copies of a table laid out for reading: by time, for what is recent, and by page, for one page.

Rows lie in directories ``part=P/run_id=R/batch_id=N``. A reader's condition on time or page becomes a
filter on ``part``, so that no other directory is opened. A batch that is repeated after a failure first
removes what it wrote before, wherever that lies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import reads
from ..schemas import BATCH_ID, PAGE_KEY, RUN_ID, stored_at
from . import files

PART = T.StructField("part", T.LongType())
#: the part of rows without a time; it sorts before all others
NO_TIME = -(1 << 63)


class Layout:
    """A table in parts; ``size`` says how parts are cut and stays with the table."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, size: int):
        if size < 1:
            raise ValueError(f"a layout needs a positive size, got {size}")
        self.spark, self.path, self.schema, self.size = spark, path.rstrip("/"), schema, size
        files.create_new(spark, f"{self.path}/_size", str(size))
        written = int(files.read_text(spark, f"{self.path}/_size"))
        if written != size:
            raise ValueError(f"{self.path} is laid out with size {written}, not {size}")

    def part(self) -> Column:
        raise NotImplementedError

    def order(self) -> list[str]:
        raise NotImplementedError

    def append(self, rows: DataFrame, run_id: str, batch_id: int) -> None:
        """Write a batch. Small parts share a task, a large one is split over several."""
        files.delete_matching(self.spark, f"{self.path}/part=*/run_id={run_id}/batch_id={batch_id}")
        placed = rows.select(*self.schema.fieldNames()).withColumns(
            {"part": self.part(), "run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("bigint")}
        )
        ordered = placed.hint("rebalance", F.col("part")).sortWithinPartitions("part", *self.order())
        ordered.write.mode("append").partitionBy("part", "run_id", "batch_id").parquet(self.path)

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(stored_at(self.schema, PART, RUN_ID, BATCH_ID)).parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().select(*self.schema.fieldNames())


class ByTime(Layout):
    """Rows by the span of ``size`` seconds that ``column`` falls into; a null time has a part of its own."""

    def __init__(self, spark, path: str, schema: T.StructType, size: int = 3600, column: str = "ingested_at"):
        super().__init__(spark, path, schema, size)
        self.column = column

    def _span(self, moment: Column) -> Column:
        return F.floor(F.unix_seconds(moment) / self.size)

    def part(self) -> Column:
        return F.coalesce(self._span(F.col(self.column)), F.lit(NO_TIME))

    def order(self) -> list[str]:
        return [self.column]

    def since(self, moment: Column) -> DataFrame:
        """The rows of the spans that reach beyond a moment; the caller compares the times themselves."""
        return self._stored().filter(F.col("part") >= self._span(moment)).select(*self.schema.fieldNames())

    def newest(self, n: int) -> DataFrame:
        """The rows of the latest spans that hold at least ``n`` rows together, or all rows.

        Spans are counted from the latest back, twice as many each time; counting reads file footers only.
        """
        spans = sorted(map(int, files.partition_values(self.spark, self.path, "part")), reverse=True)
        stored, taken = self._stored(), 1
        while taken < len(spans):
            late = stored.filter(F.col("part") >= spans[taken - 1])
            if late.limit(n).count() == n:
                return late.select(*self.schema.fieldNames())
            taken *= 2
        return stored.select(*self.schema.fieldNames())


class ByPage(Layout):
    """Rows dealt by hash of their page over ``size`` parts; inside a file they lie by page, so that the
    scan skips row groups without it."""

    def __init__(self, spark, path: str, schema: T.StructType, size: int = 1024):
        super().__init__(spark, path, schema, size)

    def part(self) -> Column:
        return self._part_of(*map(F.col, PAGE_KEY))

    def _part_of(self, wiki: Column, page_title: Column) -> Column:
        return F.pmod(F.xxhash64(wiki, page_title), F.lit(self.size).cast("bigint"))

    def order(self) -> list[str]:
        return PAGE_KEY

    def of_page(self, wiki: str, page_title: str) -> DataFrame:
        here = self._stored().filter(F.col("part") == self._part_of(F.lit(wiki), F.lit(page_title)))
        return reads.of_page(here, wiki, page_title).select(*self.schema.fieldNames())


def feed(page_events: ByTime, limit: int = reads.FEED_LIMITS[0]) -> DataFrame:
    """The events taken in last, newest first, from the latest spans alone."""
    reads.checked_limit(limit, reads.FEED_LIMITS[1])
    return reads.feed(page_events.newest(limit), limit)


def events_per_minute(page_events: ByTime, asof=None) -> DataFrame:
    moment = reads.as_of(asof)
    return reads.events_per_minute(page_events.since(moment - F.expr("INTERVAL 1 MINUTE")), moment)


def page_history(page_events: ByPage, wiki: str, page_title: str) -> DataFrame:
    return reads.page_history(page_events.of_page(wiki, page_title), wiki, page_title)


def page_lookup(page_events: ByPage, page_state: ByPage, wiki: str, page_title: str) -> DataFrame:
    """A page's events beside its current state, which may be absent: at most one part of each table."""
    return reads.history_with_state(page_events.of_page(wiki, page_title), page_state.of_page(wiki, page_title))
