"""Batch sinks of the validation stream: valid log, dead-letter log and page_events ledger.

Each batch owns the directories ``run_id=R/batch_id=N``, in valid log and ledger one below each
range of revision ids it has events in. A batch that is repeated after a failure writes the
same rows over them, so every record counts once. Whether a revision came before is read from
bitmaps (``seen``); earlier rows of the valid log are read only in ranges in which a revision did.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import first_arrival, not_yet_in
from ..operators.ingest import read_ingest_fields, seen_and_sent, to_raw_log
from ..operators.validate import dead_letters, to_page_events, valid_events
from ..schemas import (
    BATCH_ID,
    DEADLETTER,
    FOLD_KEY,
    LEDGER_KEY,
    PAGE_EVENTS,
    PAGE_KEY,
    REV_RANGE,
    RUN_ID,
    VALID,
    VALID_STORED,
    stored_at,
)
from . import files
from .layouts import Layout
from .ranges import of_other_batches, read_all, read_ranges_of, write_ranges
from .seen import SeenRevisions


#: batches after which bitmaps that many of them added to are merged
MERGE_EVERY = 32
#: equal copies of a record that are written out from one row
COPIES = 10_000


class EventLogs:
    """The three tables under one root, and copies of the ledger in other layouts."""

    def __init__(
        self, spark: SparkSession, root: str, revisions_per_range: int = 10_000_000, layouts: tuple[Layout, ...] = ()
    ):
        self.spark = spark
        self.layouts = layouts
        self.root = root.rstrip("/")
        self.revisions_per_range = revisions_per_range
        self.valid_path = f"{self.root}/valid"
        self.deadletter_path = f"{self.root}/deadletter"
        self.page_events_path = f"{self.root}/page_events"
        self.valid_seen = SeenRevisions(spark, f"{self.root}/valid_seen")
        self.page_events_seen = SeenRevisions(spark, f"{self.root}/page_events_seen")

    # --- reads ---
    def valid(self) -> DataFrame:
        return read_all(self.spark, self.valid_path, VALID_STORED)

    def deadletter(self) -> DataFrame:
        return read_all(self.spark, self.deadletter_path, stored_at(DEADLETTER, RUN_ID, BATCH_ID))

    def page_events(self) -> DataFrame:
        return read_all(self.spark, self.page_events_path, stored_at(PAGE_EVENTS, REV_RANGE, RUN_ID, BATCH_ID))

    def index_missing(self) -> None:
        """Complete the bitmaps; a stream does so when it starts."""
        for seen, stored in ((self.valid_seen, self.valid().filter("first_arrival")), (self.page_events_seen, self.page_events())):
            seen.index_missing(stored)

    # --- writes ---
    def write_batch(self, classified: DataFrame, run_id: str, batch_id: int, ingested_at: Column) -> None:
        """Write all three outputs of one classified batch. The caller has persisted it."""
        self.write_deadletter(dead_letters(classified), run_id, batch_id)
        events = valid_events(classified).withColumn("rev_range", self._range_of("revision_id"))
        events = events.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self.write_valid(events, run_id, batch_id)
            self.append_ledger(events, run_id, batch_id, ingested_at)
        finally:
            events.unpersist()
        if batch_id % MERGE_EVERY == MERGE_EVERY - 1:
            self.valid_seen.merge()
            self.page_events_seen.merge()

    def write_deadletter(self, dead: DataFrame, run_id: str, batch_id: int) -> None:
        dead.write.mode("overwrite").parquet(f"{self.deadletter_path}/run_id={run_id}/batch_id={batch_id}")

    def write_valid(self, events: DataFrame, run_id: str, batch_id: int) -> None:
        """Append valid events, copies included; exactly one of each page and revision is marked."""
        found = first_arrival(events, FOLD_KEY)
        told = self.valid_seen.mark(found, run_id, batch_id).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # a page and revision can only have come before if the wiki's revision has
            stored = read_ranges_of(self.spark, self.valid_path, VALID_STORED, told.filter("_seen"))
            earlier = of_other_batches(stored, run_id, batch_id).filter("first_arrival")
            first = not_yet_in(told.drop("_seen"), earlier, FOLD_KEY).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                marked = _marked(events, first)
                write_ranges(marked, self.valid_path, run_id, batch_id, *PAGE_KEY, "occurred_ts")
                self.valid_seen.add(first, run_id, batch_id)
            finally:
                first.unpersist()
        finally:
            told.unpersist()

    def append_ledger(self, events: DataFrame, run_id: str, batch_id: int, ingested_at: Column) -> None:
        """Insert events whose revision the ledger does not hold yet; the first to arrive wins."""
        found = self.page_events_seen.mark(first_arrival(events, LEDGER_KEY), run_id, batch_id)
        first = found.filter("NOT _seen").drop("_seen")
        placed = to_page_events(first, ingested_at).withColumn("rev_range", self._range_of("revision_id"))
        placed = placed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # the copies first: a batch that fails before the ledger is written finds its revisions new again
            for layout in self.layouts:
                layout.append(placed, run_id, batch_id)
            write_ranges(placed, self.page_events_path, run_id, batch_id, *PAGE_KEY, "occurred_at")
            self.page_events_seen.add(placed, run_id, batch_id)
        finally:
            placed.unpersist()

    def _range_of(self, revision_id: str) -> Column:
        return F.expr(f"{revision_id} div {self.revisions_per_range}")


def _marked(events: DataFrame, first: DataFrame) -> DataFrame:
    """All events, copies included, with the mark of those that are first arrivals."""
    rest = [c for c in events.columns if c not in FOLD_KEY and c != "ingest_seq"]
    marks = first.select(*FOLD_KEY, "ingest_seq", F.struct(*rest).alias("_first"))
    # equal copies as one row with their number: one of them is marked; joining on the sequence
    # too, copies of one revision do not meet in one task
    copies = events.groupBy(*events.columns).agg(F.count("*").alias("_copies"))
    is_first = F.col("_first").isNotNull() & F.struct(*rest).eqNullSafe(F.col("_first"))
    marked = (
        copies.join(marks, [*FOLD_KEY, "ingest_seq"], "left")
        # in chunks, so that no array holds all copies of a record that floods the log
        .select("*", F.explode(F.expr(f"sequence(0L, (_copies - 1) div {COPIES})")).alias("_chunk"))
        .withColumn("_here", F.least(F.lit(COPIES).cast("bigint"), F.col("_copies") - F.col("_chunk") * COPIES))
        .select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), "_here")).alias("_copy"))
        .withColumn("first_arrival", is_first & (F.col("_chunk") == 0) & (F.col("_copy") == 1))
    )
    return marked.select(*VALID.fieldNames(), "first_arrival", "rev_range")


def append_topic(records: DataFrame, servers: str, topic: str) -> None:
    """Write ``key, value`` records to a message topic (needs Spark's Kafka connector)."""
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def append_raw_log(accepted: DataFrame, path: str) -> None:
    """Append accepted records to the raw log."""
    accepted.write.mode("append").parquet(path)


COUNTS = "delivery bigint, published_at timestamp, seen bigint, sent bigint, delivered bigint, failed bigint"


def published_counts(spark: SparkSession, path: str) -> DataFrame:
    """What each delivery to the raw log came to; no rows before the first."""
    counts = f"{path.rstrip('/')}_counts"
    if not files.exists(spark, counts):
        return spark.createDataFrame([], COUNTS)
    return spark.read.schema(COUNTS).parquet(counts)


def publish_counted(records: DataFrame, path: str) -> None:
    """Append the records in scope to the raw log, and a row with the delivery's counts beside it.

    seen: records that are JSON, sent: those in scope; counted while they are written. A write that fails
    delivers nothing: what it was to send counts as failed, and its error is raised.
    """
    spark = records.sparkSession
    read = read_ingest_fields(records)
    found, written = Observation(), Observation()
    observed = read.observe(found, F.count_if("is_json").alias("seen"), F.count_if("accepted").alias("sent"))
    out = to_raw_log(observed.filter("accepted")).observe(written, F.count(F.lit(1)).alias("rows"))
    number = published_counts(spark, path).agg(F.coalesce(F.max("delivery"), F.lit(0)) + 1).first()[0]

    def told(seen: int, sent: int, delivered: int) -> None:
        row = (number, datetime.now(timezone.utc), seen, sent, delivered, sent - delivered)
        spark.createDataFrame([row], COUNTS).coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}_counts")

    try:
        append_raw_log(out, path)
    except Exception:
        lost = seen_and_sent(records).first()
        told(lost.seen, lost.sent, 0)
        raise
    told(found.get["seen"], found.get["sent"], written.get["rows"])
