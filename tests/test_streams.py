"""The two streams: equal to the batch results, and unchanged by repetition."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from quirefold.operators import dedup, fold, validate
from quirefold.operators.compare import same_rows
from quirefold.schemas import FOLD_KEY, LEDGER_KEY, PAGE_STATE
from quirefold.sinks.event_logs import EventLogs
from quirefold.sinks.page_state import PageStateTable
from quirefold.sources import logs
from quirefold.streaming import restart
from quirefold.streaming.fold_stream import start_fold
from quirefold.streaming.validate_stream import start_validation
from support import raw, text


def record(title, rev, user, delta, second):
    return text(
        title=title,
        revision={"new": rev},
        user=user,
        length={"old": 100, "new": 100 + delta},
        meta={"dt": f"2026-01-01T00:{second // 60:02d}:{second % 60:02d}Z"},
    )


# copies (some with other contents), moved revisions, and broken records, over several files
RECORDS = (
    [record(f"p{i % 5}", i, f"u{i % 4}", i % 7 - 3, (i * 37) % 600) for i in range(40)]
    + [record(f"p{i % 5}", i, "other", 99, 5) for i in range(0, 40, 3)]
    + [record("moved", i, f"u{i % 4}", 1, i) for i in range(0, 40, 4)]
    + ["{", text(type="log"), text(revision=None)]
    + [record("p1", 1000 + i % 6, f"w{i}", i, 10 + i) for i in range(30)]
)


def write_raw(spark, path, pieces):
    """The records as a raw log of so many appends."""
    log = raw(spark, RECORDS).select("ingest_seq", F.lit("k").alias("key"), "value")
    step = -(-len(RECORDS) // pieces)
    for start in range(0, len(RECORDS), step):
        part = (F.col("ingest_seq") >= start) & (F.col("ingest_seq") < start + step)
        log.filter(part).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("pieces", [1, 3, 6])
def test_streams_equal_batch(spark, shared, pieces):
    write_raw(spark, f"{shared}/raw", pieces)
    events = EventLogs(spark, shared, revisions_per_range=500)
    start_validation(
        spark, logs.raw_log_stream(spark, f"{shared}/raw", max_files=1), events, f"{shared}/c1", drain=True
    ).awaitTermination()
    table = PageStateTable(spark, f"{shared}/page_state", buckets=4)
    start_fold(spark, logs.valid_log_stream(spark, events.valid_path, max_files=2), table, f"{shared}/c2", drain=True).awaitTermination()

    classified = validate.classify(raw(spark, RECORDS))
    valid = validate.valid_events(classified)
    assert same_rows(valid, events.valid().select(*valid.columns))
    assert same_rows(validate.dead_letters(classified), events.deadletter().select("ingest_seq", "reason", "raw"))
    ledger = validate.to_page_events(dedup.first_arrival(valid, LEDGER_KEY), F.lit("2026-01-01"))
    assert same_rows(ledger.drop("ingested_at"), events.page_events().select(*ledger.columns).drop("ingested_at"))
    assert events.page_events().filter("ingested_at IS NULL").isEmpty()
    assert same_rows(fold.fold_pages(valid), table.read())
    assert table.read().schema == PAGE_STATE

    # what is there is not taken in again
    start_validation(
        spark, logs.raw_log_stream(spark, f"{shared}/raw"), events, f"{shared}/c1", drain=True
    ).awaitTermination()
    assert events.valid().count() == valid.count()


def test_fold_stream_of_an_unmarked_log_drops_copies_itself(spark, shared):
    """A valid log from a message topic: JSON text, delivered at least once, without our marks."""
    valid = validate.valid_events(validate.classify(raw(spark, RECORDS[:40] + RECORDS[54:64])))
    sent = validate.to_valid_json(valid)
    for copy in range(3):
        sent.withColumn("ingest_seq", F.col("ingest_seq") + copy * 1000).repartition(2).write.mode("append").parquet(f"{shared}/log")
    stream = validate.from_valid_json(
        spark.readStream.schema(sent.schema).option("maxFilesPerTrigger", 1).parquet(f"{shared}/log")
    )
    table = PageStateTable(spark, f"{shared}/page_state", buckets=2)
    start_fold(spark, stream, table, f"{shared}/c", drain=True).awaitTermination()
    assert same_rows(fold.fold_pages(valid), table.read())


def test_repeated_batch_changes_nothing(spark, shared):
    events = EventLogs(spark, shared)
    half = len(RECORDS) // 2
    batches = [raw(spark, RECORDS).filter(F.col("ingest_seq") < half), raw(spark, RECORDS).filter(F.col("ingest_seq") >= half)]
    for number, batch in enumerate(batches):
        events.write_batch(validate.classify(batch), "run", number, F.lit("2026-01-01"))
    tables = (events.valid, events.deadletter, events.page_events)
    before = [sorted(map(repr, t().collect())) for t in tables]
    events.write_batch(validate.classify(batches[1]), "run", 1, F.lit("2026-01-01"))
    assert [sorted(map(repr, t().collect())) for t in tables] == before
    # another run over the same records adds copies to the valid log, none to the ledger
    events.write_batch(validate.classify(batches[0]), "run2", 0, F.lit("2026-01-01"))
    assert sorted(map(repr, events.page_events().collect())) == before[2]
    assert events.valid().filter("first_arrival").count() == sum("first_arrival=True" in row for row in before[0])


def test_batch_spread_over_many_ranges(spark, shared):
    events = EventLogs(spark, shared, revisions_per_range=5)
    for number in range(2):
        events.write_batch(validate.classify(raw(spark, RECORDS)), "run", number, F.lit("2026-01-01"))
    valid = validate.valid_events(validate.classify(raw(spark, RECORDS)))
    assert events.page_events().count() == valid.select(*LEDGER_KEY).distinct().count()


def test_redelivered_records_count_once(spark, shared):
    """Copies with equal numbers, in one batch and in the next."""
    events = EventLogs(spark, shared)
    once = raw(spark, RECORDS)
    for number in range(2):
        events.write_batch(validate.classify(once.unionAll(once)), "run", number, F.lit("2026-01-01"))
    valid = validate.valid_events(validate.classify(once))
    assert events.valid().count() == 4 * valid.count()
    assert events.page_events().count() == valid.select(*LEDGER_KEY).distinct().count()
    assert events.valid().filter("first_arrival").count() == valid.select(*FOLD_KEY).distinct().count()


def test_empty_batch(spark, shared):
    events = EventLogs(spark, shared)
    events.write_batch(validate.classify(raw(spark, ["x"]).limit(0)), "run", 0, F.lit("2026-01-01"))
    assert events.valid().count() == events.page_events().count() == events.deadletter().count() == 0


def test_failed_query_is_restarted(spark):
    class Query:
        def __init__(self, fails):
            self.fails = fails

        def awaitTermination(self):
            if self.fails:
                raise StreamingQueryException("lost")

    outcomes = [True, True, False]
    assert restart.run_until_done(lambda: Query(outcomes.pop(0)), delay=0) == 2
    with pytest.raises(StreamingQueryException):
        restart.run_until_done(lambda: Query(True), delay=0, max_restarts=1)
