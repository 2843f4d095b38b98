"""The ledger laid out by time and by page."""

import re

import pytest
from pyspark.sql import functions as F

from quirefold.operators import dedup, fold, reads, validate
from quirefold.plans import queries
from quirefold.schemas import LEDGER_KEY, PAGE_EVENTS, PAGE_STATE
from quirefold.sinks import layouts
from quirefold.sinks.event_logs import EventLogs
from support import raw, text, valid

SF_DIR = "/root/testdata/sf0.001"
START = 1_767_225_600
ROWS = [(i, f"p{i % 7}", i, f"e{i % 4}", 1, i % 5) for i in range(200)]


@pytest.fixture()
def ledger(spark):
    """One event every ten seconds."""
    first = dedup.first_arrival(valid(spark, ROWS), LEDGER_KEY)
    return validate.to_page_events(first, F.timestamp_seconds(START + F.col("ingest_seq") * 10))


def partition_filters(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)


def as_of(seconds):
    return F.timestamp_seconds(F.lit(START + seconds))


def test_feed_reads_the_latest_spans_only(spark, shared, ledger):
    table = layouts.ByTime(spark, shared + "/t", PAGE_EVENTS, 60)
    table.append(ledger, "r", 0)
    for limit in (1, 2, 6, 7, 15, 100):
        assert layouts.feed(table, limit).collect() == reads.feed(ledger, limit).collect()
    newest = table.newest(6)
    assert any("part" in f for f in partition_filters(newest))
    # the last span holds two events, the one before six
    assert newest.count() == 8 and table.newest(2).count() == 2
    assert table.newest(1000).count() == table.read().count() == 200
    with pytest.raises(ValueError):
        layouts.feed(table, 101)


@pytest.mark.parametrize("second", [0, 5, 60, 1990, 2049, 2050, 10_000, -10_000])
def test_events_of_the_last_minute(spark, shared, ledger, second):
    table = layouts.ByTime(spark, shared + "/t", PAGE_EVENTS, 45)
    table.append(ledger, "r", 0)
    found = layouts.events_per_minute(table, as_of(second))
    assert found.collect() == reads.events_per_minute(ledger, as_of(second)).collect()
    assert all("part" in f for f in partition_filters(found))


def test_no_time_and_times_before_1970(spark, shared, ledger):
    odd = ledger.limit(3).withColumn(
        "ingested_at", F.when(F.col("ingest_seq") % 2 == 0, F.lit(None)).otherwise(F.timestamp_seconds(F.lit(-5)))
    )
    table = layouts.ByTime(spark, shared + "/t", PAGE_EVENTS, 60)
    table.append(odd, "r", 0)
    assert layouts.feed(table, 3).collect() == reads.feed(odd, 3).collect()
    assert layouts.feed(table, 1).first().ingested_at is not None


def test_a_repeated_batch_counts_once(spark, shared, ledger):
    table = layouts.ByTime(spark, shared + "/t", PAGE_EVENTS, 60)
    table.append(ledger, "r", 0)
    # taken in an hour later this time: other spans
    later = ledger.withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 HOUR"))
    table.append(later, "r", 0)
    table.append(ledger.limit(0), "r", 1)
    assert sorted(table.read().collect()) == sorted(later.collect())


def test_one_page_from_one_part(spark, shared, ledger):
    events = layouts.ByPage(spark, shared + "/e", PAGE_EVENTS, 16)
    states = layouts.ByPage(spark, shared + "/s", PAGE_STATE, 16)
    state = fold.fold_pages(valid(spark, ROWS)).filter("page_title <> 'p6'")
    half = F.col("ingest_seq") < 100
    events.append(ledger.filter(half), "r", 0)
    events.append(ledger.filter(~half), "r", 1)
    states.append(state, "r", 0)
    for title in ("p0", "p3", "p6", "none"):
        here = layouts.page_history(events, "enwiki", title)
        assert here.collect() == reads.page_history(ledger, "enwiki", title).collect()
        found = layouts.page_lookup(events, states, "enwiki", title).collect()
        wanted = reads.of_page(reads.history_with_state(ledger, state), "enwiki", title).collect()
        assert sorted(found, key=str) == sorted(wanted, key=str)
    assert all("part" in f for f in partition_filters(events.of_page("enwiki", "p0")))


def test_a_hot_page_is_written_by_several_tasks(spark, shared):
    rows = [(i, "hot" if i % 3 else f"p{i}", i, "e", 1, i) for i in range(3000)]
    ledger = validate.to_page_events(dedup.first_arrival(valid(spark, rows), LEDGER_KEY), F.timestamp_seconds(F.lit(START)))
    table = layouts.ByPage(spark, shared + "/e", PAGE_EVENTS, 4)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "16k")
    try:
        table.append(ledger.repartition(40), "r", 0)
    finally:
        spark.conf.set(size, before)
    hot = table.of_page("enwiki", "hot")
    assert hot.count() == 2000 and hot.select(F.input_file_name()).distinct().count() > 1


def test_an_empty_table_and_a_changed_size(spark, shared):
    table = layouts.ByTime(spark, shared + "/t", PAGE_EVENTS, 60)
    assert layouts.feed(table).collect() == [] and table.read().count() == 0
    assert layouts.events_per_minute(table, as_of(0)).first()[0] == 0
    with pytest.raises(ValueError):
        layouts.ByTime(spark, shared + "/t", PAGE_EVENTS, 61)
    with pytest.raises(ValueError):
        layouts.ByPage(spark, shared + "/p", PAGE_EVENTS, 0)


def test_the_validation_sink_keeps_its_layouts(spark, shared):
    by_time = layouts.ByTime(spark, shared + "/t", PAGE_EVENTS, 60)
    by_page = layouts.ByPage(spark, shared + "/p", PAGE_EVENTS, 4)
    logs = EventLogs(spark, shared + "/logs", layouts=(by_time, by_page))
    for batch, revisions in enumerate(([1, 2, 3], [3, 4], [3, 4])):
        records = raw(spark, [text(revision={"new": r}, title=f"p{r}") for r in revisions])
        logs.write_batch(validate.classify(records), "r", min(batch, 1), as_of(batch * 100))
    for table in (logs.page_events(), by_time.read(), by_page.read()):
        assert sorted(r.revision_id for r in table.collect()) == [1, 2, 3, 4]


def test_editor_sketches_keep_their_bound(spark):
    rows = [(i, "p", i, f"e{i * 7919 % 20_000}", 1, (i % 3) * 86_400) for i in range(40_000)]
    ledger = validate.to_page_events(valid(spark, rows), F.timestamp_seconds(F.lit(START)))
    sketches = reads.editor_sketches(ledger)
    exact = {r.day: r.editors for r in reads.editors_by_day(ledger).collect()}
    found = {r.day: r.editors_estimate for r in reads.editors_in(sketches, F.col("day")).collect()}
    found[None] = reads.editors_in(sketches).first().editors_estimate
    assert found.keys() == exact.keys() and exact[None] == 20_000
    assert all(abs(found[day] - n) <= reads.SKETCH_ERROR * n for day, n in exact.items())
    assert reads.editors_in(reads.editor_sketches(ledger.limit(0))).first().editors_estimate == 0


def test_a_lookup_parses_the_log_once_and_takes_first_arrivals_once(spark, monkeypatch):
    parsed, batches = [], []
    read, append = queries.raw_events, layouts.Layout.append
    monkeypatch.setattr(queries, "raw_events", lambda *of: parsed.append(of) or read(*of))

    def noted(layout, rows, run_id, batch_id):
        batches.append((layout.schema, rows._jdf.queryExecution().executedPlan().toString()))
        append(layout, rows, run_id, batch_id)

    monkeypatch.setattr(layouts.Layout, "append", noted)
    assert queries.page_lookup(spark, SF_DIR).count() > 0
    assert len(parsed) == 1
    of_events = [text for schema, text in batches if schema == PAGE_EVENTS]
    assert len(of_events) == 3
    # nothing is grouped by a key any more; the count of events that cuts the batches has none
    assert not any(re.search(r"Aggregate\(keys?=\[[^\]]", text) for text in of_events)
