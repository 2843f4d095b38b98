"""Bitmaps of seen revisions: what a batch reads of the batches before it."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirefold.schemas import LEDGER_KEY
from quirefold.sinks import event_logs, files, ranges
from quirefold.sinks.event_logs import EventLogs
from quirefold.sinks.seen import MERGED, SEEN, SeenRevisions


def take(logs, classified, run, number):
    logs.write_batch(classified, run, number, F.lit("2026-01-01"))


def batch(spark, revisions, title="p", wiki="enwiki"):
    """Classified records, all valid."""
    rows = spark.createDataFrame([(seq, r) for seq, r in enumerate(revisions)], "ingest_seq bigint, revision_id bigint")
    fields = {
        "wiki": F.lit(wiki),
        "page_title": F.lit(title),
        "event_type": F.lit("PageEdited"),
        "editor": F.lit("ann"),
        "byte_delta": F.lit(1),
        "occurred_at": F.lit("2026-01-01T00:00:00Z"),
        "occurred_ts": F.lit("2026-01-01T00:00:00Z").cast("timestamp"),
        "value": F.lit("{}"),
        "reason": F.lit(None).cast("string"),
    }
    return rows.withColumns(fields)


def rows_of(spark, revisions, wiki="enwiki", per_range=10_000_000):
    rows = spark.createDataFrame([(wiki, r) for r in revisions], "wiki string, revision_id bigint")
    return rows.withColumn("rev_range", F.expr(f"revision_id div {per_range}"))


def marked(seen, rows, run, number):
    return {(r.wiki, r.revision_id): r["_seen"] for r in seen.mark(rows, run, number).collect()}


EDGES = [-(1 << 63), -32769, -32768, -32767, -1, 0, 1, 2, 8, 9, 32767, 32768, 32769, 65536, (1 << 63) - 1]


def test_bits_at_the_edges_of_slots(spark, shared):
    """Every id added is seen, and none of its neighbours."""
    seen = SeenRevisions(spark, f"{shared}/seen")
    seen.add(rows_of(spark, EDGES), "run", 0)
    near = sorted({e + d for e in EDGES for d in (-8, -1, 0, 1, 8) if -(1 << 63) <= e + d < 1 << 63})
    assert marked(seen, rows_of(spark, near), "run", 1) == {("enwiki", r): r in EDGES for r in near}
    assert not any(marked(seen, rows_of(spark, EDGES, wiki="dewiki"), "run", 1).values())


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(st.integers(-70_000, 70_000), max_size=20), min_size=1, max_size=4))
def test_marks_equal_a_set(spark, tmp_path_factory, batches):
    seen = SeenRevisions(spark, str(tmp_path_factory.mktemp("seen")) + "/t")
    held = set()
    for number, ids in enumerate(batches):
        rows = rows_of(spark, ids, per_range=50_000)
        assert marked(seen, rows, "run", number) == {("enwiki", r): r in held for r in ids}
        seen.add(rows, "run", number)
        held |= set(ids)


def test_a_repeated_batch_does_not_see_itself(spark, shared):
    seen = SeenRevisions(spark, f"{shared}/seen")
    seen.add(rows_of(spark, [5]), "run", 3)
    assert not marked(seen, rows_of(spark, [5]), "run", 3)["enwiki", 5]
    assert marked(seen, rows_of(spark, [5]), "run", 4)["enwiki", 5]
    assert marked(seen, rows_of(spark, [5]), "other", 3)["enwiki", 5]


def test_merging_keeps_every_bit_and_the_last_batch(spark, shared):
    seen = SeenRevisions(spark, f"{shared}/seen", merge_after=3)
    for number in range(6):
        seen.add(rows_of(spark, [number, 40_000 + number]), "run", number)
    seen.add(rows_of(spark, [20_000_000]), "run", 0)  # a range of one batch is left alone
    seen.add(rows_of(spark, [77]), "single", 0)
    assert seen.merge() == 5
    names = {(r.rev_range, r.run_id, r.batch_id) for r in seen.read().select(*ranges.BATCH).distinct().collect()}
    assert names == {(0, MERGED, 0), (0, "run", 5), (0, "single", 0), (2, "run", 0)}
    assert seen.read().filter(F.col("run_id") == MERGED).count() == 3  # one bitmap a slot: of 0, of 1 and on, of 40,000 and on
    ids = [*range(6), *range(40_000, 40_006), 77, 20_000_000, 6, 40_006, 78]
    assert marked(seen, rows_of(spark, ids), "run", 6) == {("enwiki", r): r not in (6, 40_006, 78) for r in ids}
    # the last batch of the run can still be repeated, and merged bitmaps merge again
    assert not marked(seen, rows_of(spark, [5]), "run", 5)["enwiki", 5]
    for number in range(6, 9):
        seen.add(rows_of(spark, [number]), "run", number)
    assert seen.merge() == 4
    assert {r.batch_id for r in seen.read().filter(F.col("run_id") == MERGED).select("batch_id").collect()} == {1}
    assert all(marked(seen, rows_of(spark, range(9)), "run", 9).values())
    assert seen.merge() == 0


def test_the_ledger_is_not_read_again(spark, shared):
    """Earlier ledger rows taken away, their revisions are refused all the same; of the valid log only the
    ranges of repeated revisions are opened."""
    logs = EventLogs(spark, shared, revisions_per_range=100)
    take(logs, batch(spark, [1, 2, 101, 102, 201]), "run", 0)
    files.delete(spark, f"{shared}/page_events/rev_range=0")
    take(logs, batch(spark, [1, 2, 3, 301]), "run", 1)
    held = {r.revision_id for r in logs.page_events().collect()}
    assert held == {3, 301, 101, 102, 201}

    # a batch of new revisions opens no file of the valid log
    for number in (0, 1, 2, 3):
        path = f"{shared}/valid/rev_range={number}"
        spark.range(3).selectExpr("'broken' AS first_arrival").write.mode("append").parquet(f"{path}/run_id=bad/batch_id=0")
    take(logs, batch(spark, [4, 103, 202, 302]), "run", 2)
    with pytest.raises(Exception):
        take(logs, batch(spark, [101]), "run", 3)


def test_reads_do_not_grow_with_the_number_of_batches(spark, shared, monkeypatch):
    """Bitmaps that the last batch reads: as many before the ninth batch as before the fifth."""
    monkeypatch.setattr(event_logs, "MERGE_EVERY", 4)
    logs = EventLogs(spark, shared)
    for seen in (logs.valid_seen, logs.page_events_seen):
        seen.merge_after = 2
    read = {}
    for number in range(9):
        read[number] = [seen.read().count() for seen in (logs.valid_seen, logs.page_events_seen)]
        take(logs, batch(spark, range(number * 50, number * 50 + 60)), "run", number)
    assert read[8] == read[4] == [3, 3]
    assert logs.page_events().count() == logs.page_events().select(*LEDGER_KEY).distinct().count() == 8 * 50 + 60
    assert logs.valid().filter("first_arrival").count() == 8 * 50 + 60
    assert logs.valid().count() == 9 * 60


def test_moved_page_counts_for_the_new_title_once(spark, shared):
    """The same revision under another title is new to the fold and known to the ledger."""
    logs = EventLogs(spark, shared)
    for number, title in enumerate(("old", "new", "new", "old")):
        take(logs, batch(spark, [7], title=title), "run", number)
    marks = sorted((r.batch_id, r.page_title) for r in logs.valid().filter("first_arrival").collect())
    assert marks == [(0, "old"), (1, "new")]
    assert [r.page_title for r in logs.page_events().collect()] == ["old"]


def test_crash_before_the_bitmaps_and_older_tables(spark, shared):
    """Rows without bitmaps are found when the stream starts, those of noted batches are not opened again."""
    logs = EventLogs(spark, shared)
    for number in range(3):
        take(logs, batch(spark, [number]), "run", number)
    for seen in (logs.valid_seen, logs.page_events_seen):
        files.delete(spark, f"{seen.path}/rev_range=0/run_id=run/batch_id=2")
    logs.index_missing()
    assert all(marked(logs.page_events_seen, rows_of(spark, range(3)), "run", 3).values())
    take(logs, batch(spark, range(4)), "run2", 0)
    assert sorted(r.revision_id for r in logs.page_events().collect()) == [0, 1, 2, 3]

    for seen in (logs.valid_seen, logs.page_events_seen):
        files.delete(spark, seen.path)
    logs.index_missing()
    take(logs, batch(spark, range(5)), "run2", 1)
    assert sorted(r.revision_id for r in logs.page_events().collect()) == [0, 1, 2, 3, 4]
    plan = logs.page_events().filter("batch_id >= 2")  # what index_missing filters by
    assert "PartitionFilters: [isnotnull(batch_id" in plan._jdf.queryExecution().toString()


def test_batch_in_more_ranges_than_are_named(spark, shared, monkeypatch):
    monkeypatch.setattr(ranges, "NAMED_RANGES", 2)
    logs = EventLogs(spark, shared, revisions_per_range=3)
    for number in range(2):
        take(logs, batch(spark, range(20)), "run", number)
    assert logs.page_events().count() == 20
    assert logs.valid().filter("first_arrival").count() == 20


def test_nothing_stored_and_nothing_given(spark, shared):
    logs = EventLogs(spark, shared)
    logs.index_missing()
    take(logs, batch(spark, [1]).limit(0), "run", 0)
    assert logs.valid_seen.read().schema == SEEN and logs.valid_seen.read().isEmpty()
    assert logs.valid_seen.merge() == 0
