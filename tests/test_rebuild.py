"""The read model table and its rebuild."""

import threading
import threading
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from quirefold.operators import audit, compare, fold, reads, validate
from quirefold.plans.rebuild import Rebuild, RebuildRefused
from quirefold.sinks import files
from quirefold.sinks.event_logs import EventLogs
from quirefold.sinks.page_state import PageStateTable
from quirefold.sinks.rebuild_log import RebuildLog
from support import fold_rows, raw, text, valid

ROWS = [(i, f"p{i % 9}", i % 40, f"e{i % 5}", i % 11 - 5, (i * 7) % 300) for i in range(60)]
LATER = datetime.now(timezone.utc) + timedelta(hours=1)


@pytest.fixture()
def built(spark, shared):
    """A log, a page_state table that holds its fold, and the rebuild of it."""
    valid(spark, ROWS).write.parquet(shared + "/valid")
    log = spark.read.parquet(shared + "/valid")
    table = PageStateTable(spark, shared + "/page_state", buckets=4)
    table.upsert(fold.fold_pages(log))
    return log, table, Rebuild(RebuildLog(spark, shared), table)


def snapshot(table):
    return reads.canonical(table.read()).collect()


def test_rebuild_is_deterministic(built):
    log, table, rebuild = built
    before = snapshot(table)
    assert rebuild.status().isEmpty()
    outcome = rebuild.run(log)
    assert (outcome["status"], outcome["discrepancy_count"], outcome["events_replayed"]) == ("succeeded", 0, 60)
    assert snapshot(table) == before
    # refused within the cooldown, allowed after it
    with pytest.raises(RebuildRefused, match="cooldown"):
        rebuild.run(log)
    assert rebuild.run(log, asof=LATER)["id"] == 2
    assert snapshot(table) == before


def test_rebuild_repairs_and_counts_corrupted_pages(built):
    log, table, rebuild = built
    right = snapshot(table)
    state = table.read()
    wrong = state.filter("page_title IN ('p1', 'p2')").withColumn("edit_count", F.col("edit_count") + 1)
    extra = state.filter("page_title = 'p3'").withColumn("page_title", F.lit("not in the log"))
    table.upsert(wrong.unionByName(extra))
    assert snapshot(table) != right
    assert rebuild.run(log)["discrepancy_count"] == 3
    assert snapshot(table) == right


def test_one_rebuild_at_a_time(built, shared):
    log, table, rebuild = built
    other = Rebuild(RebuildLog(table.spark, shared), table)
    assert other.log.try_lock()
    with pytest.raises(RebuildRefused, match="locked"):
        rebuild.run(log)
    other.log.unlock()
    assert rebuild.run(log)["status"] == "succeeded"
    assert not files.exists(table.spark, rebuild.log.lock_path)


def test_failure_leaves_the_state(built):
    log, table, rebuild = built
    before, pointer = snapshot(table), table.current()
    broken = log.withColumn("byte_delta", F.raise_error(F.concat(F.lit("broken "), F.repeat(F.lit("x"), 2000))).cast("int"))
    outcome = rebuild.run(broken)
    assert outcome["status"] == "failed" and len(outcome["error_message"]) == 1000
    assert table.current() == pointer and snapshot(table) == before
    # a failure has its cooldown too, and gives the lock back
    with pytest.raises(RebuildRefused, match="cooldown"):
        rebuild.run(log)
    assert rebuild.run(log, asof=LATER)["status"] == "succeeded"


def test_crashed_rebuild_does_not_block(built, shared):
    log, table, rebuild = built
    crashed = RebuildLog(table.spark, shared)
    assert crashed.try_lock()
    crashed.append(1, 0, "running", datetime.now(timezone.utc) - timedelta(days=1))
    rebuild.log.stale_after_seconds = 0
    time.sleep(0.01)
    assert rebuild.run(log)["id"] == 2
    rows = {r.id: r for r in audit.current_status(rebuild.log.read()).collect()}
    assert (rows[1].status, rows[1].error_message, rows[2].status) == ("failed", "abandoned", "succeeded")


def test_state_changed_meanwhile_is_not_overwritten(built):
    log, table, _ = built
    before = table.current()
    shadow = table.write_shadow(fold.fold_pages(log))
    table.upsert(table.read().filter("page_title = 'p1'").withColumn("edit_count", F.lit(0).cast("bigint")))
    with pytest.raises(RuntimeError, match="changed"):
        table.swap_in(shadow, before)


def test_status_shows_progress_while_running(built):
    log, table, rebuild = built
    seen = []

    def watch():
        until = time.monotonic() + 100
        while time.monotonic() < until and (not seen or seen[-1] is None or seen[-1] < 1):
            row = rebuild.status().first()
            seen.append(row and row.progress)

    watcher = threading.Thread(target=watch, daemon=True)
    slow = log.repartition(40).withColumn("editor", F.expr("if(java_method('java.lang.Thread', 'sleep', 20L) is null, editor, '')"))
    watcher.start()
    rebuild.run(slow)
    watcher.join(120)
    assert any(share and 0 < share < 1 for share in seen)
    assert rebuild.status().first().progress == 1.0


def test_late_copies_with_lower_numbers(built, spark, shared):
    """A later delivery with a lower number and other contents: the stream has taken the earlier one."""
    _, table, rebuild = built
    logs = EventLogs(spark, shared + "/late")
    for batch, (seq, editor) in enumerate([(10, "late"), (3, "early")]):
        record = raw(spark, [text(user=editor)]).withColumn("ingest_seq", F.lit(seq).cast("bigint"))
        logs.write_batch(validate.classify(record), "run", batch, F.lit("2026-01-01"))
    state = PageStateTable(spark, shared + "/late_state", buckets=2)
    state.upsert(fold.fold_pages(logs.valid().filter("first_arrival")))
    before = snapshot(state)
    outcome = Rebuild(RebuildLog(spark, shared + "/late"), state).run(logs.valid())
    assert (outcome["status"], outcome["discrepancy_count"], outcome["events_replayed"]) == ("succeeded", 0, 2)
    assert snapshot(state) == before and before[0].last_editor == "late"


def test_unknown_status_is_refused(spark, shared):
    with pytest.raises(ValueError):
        RebuildLog(spark, shared).append(1, 0, "done", datetime.now(timezone.utc))


def test_progress_is_a_share(spark):
    frame = spark.createDataFrame([(5, 10), (20, 10), (0, 0), (3, None)], "p bigint, t bigint")
    assert [r[0] for r in frame.select(audit.progress(F.col("p"), F.col("t"))).collect()] == [0.5, 1.0, 0.0, 0.0]


def test_lookup_reads_one_bucket(built):
    _, table, _ = built
    found = table.lookup("enwiki", "p4")
    assert fold_rows(found) == {k: v for k, v in fold_rows(table.read()).items() if k == "p4"}
    assert {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()} < {"0", "1", "2", "3"}
    assert table.lookup("enwiki", "unknown").isEmpty()


def test_upsert_leaves_untouched_buckets(built):
    _, table, _ = built
    before = table.current()["versions"]
    one = table.lookup("enwiki", "p4").withColumn("edit_count", F.lit(77).cast("bigint"))
    table.upsert(one)
    after = table.current()["versions"]
    assert sum(before[b] != after[b] for b in before) == 1
    assert table.lookup("enwiki", "p4").first().edit_count == 77
    assert table.read().count() == 9


def test_superseded_versions_are_removed(built):
    log, table, _ = built
    before = snapshot(table)
    table.upsert(table.read())
    assert table.remove_superseded() == 0
    assert table.remove_superseded(older_than_seconds=0) == 1
    assert snapshot(table) == before


def test_empty_table(spark, shared):
    table = PageStateTable(spark, shared)
    assert table.read().isEmpty() and table.lookup("w", "t").isEmpty()


def test_both_ways_to_count_differences_agree(built):
    _, table, _ = built
    live = table.read()
    other = live.filter("page_title <> 'p0'").withColumn(
        "last_editor", F.when(F.col("page_title") == "p5", None).otherwise(F.col("last_editor"))
    )
    assert compare.discrepancy_count(live, other).first()[0] == compare.differing_keys(live, other).count() == 2
    assert compare.same_rows(live, table.read()) and not compare.same_rows(live, other)
    # NULL equals NULL
    assert compare.discrepancy_count(other, other).first()[0] == 0


def test_state_check_names_the_wrong_column(built):
    _, table, _ = built
    expected = table.read().withColumn("edit_count", F.when(F.col("page_title") == "p1", -1).otherwise(F.col("edit_count")))
    wrong = compare.state_check(table.read(), expected).filter("NOT all_ok").collect()
    assert [(r.page_title, r.edit_count_ok, r.last_editor_ok) for r in wrong] == [("p1", False, True)]
    missing = compare.state_check(table.read().filter("page_title <> 'p1'"), expected).filter("NOT all_ok").first()
    assert (missing.page_title, missing.in_both) == ("p1", False)


def test_of_two_that_take_over_one_wins(spark, shared):
    crashed = RebuildLog(spark, shared)
    assert crashed.try_lock()
    contenders = [RebuildLog(spark, shared, stale_after_seconds=0) for _ in range(6)]
    time.sleep(0.01)
    start, won = threading.Barrier(6), []

    def contend(log):
        start.wait()
        if log.try_lock():
            log.stale_after_seconds = 3600
            won.append(log)

    threads = [threading.Thread(target=contend, args=(c,)) for c in contenders]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    holders = [log for log in won if log.refresh()]
    assert len(holders) == 1
    # whoever lost the lock gives nothing back
    crashed.unlock()
    assert not crashed.refresh() and holders[0].refresh()
    holders[0].unlock()
    assert not files.exists(spark, crashed.lock_path)


def test_a_long_rebuild_keeps_its_lock(spark, shared):
    running = RebuildLog(spark, shared, stale_after_seconds=1.0)
    other = RebuildLog(spark, shared, stale_after_seconds=1.0)
    assert running.try_lock()
    with running.kept_alive():
        for _ in range(8):
            time.sleep(0.25)
            assert not other.try_lock() and running.is_locked()
    time.sleep(1.2)
    assert other.try_lock() and not running.refresh()


def test_a_running_shadow_is_spared(built, shared):
    log, table, rebuild = built
    shadow = table.write_shadow(fold.fold_pages(log))
    assert rebuild.log.try_lock()
    assert table.remove_superseded(older_than_seconds=0, log=rebuild.log) == 0
    table.swap_in(shadow, table.current())
    rebuild.log.unlock()
