"""The fold against plain Python, under repetition, reordering and skew."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirefold.operators import dedup, fold
from quirefold.schemas import FOLD_KEY, LEDGER_KEY
from support import at, fold_by_hand, fold_rows, valid

HOT = [(i, "hot", 1000 + i % 400, f"e{i % 37}", i % 11 - 5, (i * 7919) % 1000) for i in range(600)]
COLD = [(600 + i, f"p{i % 50}", i, f"e{i % 7}", i % 13 - 6, (i * 31) % 500) for i in range(300)]

ROWS = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c/d"]), st.integers(1, 9), st.sampled_from(["x", "y"]), st.integers(-9, 9), st.integers(0, 5)),
    min_size=1,
    max_size=25,
)


def test_fold_equals_plain_python(spark):
    rows = HOT + COLD
    assert fold_rows(fold.fold_pages(valid(spark, rows))) == fold_by_hand(rows)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, seed=st.integers(0, 99))
def test_order_and_repetition_do_not_matter(spark, rows, seed):
    # one payload per revision and page, as copies of one event have
    once = {(t, r): (t, r, e, d, s) for t, r, e, d, s in rows}
    base = [(i, *row) for i, row in enumerate(once.values())]
    shuffled = [row for row in once.values() for _ in range(3)]
    random.Random(seed).shuffle(shuffled)
    again = [(i, *row) for i, row in enumerate(shuffled)]
    expected = fold_by_hand(base)
    assert fold_rows(fold.fold_pages(valid(spark, base))) == expected
    assert fold_rows(fold.fold_pages(valid(spark, again))) == expected


def test_first_arrival_wins_when_copies_differ(spark):
    rows = [(5, "a", 1, "late", 50, 9), (2, "a", 1, "early", 20, 3)]
    assert fold_rows(fold.fold_pages(valid(spark, rows))) == {"a": (3, 3, 1, 20, 1, "early")}


def test_revision_breaks_time_ties(spark):
    rows = [(1, "a", 2, "second", 0, 5), (2, "a", 1, "first", 0, 5)]
    assert fold_rows(fold.fold_pages(valid(spark, rows)))["a"][-1] == "second"


def test_two_identities_of_an_event(spark):
    moved = valid(spark, [(1, "old title", 7, "ann", 1, 0), (2, "new title", 7, "ann", 1, 0)])
    assert dedup.first_arrival(moved, LEDGER_KEY).select("page_title").collect() == [("old title",)]
    assert fold.fold_pages(moved).agg(F.sum("edit_count")).first()[0] == 2
    assert dedup.first_arrival(moved, FOLD_KEY).count() == 2


def changelog_by_hand(rows):
    out, seen = [], []
    for row in sorted(rows):
        if (row[1], row[2]) in {(r[1], r[2]) for r in seen}:
            continue
        seen.append(row)
        out.append((row[0], row[1], row[2], *fold_by_hand([r for r in seen if r[1] == row[1]])[row[1]]))
    return out


def test_changelog_equals_plain_python_at_any_slice_size(spark):
    rows = HOT[:150] + HOT[390:430] + COLD[:60]
    expected = changelog_by_hand(rows)
    for size in (1, 7, 40, 10_000):
        log = fold.changelog(valid(spark, rows), max_rows_per_task=size).orderBy("ingest_seq")
        epoch = "CAST(unix_seconds({}) - 1767225600 AS int)"
        got = log.selectExpr(
            "ingest_seq",
            "page_title",
            "revision_id",
            epoch.format("created_at"),
            epoch.format("last_edited_at"),
            "edit_count",
            "net_byte_delta",
            "unique_editors",
            "last_editor",
        ).collect()
        assert [tuple(r) for r in got] == expected, size


def test_last_change_of_a_page_is_its_state(spark):
    events = valid(spark, HOT + COLD)
    last = fold.changelog(events, max_rows_per_task=50).groupBy("wiki", "page_title").agg(F.max_by(F.struct("*"), "ingest_seq").alias("l"))
    assert fold_rows(last.select("l.*")) == fold_rows(fold.fold_pages(events))


def test_upsert_replaces_and_adds(spark):
    shape = "wiki string, page_title string, n int"
    current = spark.createDataFrame([("w", "a", 1), ("w", "b", 1)], shape)
    updates = spark.createDataFrame([("w", "b", 2), ("w", "c", 2)], shape)
    got = dedup.upsert(current, updates, ["wiki", "page_title"])
    assert sorted(tuple(r) for r in got.collect()) == [("w", "a", 1), ("w", "b", 2), ("w", "c", 2)]


def test_instants_of_support_are_utc():
    assert at(0).isoformat() == "2026-01-01T00:00:00+00:00"
