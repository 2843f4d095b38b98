"""Read queries, and the shape of the plans that matter at scale."""

import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from quirefold.operators import dedup, fold, ingest, reads, validate
from quirefold.plans.queries import QUERIES
from quirefold.schemas import LEDGER_KEY
from quirefold.sinks import event_logs
from quirefold.sources.testdata import events_table, raw_events
from support import valid

SF_DIR = "/root/testdata/sf0.001"
ROWS = [(i, f"p{i % 3}", i, f"e{i % 4}", 1, i % 5) for i in range(30)]


@pytest.fixture()
def tables(spark, shared):
    """page_events and page_state as stored tables; one event per second is taken in."""
    log = valid(spark, ROWS)
    events = validate.to_page_events(
        dedup.first_arrival(log, LEDGER_KEY), F.timestamp_seconds(1_767_225_600 + F.col("ingest_seq") * 10)
    )
    events.write.parquet(shared + "/e")
    fold.fold_pages(log).write.parquet(shared + "/s")
    return spark.read.parquet(shared + "/e"), spark.read.parquet(shared + "/s")


def plan(frame, adaptive=False) -> str:
    """The physical plan before any of it runs."""
    frame.sparkSession.conf.set("spark.sql.adaptive.enabled", str(adaptive).lower())
    try:
        return frame._jdf.queryExecution().executedPlan().toString()
    finally:
        frame.sparkSession.conf.unset("spark.sql.adaptive.enabled")


def test_recency_is_strict(tables):
    events, state = tables
    asof = datetime(2026, 1, 1, 0, 4, 50, tzinfo=timezone.utc)  # the last event's time
    # taken in at 230 s lies exactly one minute back and does not count
    assert reads.events_per_minute(events, asof).first()[0] == 6
    assert tuple(reads.stats(events, state, asof).first()) == (6, 3, 4, 30)
    assert reads.events_per_minute(events).first()[0] == 0


def test_stats_of_empty_tables(tables):
    events, state = tables
    assert tuple(reads.stats(events.limit(0), state.limit(0)).first()) == (0, 0, 0, 0)


def test_feed_and_leaderboard(tables):
    events, state = tables
    times = [r.ingested_at for r in reads.feed(events).collect()]
    assert len(times) == 15 and times == sorted(times, reverse=True)
    board = reads.leaderboard(state, 2).collect()
    assert [r.page_title for r in board] == ["p0", "p1"]  # equal times, so by key


@pytest.mark.parametrize("limit", [0, -1, 101, 1000])
def test_limits(tables, limit):
    with pytest.raises(ValueError):
        reads.feed(tables[0], limit)
    if limit != 101:
        with pytest.raises(ValueError):
            reads.leaderboard(tables[1], limit)


def test_history(tables):
    events, state = tables
    rows = reads.page_history(events, "enwiki", "p1").collect()
    assert len(rows) == 10 and [r.occurred_at for r in rows] == sorted(r.occurred_at for r in rows)
    assert reads.page_history(events, "dewiki", "p1").isEmpty()
    assert reads.page_current(state, "enwiki", "unknown").isEmpty()
    # a page without state keeps its events
    joined = reads.history_with_state(events, state.filter("page_title <> 'p1'"))
    assert joined.count() == 30 and joined.filter("edit_count IS NULL").count() == 10


def test_exists(tables):
    assert reads.exists(tables[0].filter("editor = 'e1'")) and not reads.exists(tables[0].filter("editor = 'x'"))


def test_no_query_runs_python_per_row(spark):
    for name, query in QUERIES.items():
        if name.startswith("stream") or name == "rebuild":
            continue
        text = plan(query(spark, SF_DIR))
        assert not re.search("Python|ArrowEval|CartesianProduct|BroadcastNestedLoopJoin", text), name


def test_a_record_is_parsed_once(spark):
    for name in ("valid_events", "page_state", "ledger_dedup", "changelog", "replay_pacing"):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert len(re.findall(r"parseJson\(concat\(\[", text)) == 1, name


def test_validation_does_not_shuffle(spark):
    raw = spark.createDataFrame([], "ingest_seq bigint, value string")
    assert "Exchange" not in plan(validate.valid_events(validate.classify(raw)))
    assert "Exchange" not in plan(ingest.to_raw_log(ingest.accept(raw)))


def test_fold_spreads_a_page_before_it_meets(spark):
    text = plan(fold.fold_pages(valid(spark, ROWS)))
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text)
    names = [re.sub(r"#\d+L?", "", key) for key in keys]
    assert names == ["wiki, page_title", "wiki, page_title, editor", "wiki, page_title, revision_id"]
    # each shuffle is fed by a partial aggregate
    assert all(re.search("partial_", text.split("Exchange hash")[i + 1]) for i in range(3))


def test_generated_code_stays_small_enough_to_be_compiled(spark, capsys):
    """The JVM leaves methods over 8000 bytes of byte code uncompiled, which is many times slower."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        validate.valid_events(validate.classify(raw_events(spark, SF_DIR))).explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_top_rows_need_no_full_sort(tables):
    assert "TakeOrderedAndProject" in plan(reads.feed(tables[0]))
    assert "TakeOrderedAndProject" in plan(reads.leaderboard(tables[1]))


def test_lookups_reach_the_scan(tables):
    text = plan(reads.page_history(tables[0], "enwiki", "p1"))
    assert "EqualTo(page_title,p1)" in text and "EqualTo(wiki,enwiki)" in text
    scan = re.search("ReadSchema: (.*)", plan(reads.editors_seen(tables[0]))).group(1)
    assert scan.startswith("struct<editor:string>")


def test_a_hot_page_is_spread(spark):
    """A third of all events on one page: no task of the fold gets more than its share."""
    rows = spark.range(60_000).selectExpr(
        "id AS ingest_seq",
        "'enwiki' AS wiki",
        "if(id % 3 = 0, 'hot', concat('p', id % 5000)) AS page_title",
        "id AS revision_id",
        "concat('e', id % 9000) AS editor",
        "1 AS byte_delta",
        "timestamp_seconds(id) AS occurred_ts",
    )
    spread = dedup.first_arrival(rows, ["wiki", "page_title", "revision_id"]).groupBy(F.spark_partition_id()).count()
    assert spread.agg(F.max("count")).first()[0] < 60_000 / 8 * 1.3
    hot = fold.fold_pages(rows).filter("page_title = 'hot'").first()
    assert (hot.edit_count, hot.net_byte_delta, hot.unique_editors) == (20_000, 20_000, 3000)
    log = fold.changelog(rows, max_rows_per_task=2000)
    sizes = log.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < 20_000
    last = log.filter("page_title = 'hot'").agg(F.max_by(F.struct("*"), "ingest_seq").alias("l")).first().l
    assert (last.edit_count, last.net_byte_delta, last.unique_editors) == (20_000, 20_000, 3000)


def hot_rows(spark, n=60_000):
    return spark.range(n).selectExpr(
        "id AS ingest_seq",
        "'enwiki' AS wiki",
        "if(id % 3 = 0, 'hot', concat('p', id % 5000)) AS page_title",
        "'PageEdited' AS event_type",
        "id AS revision_id",
        "concat('e', id % 9000) AS editor",
        "1 AS byte_delta",
        "timestamp_seconds(id) AS occurred_ts",
        "timestamp_seconds(id) AS occurred_at",
    )


def test_a_hot_page_is_spread_at_the_changelogs_window(spark):
    rows = hot_rows(spark)
    dealt = fold.in_slices(rows, 2000)
    assert dealt.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 20_000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(fold.changelog(rows, max_rows_per_task=2000))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    windows = re.findall(r"windowspecdefinition\(([^)]*?), ingest_seq#", text)
    assert windows and all("_slice" in w for w in windows)
    assert re.search(r"hashpartitioning\(wiki#\d+, page_title#\d+, _slice#", text)


def test_a_hot_pages_events_stay_where_they_lie(spark):
    rows = hot_rows(spark)
    state = fold.fold_pages(rows)
    joined = reads.history_with_state(rows, state, hot_edits=1000)
    assert joined.count() == 60_000
    hot = joined.filter("page_title = 'hot'")
    assert hot.filter("edit_count = 20000").count() == 20_000
    sizes = hot.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < 20_000 / 3
    unknown = reads.history_with_state(rows, state.filter("page_title <> 'p1'"), hot_edits=1000)
    assert unknown.filter("edit_count IS NULL").count() == rows.filter("page_title = 'p1'").count() > 0


def test_pacing_does_not_depend_on_slices_or_blocks(spark):
    rows = spark.range(500).selectExpr(
        "id * 3 AS ingest_seq", "if(id % 7 = 0 OR id BETWEEN 100 AND 160, NULL, id * 0.7 + (id % 5)) AS epoch_seconds"
    )
    whole = sorted(map(tuple, ingest.replay_schedule(rows).collect()))
    for per_slice, per_block in ((7, 1), (10, 3), (1, 50)):
        cut = ingest.replay_schedule(rows, rows_per_slice=per_slice, slices_per_block=per_block)
        assert sorted(map(tuple, cut.collect())) == whole
    # the one window without a partition has a row per block
    text = plan(ingest.replay_schedule(rows, rows_per_slice=7))
    assert all("_block" in order for order in re.findall(r"windowspecdefinition\((\w+)#\d+L? ASC", text))


def test_a_delivery_that_fails_is_counted(spark, shared):
    value = '{"type":"edit","server_name":"en.wikipedia.org","bot":false}'
    records = spark.createDataFrame([(1, value), (2, "{}"), (3, "no JSON"), (4, value)], "ingest_seq bigint, value string")
    path = f"{shared}/raw"
    event_logs.publish_counted(records, path)
    broken = records.withColumn("ingest_seq", F.when(F.col("ingest_seq") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("ingest_seq")))
    with pytest.raises(Exception, match="lost"):
        event_logs.publish_counted(broken, path)
    found = event_logs.published_counts(spark, path).orderBy("delivery").drop("published_at").collect()
    assert [tuple(r) for r in found] == [(1, 3, 2, 2, 0), (2, 3, 2, 0, 2)]


def test_records_are_dealt_over_the_tasks_whatever_row_groups_they_lie_in(spark, shared):
    """A file of one row group and many splits, which one task reads; half of its ids are null."""
    n = 20_000
    rows = spark.range(n).selectExpr(
        "if(id % 2 = 0, NULL, id) AS event_id",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts",
        "id % 50 AS user_id",
        "'view' AS event_type",
        "id / 100 AS value",
        "concat('{\"k\": ', id % 7, '}') AS props",
    )
    rows.coalesce(1).write.parquet(f"{shared}/events.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        table = events_table(spark, shared)
        assert table.rdd.getNumPartitions() > 8
        assert table.groupBy(F.spark_partition_id()).count().count() == 1
        dealt = raw_events(spark, shared).groupBy(F.spark_partition_id()).count().agg(F.sum("count"), F.max("count")).first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert dealt[0] == n + n // 10 and dealt[1] < n / 8 * 1.3
