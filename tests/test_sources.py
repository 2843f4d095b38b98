"""Readers of captured files and logs."""

import pytest
from pyspark.sql import functions as F

from quirefold import session
from quirefold.operators import ingest
from quirefold.schemas import VALID
from quirefold.sinks import files
from quirefold.sinks.event_logs import append_raw_log
from quirefold.sources import logs
from support import raw, text


def test_jsonl_skips_blank_and_broken_lines(spark, tmp_path):
    (tmp_path / "sample.jsonl").write_text('{"a":1}\n\n   \n{"a":\n [2] \nnull\n{"r":1} x\n')
    got = logs.jsonl_records(spark, str(tmp_path)).collect()
    assert sorted(r.value for r in got) == ["[2]", "null", '{"a":1}']


def test_sse_frames(spark, tmp_path):
    (tmp_path / "capture.txt").write_text(
        ':ok\n\nevent: message\nid: 1\ndata: {"a":1}\n\n'  # one line
        'id:  2 \ndata: {"a":\ndata:   2}\n\n'  # two data lines
        "id: 3\n\n"  # no data
        "data: {broken\n\n"  # bad JSON
        '\n\ndata:{"a":"x: y"}\n\n'  # blank lines before, no space after the colon
    )
    got = logs.sse_events(logs.sse_frames(spark, str(tmp_path))).collect()
    assert sorted((r.event_id or "", r.value) for r in got) == [("", '{"a":"x: y"}'), ("1", '{"a":1}'), ("2", '{"a":\n2}')]


def test_last_event_id(spark):
    events = spark.createDataFrame([(1, "a"), (3, None), (2, "b")], "seq int, event_id string")
    assert logs.last_event_id(events, "seq").first()[0] == "b"


def test_published_records_keep_their_number(spark, shared):
    numbered = logs.with_ingest_seq(raw(spark, [text(title=f"t{i}") for i in range(50)]).select("value"), start=100)
    append_raw_log(ingest.to_raw_log(ingest.accept(numbered)), shared + "/raw")
    log = logs.raw_log(spark, shared + "/raw")
    assert log.columns == ["ingest_seq", "key", "value"]
    assert log.select("ingest_seq").distinct().count() == 50
    assert log.agg(F.min("ingest_seq")).first()[0] == 100
    assert log.sort("ingest_seq").collect() == logs.raw_log(spark, shared + "/raw").sort("ingest_seq").collect()


def test_first_match(spark):
    log = raw(spark, ["x", "marker y", "z", "marker"])
    latest_first = log.repartition(1).sortWithinPartitions(F.desc("ingest_seq"))
    assert logs.first_match(latest_first, F.col("value").contains("marker")).first().ingest_seq == 1
    assert logs.first_match(log, F.col("value") == "none").isEmpty()


def test_table_reads_a_known_schema(spark, shared):
    spark.createDataFrame([], VALID).write.parquet(shared + "/t")
    assert logs.table(spark, shared + "/t", VALID).schema == VALID


def test_shared_dir_is_the_sessions(spark):
    assert session.shared_dir(spark) == spark.conf.get(session.CHECKPOINT_DIR)
    assert session.new_run_dir(spark, "x") != session.new_run_dir(spark, "x")


def test_session_must_be_configured(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(RuntimeError, match="timeZone"):
            ingest.accept(raw(spark, [text()]))
    finally:
        session.configure(spark)


def test_small_files(spark, shared):
    path = shared + "/pointer"
    assert files.create_new(spark, path, "one")
    assert not files.create_new(spark, path, "two")
    assert files.read_text(spark, path) == "one"
    files.replace_text(spark, path, "zwö")
    assert files.read_text(spark, path) == "zwö"
    files.delete(spark, path)
    assert not files.exists(spark, path)


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        logs.topic_stream(spark, "nowhere:9092", "raw")
