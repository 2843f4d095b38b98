"""Readers of captured event files, of the raw and valid logs, and of message topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import json_checks as J
from ..schemas import RAW, VALID_STORED


# --- captured files ---------------------------------------------------------------
def jsonl_records(spark: SparkSession, path: str) -> DataFrame:
    """``value`` of each line of JSON text files; blank and unparseable lines are skipped."""
    return only_json(spark.read.text(path))


def only_json(lines: DataFrame) -> DataFrame:
    """Lines trimmed, without blank ones and those that are not JSON."""
    return _keep_json(lines.withColumn("value", F.trim("value")))


def _keep_json(records: DataFrame) -> DataFrame:
    kept = [c for c in records.columns if c != "value"]
    checked = F.struct(F.col("value"), J.is_single_value(F.col("_v"), F.col("value")).alias("_ok"))
    return (
        records.filter("value <> ''")
        .select(*kept, "value", J.parse_wrapped(F.col("value")).alias("_v"))
        .select(*kept, F.inline(F.array(checked)))
        .filter("_ok")
        .drop("_ok")
    )


def sse_frames(spark: SparkSession, path: str) -> DataFrame:
    """Frames of captured server-sent-event text: a blank line ends a frame.

    The blank line is the record separator of the reader, so a large capture is still read
    in splits.
    """
    return spark.read.option("lineSep", "\n\n").text(path).withColumnRenamed("value", "frame")


def sse_events(frames: DataFrame) -> DataFrame:
    """``event_id, value`` of each frame whose data is JSON, with the frame's other columns."""
    lines = F.split("frame", "\n", -1)
    kept = [c for c in frames.columns if c != "frame"]
    payload = F.array_join(_field_lines(lines, "data:", F.ltrim), "\n")
    ids = _field_lines(lines, "id:", F.trim)
    events = frames.select(*kept, F.try_element_at(ids, F.lit(-1)).alias("event_id"), payload.alias("value"))
    return _keep_json(events)


def _field_lines(lines: Column, prefix: str, strip) -> Column:
    """What follows ``prefix`` on the lines that start with it."""
    of_field = F.filter(lines, lambda line: F.startswith(line, F.lit(prefix)))
    return F.transform(of_field, lambda line: strip(F.substring(line, len(prefix) + 1, 2147483647)))


def last_event_id(events: DataFrame, order: str) -> DataFrame:
    """One row: the id to resume a stream from, that of the last frame that has one."""
    numbered = events.filter("event_id IS NOT NULL")
    return numbered.agg(F.max_by("event_id", order).alias("last_event_id"))


def with_ingest_seq(records: DataFrame, start: int = 0) -> DataFrame:
    """Number records for publishing: unique, rising along each file, with gaps.

    The numbers are fixed only once written; publish before folding.
    """
    return records.withColumn("ingest_seq", F.monotonically_increasing_id() + F.lit(start).cast("bigint"))


# --- the raw log ------------------------------------------------------------------
def raw_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW).parquet(path)


def raw_log_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The raw log as a stream. It starts at the earliest record, and where its checkpoint
    has one, at the position reached before."""
    reader = spark.readStream.schema(RAW)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def topic_stream(spark: SparkSession, servers: str, topic: str, partitions: int = 1) -> DataFrame:
    """The raw log on a message topic (needs Spark's Kafka connector on the class path)."""
    stream = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )
    position = F.col("offset") * partitions + F.col("partition")
    return stream.select(
        position.cast("bigint").alias("ingest_seq"), F.col("key").cast("string"), F.col("value").cast("string")
    )


# --- the valid log ----------------------------------------------------------------
def valid_log(spark: SparkSession, path: str) -> DataFrame:
    """The whole valid log, from the earliest record."""
    return spark.read.schema(VALID_STORED).parquet(path)


def valid_log_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The valid log as a stream from the earliest record.

    A validation batch that is repeated replaces its files; a file that went away in between
    has its events in the new ones.
    """
    reader = spark.readStream.schema(VALID_STORED).option("ignoreMissingFiles", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def first_match(log: DataFrame, predicate: Column) -> DataFrame:
    """The earliest record that satisfies the predicate, if there is one."""
    return log.filter(predicate).orderBy("ingest_seq").limit(1)


def table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table with a known schema."""
    return spark.read.schema(schema).parquet(path)
