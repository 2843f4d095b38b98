"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

PAGE_KEY = ["wiki", "page_title"]
FOLD_KEY = ["wiki", "page_title", "revision_id"]
LEDGER_KEY = ["wiki", "revision_id"]

RAW = T.StructType(
    [
        T.StructField("ingest_seq", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

# occurred_at is the text as received, occurred_ts the instant it denotes
VALID = T.StructType(
    [
        T.StructField("ingest_seq", T.LongType()),
        T.StructField("wiki", T.StringType()),
        T.StructField("page_title", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("revision_id", T.LongType()),
        T.StructField("editor", T.StringType()),
        T.StructField("byte_delta", T.IntegerType()),
        T.StructField("occurred_at", T.StringType()),
        T.StructField("occurred_ts", T.TimestampType()),
    ]
)
VALID_FIELDS = ["wiki", "page_title", "event_type", "revision_id", "editor", "byte_delta", "occurred_at"]

DEADLETTER = T.StructType(
    [
        T.StructField("ingest_seq", T.LongType()),
        T.StructField("reason", T.StringType()),
        T.StructField("raw", T.StringType()),
    ]
)

PAGE_EVENTS = T.StructType(
    [
        T.StructField("ingest_seq", T.LongType()),
        T.StructField("wiki", T.StringType()),
        T.StructField("page_title", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("revision_id", T.LongType()),
        T.StructField("editor", T.StringType()),
        T.StructField("byte_delta", T.IntegerType()),
        T.StructField("occurred_at", T.TimestampType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)

PAGE_STATE = T.StructType(
    [
        T.StructField("wiki", T.StringType()),
        T.StructField("page_title", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("last_edited_at", T.TimestampType()),
        T.StructField("edit_count", T.LongType()),
        T.StructField("net_byte_delta", T.LongType()),
        T.StructField("unique_editors", T.LongType()),
        T.StructField("last_editor", T.StringType()),
        T.StructField("is_deleted", T.BooleanType()),
    ]
)

# rows are appended, never updated: the row with the highest step is an attempt's status
REBUILD_LOG = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("step", T.IntegerType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("completed_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("events_replayed", T.LongType()),
        T.StructField("discrepancy_count", T.LongType()),
        T.StructField("error_message", T.StringType()),
    ]
)


def stored_at(schema: T.StructType, *partitions: T.StructField) -> T.StructType:
    """The schema plus the directory columns a table is laid out by."""
    return T.StructType(schema.fields + list(partitions))


RUN_ID = T.StructField("run_id", T.StringType())
BATCH_ID = T.StructField("batch_id", T.LongType())
REV_RANGE = T.StructField("rev_range", T.LongType())
FIRST_ARRIVAL = T.StructField("first_arrival", T.BooleanType())

# the valid log as written: with the mark of the copy that counts in the fold
VALID_STORED = stored_at(VALID, FIRST_ARRIVAL, REV_RANGE, RUN_ID, BATCH_ID)
