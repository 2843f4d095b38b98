"""Stream 1: raw log to valid log, dead-letter log and page_events ledger."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.validate import classify
from ..sinks import files
from ..sinks.event_logs import EventLogs

TRIGGER_INTERVAL = "10 seconds"


def start_validation(
    spark: SparkSession, raw: DataFrame, logs: EventLogs, checkpoint: str, drain: bool = False
) -> StreamingQuery:
    """Start the validation stream. It goes on where its checkpoint stands.

    ``drain`` processes what the raw log holds now and stops.
    """
    run_id = _run_id(spark, checkpoint)
    logs.index_missing()

    def write(batch: DataFrame, batch_id: int) -> None:
        # one parse for the three outputs; a lost block is computed again from the source
        classified = classify(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            logs.write_batch(classified, run_id, batch_id, F.current_timestamp())
        finally:
            classified.unpersist()

    writer = raw.select("ingest_seq", "value").writeStream.foreachBatch(write)
    return triggered(writer.option("checkpointLocation", checkpoint), drain).start()


def triggered(writer, drain: bool):
    return writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=TRIGGER_INTERVAL)


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    """An id kept with the checkpoint: batch numbers start over with a new checkpoint, and must
    not hit the directories of an earlier one."""
    path = f"{checkpoint.rstrip('/')}/run_id"
    files.create_new(spark, path, uuid.uuid4().hex)
    return files.read_text(spark, path)
