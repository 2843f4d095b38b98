"""Stream 2: valid log to page_state, as keyed state that is kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import PAGE_KEY
from ..sinks.page_state import PageStateTable
from .validate_stream import triggered

# state on local disk instead of the heap, and checkpoints that hold a trigger's changes only
STATE_OPTIONS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def fold_stream(valid: DataFrame) -> DataFrame:
    """Running page state over a stream of valid events; each trigger gives the pages it changed.

    Each event is looked at as two facts, 'this revision of the page' and 'this editor of the
    page'. One deduplication lets every fact through once, and one aggregate per page adds them
    up: revisions carry the counts, editors carry one each. So no state row grows with a page's
    history, and the facts of a page with very many events are spread over all state partitions.

    No watermark: late events always count, so the deduplication state is kept forever.
    Events from our own valid log carry ``first_arrival``, which settles which copy of a revision
    counts even if copies within one trigger differ.
    """
    if "first_arrival" in valid.columns:
        valid = valid.filter("first_arrival")
    nothing = F.lit(0).cast("bigint")
    revision = F.struct(
        F.lit("revision").alias("fact"),
        F.col("revision_id").cast("string").alias("item"),
        F.lit(1).cast("bigint").alias("edits"),
        F.col("byte_delta").cast("bigint").alias("delta"),
        nothing.alias("editors"),
        F.struct("occurred_ts", "revision_id", "editor").alias("edit"),
    )
    editor = F.struct(
        F.lit("editor").alias("fact"),
        F.col("editor").alias("item"),
        nothing.alias("edits"),
        nothing.alias("delta"),
        F.lit(1).cast("bigint").alias("editors"),
        F.lit(None).cast("struct<occurred_ts:timestamp,revision_id:bigint,editor:string>").alias("edit"),
    )
    facts = valid.select(*PAGE_KEY, F.inline(F.array(revision, editor)))
    return (
        facts.dropDuplicates([*PAGE_KEY, "fact", "item"])
        .groupBy(*PAGE_KEY)
        .agg(
            F.min("edit.occurred_ts").alias("created_at"),
            F.max("edit").alias("last_edit"),
            F.sum("edits").alias("edit_count"),
            F.sum("delta").alias("net_byte_delta"),
            F.sum("editors").alias("unique_editors"),
        )
        .select(
            *PAGE_KEY,
            "created_at",
            F.col("last_edit.occurred_ts").alias("last_edited_at"),
            "edit_count",
            "net_byte_delta",
            "unique_editors",
            F.col("last_edit.editor").alias("last_editor"),
            F.lit(False).alias("is_deleted"),
        )
    )


def start_fold(
    spark: SparkSession, valid: DataFrame, target: PageStateTable, checkpoint: str, drain: bool = False
) -> StreamingQuery:
    """Start the fold into a page_state table. A fresh checkpoint folds from the earliest event."""
    for option, value in STATE_OPTIONS.items():
        spark.conf.set(option, value)

    def write(batch: DataFrame, batch_id: int) -> None:
        target.upsert(batch)

    writer = fold_stream(valid).writeStream.outputMode("update").foreachBatch(write)
    return triggered(writer.option("checkpointLocation", checkpoint), drain).start()
