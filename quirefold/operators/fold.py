"""The page fold: event log to one current-state row per page."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import FOLD_KEY, PAGE_KEY, PAGE_STATE
from .dedup import first_arrival


def fold_pages(valid: DataFrame) -> DataFrame:
    """Fold valid events into page state.

    Three shuffles, each on a finer key than the last one needs: revisions of a page, editors
    of a page, then pages. Every step is reduced before its shuffle, so a page with a large
    part of all events is spread by revision, then by editor, and meets in one task only as
    one partial row per task.
    """
    needed = valid.select("ingest_seq", *FOLD_KEY, "editor", "byte_delta", "occurred_ts")
    return fold_distinct(first_arrival(needed, FOLD_KEY))


def fold_distinct(events: DataFrame) -> DataFrame:
    """Fold events that hold each revision of a page once."""
    per_editor = events.groupBy(*PAGE_KEY, "editor").agg(
        F.count("*").alias("edits"),
        F.sum("byte_delta").alias("delta"),
        F.min("occurred_ts").alias("first_edit"),
        F.max(F.struct("occurred_ts", "revision_id")).alias("last_edit"),
    )
    return (
        per_editor.groupBy(*PAGE_KEY)
        .agg(
            F.min("first_edit").alias("created_at"),
            F.max("last_edit.occurred_ts").alias("last_edited_at"),
            F.sum("edits").alias("edit_count"),
            F.sum("delta").alias("net_byte_delta"),
            F.count("*").alias("unique_editors"),
            F.max_by("editor", "last_edit").alias("last_editor"),
        )
        .withColumn("is_deleted", F.lit(False))
        .select(*PAGE_STATE.fieldNames())
    )


def fold_accepted_by_title(accepted_valid: DataFrame) -> DataFrame:
    """Cross-check fold of a raw sample: per title alone and without deduplication."""
    by_title = accepted_valid.select(
        F.lit("").alias("wiki"), "page_title", "revision_id", "editor", "byte_delta", "occurred_ts"
    )
    return fold_distinct(by_title).drop("wiki", "is_deleted")


def changelog(valid: DataFrame, max_rows_per_task: int = 1_000_000) -> DataFrame:
    """The state of the page after each applied event, in order of arrival.

    A running aggregate needs a page's events in order. Every page is cut into slices of
    ``max_rows_per_task`` arrival numbers: the running values are taken within each slice, and the totals of
    the page's earlier slices are added on. Events are dealt by page and slice alone, so a page with any
    share of them is spread; by page only the totals meet, one row a slice.
    """
    if max_rows_per_task < 1:
        raise ValueError("max_rows_per_task must be positive")
    needed = valid.select("ingest_seq", *FOLD_KEY, "editor", "byte_delta", "occurred_ts")
    # true of every valid event; said here so that no join below filters one of its sides alone,
    # which would keep the plan from reading a shuffle twice
    events = first_arrival(needed.filter("wiki IS NOT NULL AND page_title IS NOT NULL"), FOLD_KEY)

    # The first event of each editor on each page, found by an aggregate and not by a window
    # over the editor's events; it joins in as a row of its own with the same sequence. Every
    # branch below uses all columns of what it shares with another, so that the plan reads each
    # shuffle again instead of doing it again.
    per_editor = events.groupBy(*PAGE_KEY, "editor").agg(
        F.min("ingest_seq").alias("ingest_seq"), F.count("*").alias("_rows")
    )
    debut = per_editor.select(*PAGE_KEY, "ingest_seq", F.when(F.col("_rows") > 0, 1).alias("_new"))
    edit = F.struct("occurred_ts", "revision_id", "editor").alias("_edit")
    applied = events.select(*PAGE_KEY, "ingest_seq", "byte_delta", edit, F.lit(0).alias("_new"))
    marked = applied.unionByName(debut, allowMissingColumns=True)

    # dealt once, for the running values and for the totals
    cut = in_slices(marked, max_rows_per_task)

    # a range frame: the event and its debut row share a sequence and count as one position
    in_slice = Window.partitionBy(*PAGE_KEY, "_slice").orderBy("ingest_seq")
    running = in_slice.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    is_event = F.col("_new") == 0
    measures = {
        "edit_count": F.sum(F.when(is_event, 1).otherwise(0)),
        "net_byte_delta": F.sum("byte_delta"),
        "unique_editors": F.sum("_new"),
        "created_at": F.min("_edit.occurred_ts"),
        "_last": F.max("_edit"),
    }
    values = [measure.over(running).alias(name) for name, measure in measures.items()]
    local = cut.select("ingest_seq", *PAGE_KEY, "_slice", "_new", "_edit", *values).filter(is_event)

    totals = cut.groupBy(*PAGE_KEY, "_slice").agg(*(measure.alias(name) for name, measure in measures.items()))
    earlier = Window.partitionBy(*PAGE_KEY).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *PAGE_KEY,
        "_slice",
        F.sum("edit_count").over(earlier).alias("c_edits"),
        F.sum("net_byte_delta").over(earlier).alias("c_delta"),
        F.sum("unique_editors").over(earlier).alias("c_editors"),
        F.min("created_at").over(earlier).alias("c_created"),
        F.max("_last").over(earlier).alias("c_last"),
    )
    zero = F.lit(0)
    return (
        local.join(carried, [*PAGE_KEY, "_slice"], "left")
        .withColumn("_last", F.greatest("_last", "c_last"))
        .select(
            "ingest_seq",
            *PAGE_KEY,
            F.col("_edit.revision_id").alias("revision_id"),
            F.least("created_at", "c_created").alias("created_at"),
            F.col("_last.occurred_ts").alias("last_edited_at"),
            (F.col("edit_count") + F.coalesce("c_edits", zero)).alias("edit_count"),
            (F.col("net_byte_delta") + F.coalesce("c_delta", zero)).alias("net_byte_delta"),
            (F.col("unique_editors") + F.coalesce("c_editors", zero)).alias("unique_editors"),
            F.col("_last.editor").alias("last_editor"),
            F.lit(False).alias("is_deleted"),
        )
    )


def in_slices(rows: DataFrame, rows_per_slice: int) -> DataFrame:
    """Rows with their ``_slice`` of arrival numbers, dealt by page and slice."""
    cut = rows.withColumn("_slice", F.expr(f"ingest_seq div {rows_per_slice}"))
    # a number of partitions, else small ones are merged and a page's slices meet again
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut.repartition(tasks, *PAGE_KEY, "_slice")
