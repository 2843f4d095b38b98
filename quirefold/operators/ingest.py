"""The ingest filter, the raw-log record, and the pace of a replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import json_checks as J
from ..session import check_configured

# fixed values of the ingest scope
SERVER_NAME = "en.wikipedia.org"
ACCEPTED_TYPES = ("new", "edit")

MAX_GAP_SECONDS = 10.0


def read_ingest_fields(records: DataFrame, value: str = "value") -> DataFrame:
    """Add the fields the ingest filter, the log key and the pacing need, parsing each record once."""
    check_configured(records.sparkSession)
    v = F.col("_v")
    text = F.col(value)
    usable = J.is_single_value(v, text)
    in_scope = (
        J.is_object(text)
        & F.coalesce(J.json_string(v, "$[0].server_name") == SERVER_NAME, F.lit(False))
        & F.coalesce(J.json_string(v, "$[0].type").isin(*ACCEPTED_TYPES), F.lit(False))
        & J.is_true_false(v, "$[0].bot", False)
    )
    fields = F.struct(
        usable.alias("is_json"),
        (usable & in_scope).alias("accepted"),
        F.concat_ws(
            "/", F.coalesce(J.json_text(v, "$[0].wiki"), F.lit("")), F.coalesce(J.json_text(v, "$[0].title"), F.lit(""))
        ).alias("key"),
        F.when(J.is_number_type(J.json_type(v, "$[0].timestamp")), J.json_double(v, "$[0].timestamp")).alias(
            "epoch_seconds"
        ),
    )
    kept = [c for c in records.columns if c not in ("key", "is_json", "accepted", "epoch_seconds")]
    # inline() keeps a later filter above the parse: pushed below it, the filter would
    # repeat the whole parse in its own condition
    read = records.select(*kept, J.parse_wrapped(text).alias("_v")).select(*kept, fields.alias("_fields"))
    return read.select(*kept, F.inline(F.array("_fields")))


def accept(records: DataFrame, value: str = "value") -> DataFrame:
    """Records in scope: the English Wikipedia server, not a bot, a page creation or edit."""
    return read_ingest_fields(records, value).filter("accepted").drop("is_json", "accepted")


def seen_and_sent(records: DataFrame, value: str = "value") -> DataFrame:
    """One row: records that are JSON (seen) and records in scope (sent)."""
    return read_ingest_fields(records, value).agg(
        F.count_if("is_json").alias("seen"), F.count_if("accepted").alias("sent")
    )


def to_raw_log(accepted: DataFrame) -> DataFrame:
    """Raw-log records: the value verbatim, keyed by page.

    No shuffle: order within a page is carried by ingest_seq, so a page that holds a
    large part of the log still spreads over many files.
    """
    return accepted.select("ingest_seq", "key", "value")


def replay_schedule(
    accepted: DataFrame,
    speed: float = 1.0,
    max_gap: float = MAX_GAP_SECONDS,
    rows_per_slice: int = 1_000_000,
    slices_per_block: int = 10_000,
) -> DataFrame:
    """Pause before each record of a replay and its release time, in microseconds.

    The pause is the gap to the previous record that has an event time, divided by
    ``speed``, if positive, and at most ``max_gap`` seconds. The order is global, so the log
    is cut into slices of ``ingest_seq``; a slice is one task's window. A summary row per slice carries the
    last event time and the elapsed time over, and these again go by blocks of ``slices_per_block``
    slices: only a row per block is put in global order.
    """
    if rows_per_slice < 1 or slices_per_block < 1:
        raise ValueError("rows_per_slice and slices_per_block must be positive")
    in_slice = Window.partitionBy("_slice").orderBy("ingest_seq")
    before = in_slice.rowsBetween(Window.unboundedPreceding, -1)
    upto = in_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    # one shuffle, by slice, which both passes over the records read
    cut = accepted.select(
        "ingest_seq", "epoch_seconds", F.expr(f"ingest_seq div {rows_per_slice}").alias("_slice")
    ).repartition("_slice")
    dated = F.when(F.col("epoch_seconds").isNotNull(), F.col("ingest_seq"))
    ends = cut.groupBy("_slice").agg(F.max_by("epoch_seconds", dated).alias("_end"))
    carried = _before_slice(
        ends.withColumnRenamed("_end", "_value"),
        slices_per_block,
        over=lambda c: F.last(c, ignorenulls=True),
        total=lambda c, at: F.max_by(c, F.when(c.isNotNull(), at)),
        add=lambda block, own: F.coalesce(own, block),
    ).withColumnRenamed("_value", "_carried")

    previous = F.coalesce(F.last("epoch_seconds", ignorenulls=True).over(before), F.col("_carried"))
    paced = (
        cut.join(carried, "_slice", "left")
        .withColumn("_gap", F.col("epoch_seconds") - previous)
        .withColumn("pause_micros", _pause_micros(F.col("_gap"), speed, max_gap))
        .drop("_gap", "_carried")
    )
    totals = paced.groupBy("_slice").agg(F.sum("pause_micros").alias("_total"))
    zero = F.lit(0)
    elapsed = _before_slice(
        totals.withColumnRenamed("_total", "_value"),
        slices_per_block,
        over=F.sum,
        total=lambda c, at: F.sum(c),
        add=lambda block, own: F.coalesce(block, zero) + F.coalesce(own, zero),
    ).withColumnRenamed("_value", "_elapsed")
    return paced.join(elapsed, "_slice", "left").select(
        "ingest_seq",
        "epoch_seconds",
        "pause_micros",
        (F.col("_elapsed") + F.sum("pause_micros").over(upto)).alias("release_micros"),
    )


def _before_slice(slices: DataFrame, slices_per_block: int, over, total, add) -> DataFrame:
    """``_slice, _value``: what the values of all earlier slices come to.

    ``over`` sums up within a window, ``total`` a block, and ``add`` joins what earlier blocks and earlier slices of
    the own block come to. The one window without a partition has a row per block.
    """
    value = F.col("_value")
    blocked = slices.select("_slice", "_value", F.expr(f"_slice div {slices_per_block}").alias("_block"))
    in_block = Window.partitionBy("_block").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocked.groupBy("_block").agg(total(value, F.col("_slice")).alias("_value"))
    blocks_before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select("_block", over(value).over(blocks_before).alias("_earlier"))
    own = blocked.select("_slice", "_block", over(value).over(in_block).alias("_own"))
    return own.join(before, "_block", "left").select("_slice", add(F.col("_earlier"), F.col("_own")).alias("_value"))


def _pause_micros(gap: Column, speed: float, max_gap: float) -> Column:
    if speed <= 0:
        return F.lit(0).cast("bigint")
    pause = F.least(gap / F.lit(float(speed)), F.lit(float(max_gap)))
    return F.coalesce(F.when(gap > 0, F.rint(pause * 1_000_000).cast("bigint")), F.lit(0).cast("bigint"))
