"""Validation and normalization of raw events, the dead-letter split, and the output encodings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import instants
from ..functions import json_checks as J
from ..schemas import VALID, VALID_FIELDS
from ..session import check_configured

# fixed values of the validation rules
MAX_ABS_BYTE_DELTA = 10_000_000
EVENT_NAMES = {"new": "PageCreated", "edit": "PageEdited"}
REASONS = (
    "invalid_json",
    "not_object",
    "bad_type",
    "missing_field",
    "missing_revision",
    "bad_length",
    "bad_byte_delta",
    "missing_timestamp",
    "bad_timestamp",
)


def classify(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Validate each raw record.

    Takes ``ingest_seq, value`` and any columns to keep; gives them, ``reason`` and the normalized
    columns. ``reason`` is NULL for a valid event, else the first check that failed.
    """
    check_configured(raw.sparkSession)
    v = F.col("_v")
    text = F.col("value")
    kept = ["ingest_seq", "value", *keep]
    dt = J.json_string(v, "$[0].meta.dt")
    no_dt_text = dt.isNull() | (dt == "")
    fields = [
        J.is_single_value(v, text).alias("is_json"),
        J.is_object(text).alias("is_object"),
        J.json_string(v, "$[0].type").alias("kind"),
        J.json_string(v, "$[0].wiki").alias("wiki"),
        J.json_string(v, "$[0].title").alias("page_title"),
        J.json_string(v, "$[0].user").alias("editor"),
        *_number(v, "$[0].revision.new", "rev"),
        *_number(v, "$[0].length.new", "new"),
        *_number(v, "$[0].length.old", "old"),
        dt.alias("dt"),
        # read only where meta.dt is no text
        F.when(dt.isNull(), J.json_text(v, "$[0].meta.dt")).alias("dt_other"),
        F.when(no_dt_text, J.json_type(v, "$[0].timestamp")).alias("ts_type"),
        F.when(no_dt_text, J.json_double(v, "$[0].timestamp")).alias("ts"),
    ]
    read = raw.select(*kept, J.parse_wrapped(text).alias("_v")).select(*kept, *fields)
    # inline() keeps a later filter above the parse: pushed below it, the filter on the
    # reason would repeat the whole parse in its own condition
    return _normalize(read, kept).select(*kept, F.inline(F.array("_event")))


def _number(v: Column, path: str, name: str) -> list[Column]:
    return [J.json_type(v, path).alias(f"{name}_type"), J.json_long(v, path).alias(name)]


def _is_long(name: str) -> Column:
    return F.coalesce(F.col(f"{name}_type") == "BIGINT", F.lit(False))


def _normalize(read: DataFrame, kept: list[str]) -> DataFrame:
    """Columns of the reads above to one column ``_event``.

    In three small steps: one large step compiles to a method the JVM will not optimize. They are plain
    projections, which Spark keeps apart since their columns are used more than once; a generator of a large
    expression is interpreted where the step is not compiled as a whole.
    """
    c = F.col
    # a text in meta.dt counts if it is not empty, anything else there if it is not 'nothing'
    dt_given = F.when(c("dt").isNotNull(), c("dt") != "").otherwise(~J.is_empty_like(c("dt_other")))
    has_old = c("old_type").isNotNull() & (c("old_type") != "VOID")
    texts_present = [F.coalesce(c(name) != "", F.lit(False)) for name in ("wiki", "page_title", "editor")]
    checked = read.select(
        *kept,
        c("is_json"),
        c("is_object"),
        c("kind"),
        (texts_present[0] & texts_present[1] & texts_present[2]).alias("has_texts"),
        c("wiki"),
        c("page_title"),
        c("editor"),
        F.when(_is_long("rev"), c("rev")).alias("rev"),
        (_is_long("new") & (~has_old | _is_long("old"))).alias("has_lengths"),
        # NULL on 64-bit overflow, which is out of bounds too
        F.try_subtract(c("new"), F.when(has_old, c("old")).otherwise(F.lit(0))).alias("delta"),
        F.when(dt_given, c("dt")).alias("dt"),
        dt_given.alias("dt_given"),
        F.coalesce(J.is_number_type(c("ts_type")), F.lit(False)).alias("has_timestamp"),
        F.when(~dt_given, c("ts")).alias("ts"),
    )
    epoch = instants.from_epoch(c("ts"))
    timed = checked.select(
        *[name for name in checked.columns if name not in ("dt", "ts")],
        F.when(c("dt_given"), instants.parse_iso(c("dt"))).otherwise(epoch).alias("occurred_ts"),
        F.when(c("dt_given"), c("dt")).otherwise(instants.to_iso(epoch)).alias("occurred_at"),
    )
    in_bounds = F.coalesce(c("delta").between(-MAX_ABS_BYTE_DELTA, MAX_ABS_BYTE_DELTA), F.lit(False))
    reason = (
        F.when(~c("is_json"), "invalid_json")
        .when(~c("is_object"), "not_object")
        .when(~F.coalesce(c("kind").isin(*EVENT_NAMES), F.lit(False)), "bad_type")
        .when(~c("has_texts"), "missing_field")
        .when(c("rev").isNull(), "missing_revision")
        .when(~c("has_lengths"), "bad_length")
        .when(~in_bounds, "bad_byte_delta")
        .when(~c("dt_given") & ~c("has_timestamp"), "missing_timestamp")
        .when(c("occurred_ts").isNull(), "bad_timestamp")
    )
    event = F.struct(
        reason.alias("reason"),
        c("wiki"),
        c("page_title"),
        F.when(c("kind") == "new", EVENT_NAMES["new"]).otherwise(EVENT_NAMES["edit"]).alias("event_type"),
        c("rev").alias("revision_id"),
        c("editor"),
        F.when(in_bounds, c("delta")).cast("int").alias("byte_delta"),
        c("occurred_at"),
        c("occurred_ts"),
    )
    return timed.select(*kept, event.alias("_event"))


def valid_events(classified: DataFrame) -> DataFrame:
    """The valid log: normalized events that passed every check."""
    return classified.filter("reason IS NULL").select(*VALID.fieldNames())


def dead_letters(classified: DataFrame) -> DataFrame:
    """The dead-letter log: what failed, why, and the record as received."""
    return classified.filter("reason IS NOT NULL").select("ingest_seq", "reason", F.col("value").alias("raw"))


def counts_by_reason(classified: DataFrame) -> DataFrame:
    """Number of records per outcome; valid ones count as ``ok``."""
    return classified.groupBy(F.coalesce("reason", F.lit("ok")).alias("outcome")).agg(F.count("*").alias("records"))


def to_valid_json(valid: DataFrame) -> DataFrame:
    """Valid events as the compact JSON text published on a message log."""
    return valid.select("ingest_seq", J.compact_json(*VALID_FIELDS).alias("value"))


def to_deadletter_json(dead: DataFrame) -> DataFrame:
    return dead.select("ingest_seq", J.compact_json("reason", "raw").alias("value"))


def from_valid_json(log: DataFrame) -> DataFrame:
    """Valid events back from their JSON text (``ingest_seq, value``)."""
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in VALID.fields if f.name in VALID_FIELDS)
    typed = log.select("ingest_seq", F.inline(F.array(F.from_json("value", shape))))
    return typed.withColumn("occurred_ts", instants.parse_iso(F.col("occurred_at"))).select(*VALID.fieldNames())


def to_page_events(valid: DataFrame, ingested_at: Column) -> DataFrame:
    """Ledger rows of valid events: typed event time, and when they were taken in."""
    return valid.select(
        "ingest_seq",
        "wiki",
        "page_title",
        "event_type",
        "revision_id",
        "editor",
        "byte_delta",
        F.col("occurred_ts").alias("occurred_at"),
        ingested_at.cast("timestamp").alias("ingested_at"),
    )
