"""Adapter: the generated `events` table as a log of raw page-edit events.

Every event becomes one record; some records are broken in known ways (by
``event_id % 40``) and some come twice, so that each outcome of validation and both
deduplications occur at every scale. Nothing is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json_checks import compact_json


EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


#: rows that one task parses, about
ROWS_PER_TASK = 250_000


def spread(table: DataFrame) -> DataFrame:
    """A table dealt over all cores, and over more tasks once they would get more than ROWS_PER_TASK rows.

    The rows are about to be parsed, which is worth more than this shuffle of short columns. The number of
    splits does not tell how they lie: a row group goes to one split as a whole, so that a file of one row
    group is read by one task however many splits it has. Counting reads file footers only. Rows are dealt in
    turn and not by a key, which may be null or repeat.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    waves = -(-table.count() // (cores * ROWS_PER_TASK))
    return table.repartition(cores * max(waves, 1))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ingest_seq, value`` of every derived record, in one pass over the table."""
    events = events_table(spark, sf_dir)
    total = events.agg(F.count("*")).scalar()
    eid = F.col("event_id")
    arrival = (eid * 7919) % F.col("n")

    def copy(seq, prefix):
        return F.struct(seq.alias("ingest_seq"), F.lit(prefix).alias("prefix"))

    copies = F.array(
        copy(arrival, "page-"),
        F.when(eid % 10 == 1, copy(arrival + F.col("n"), "page-")),
        F.when(eid % 100 == 12, copy(arrival + 2 * F.col("n"), "moved-")),
    )
    rows = spread(events).withColumn("n", total).select("*", F.inline(F.array_compact(copies)))

    fault = eid % 40
    delta = F.floor(F.col("value") * 100).cast("bigint") % 2000 - 1000
    fields = rows.select(
        "ingest_seq",
        fault.alias("fault"),
        F.when(fault == 2, "log").when(F.col("event_type") == "signup", "new").otherwise("edit").alias("type"),
        F.lit("enwiki").alias("wiki"),
        F.when(F.col("user_id") % 10 == 0, "de.wikipedia.org").otherwise("en.wikipedia.org").alias("server_name"),
        (F.col("user_id") % 25 == 3).alias("bot"),
        F.concat("prefix", F.regexp_extract("props", "([0-9]+)", 1)).alias("title"),
        F.when(fault == 3, "").otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("user"),
        F.when(fault != 4, F.struct(eid.alias("new"))).alias("revision"),
        F.when(
            fault != 5,
            F.struct(
                F.when(fault != 10, F.lit(5000)).alias("old"),
                F.when(fault == 6, F.lit(20000000)).otherwise(5000 + delta).alias("new"),
            ),
        ).alias("length"),
        F.when(
            ~fault.isin(7, 9),
            F.struct(
                F.when(fault == 8, "garbage")
                .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
                .alias("dt")
            ),
        ).alias("meta"),
        F.when(fault != 7, F.col("ts").cast("timestamp").cast("bigint")).alias("timestamp"),
    )
    text = compact_json(
        "type", "wiki", "server_name", "bot", "title", "user", "revision", "length", "meta", "timestamp"
    )
    value = F.when(F.col("fault") == 0, F.left(text, F.lit(30))).when(F.col("fault") == 1, "[1]").otherwise(text)
    return fields.select("ingest_seq", value.alias("value"))


def lineitem_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The larger `lineitem` table as valid events, for timing: its revisions repeat with
    different contents, so which copy comes first is not defined."""
    lines = spread(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    quantity = F.round("l_quantity").cast("int")
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ingest_seq"),
        F.lit("enwiki").alias("wiki"),
        F.concat(F.lit("page-"), F.col("l_partkey").cast("string")).alias("page_title"),
        F.lit("PageEdited").alias("event_type"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("revision_id"),
        F.concat(F.lit("u"), F.col("l_suppkey").cast("string")).alias("editor"),
        F.when(F.col("l_returnflag") == "R", -quantity).otherwise(quantity).alias("byte_delta"),
        F.col("l_shipdate").cast("string").alias("occurred_at"),
        F.col("l_shipdate").cast("timestamp").alias("occurred_ts"),
    )
