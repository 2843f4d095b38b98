"""Tables in directories ``rev_range=R/run_id=I/batch_id=N``, read for some ranges of revision ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import PAGE_KEY
from . import files

BATCH = ["rev_range", "run_id", "batch_id"]

#: so many ranges are opened by the names of their directories; with more, the whole table is semi-joined
NAMED_RANGES = 1000


def read_all(spark: SparkSession, path: str, schema) -> DataFrame:
    if not files.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_ranges_of(spark: SparkSession, path: str, schema, rows: DataFrame) -> DataFrame:
    """Stored rows in the ranges that the given rows are in. No other range is listed or opened, unless
    the rows are in more ranges than NAMED_RANGES: then the names alone tell which files are read."""
    found = [r[0] for r in rows.select("rev_range").distinct().limit(NAMED_RANGES + 1).collect()]
    if len(found) > NAMED_RANGES:
        return read_all(spark, path, schema).join(rows.select("rev_range").distinct(), "rev_range", "left_semi")
    held = [p for p in (f"{path}/rev_range={r}" for r in sorted(found)) if files.exists(spark, p)]
    if not held:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*held)


def of_other_batches(stored: DataFrame, run_id: str, batch_id: int) -> DataFrame:
    """What a repeated batch wrote the first time is not 'earlier'."""
    return stored.filter((F.col("run_id") != run_id) | (F.col("batch_id") != batch_id))


def write_ranges(rows: DataFrame, path: str, run_id: str, batch_id: int, *order: str) -> None:
    """Write a batch's rows, replacing the directories it wrote before if it is a repetition.

    Rebalanced by range: small ranges share a task, a large one is split over several.
    """
    placed = rows.withColumn("run_id", F.lit(run_id)).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    ordered = placed.hint("rebalance", F.col("rev_range")).sortWithinPartitions("rev_range", *order)
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*BATCH).parquet(path)
