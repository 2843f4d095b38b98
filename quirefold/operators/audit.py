"""The rebuild audit log: current status of each attempt, the start guard, and progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.instants import newer_than
from ..schemas import REBUILD_LOG
from .reads import as_of

# fixed values of the rebuild rules
COOLDOWN = "30 SECONDS"


def current_status(log: DataFrame) -> DataFrame:
    """One row per attempt: the last status appended for it."""
    rest = [c for c in REBUILD_LOG.fieldNames() if c not in ("id", "step")]
    latest = F.max(F.struct("step", *rest)).alias("_row")
    return log.groupBy("id").agg(latest).select("id", "_row.*")


def latest_attempt(log: DataFrame) -> DataFrame:
    """The newest attempt with its current status; no row if there was none."""
    # the highest (id, step) is both the newest attempt and its last status
    return log.orderBy(F.desc("id"), F.desc("step")).limit(1)


def start_guard(log: DataFrame, asof=None) -> DataFrame:
    """One row: is an attempt running, did one finish within the cooldown, may one start."""
    status = current_status(log)
    recent = F.col("completed_at").isNotNull() & newer_than(F.col("completed_at"), as_of(asof), COOLDOWN)
    return status.agg(
        F.coalesce(F.bool_or(F.col("status") == "running"), F.lit(False)).alias("is_running"),
        F.coalesce(F.bool_or(recent), F.lit(False)).alias("in_cooldown"),
    ).withColumn("may_start", ~F.col("is_running") & ~F.col("in_cooldown"))


def progress(processed: Column, total: Column) -> Column:
    """Share of the log replayed, at most 1; 0 while the total is unknown or zero."""
    # least() skips NULLs, so an unknown total needs its own branch
    return F.when(total > 0, F.least(processed / total, F.lit(1.0))).otherwise(F.lit(0.0))
