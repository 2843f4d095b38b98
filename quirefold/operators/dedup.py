"""First-arrival deduplication: of all copies of a key, the one with the lowest ingest_seq counts.

Copies may carry the same number, as a redelivered record does; of those, the smallest contents count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_arrival(events: DataFrame, keys: list[str], order: str = "ingest_seq") -> DataFrame:
    """One row per key, the first to arrive.

    An aggregate, not a window: each task reduces its copies before the shuffle, so a
    key with very many copies costs the receiving task one row per sending task.
    """
    rest = [c for c in events.columns if c not in keys and c != order]
    found = events.groupBy(*keys).agg(F.min(F.struct(order, *rest)).alias("_first"))
    return found.select(*keys, "_first.*").select(*events.columns)


def not_yet_in(events: DataFrame, earlier: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key does not occur among the earlier rows."""
    return events.join(earlier.select(*keys), keys, "left_anti")


def upsert(current: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Current rows with those of the updates put in their place; new keys are added."""
    return not_yet_in(current, updates, keys).unionByName(updates.select(*current.columns))
