"""Reading the given tables, and intermediate tables in the shared folder."""

from __future__ import annotations

import ctypes
import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import new_run_dir


#: where the library lies; workers look for it in the same place
HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if HOME not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([HOME, *filter(None, paths)])
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write the rows to the shared folder and read them back.

    This cuts the lineage: a lost executor costs the reader nothing, and a join on what was read
    sits right above its shuffle, so that Spark can split a hot key.
    """
    path = new_run_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def tasks(spark: SparkSession) -> int:
    """Partitions that the session gives a shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def give_back() -> None:
    """Return a task's freed memory to the system; Spark keeps the worker process for later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
