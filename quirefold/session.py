"""Session settings the library relies on, and where it may put intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


# the SQL options that decide results, not sizes
REQUIRED = {
    # instants are shown and parsed in UTC
    "spark.sql.session.timeZone": "UTC",
    # a repeated JSON key keeps its last value instead of failing the parse
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the required options and return the session."""
    for option, value in REQUIRED.items():
        spark.conf.set(option, value)
    return spark


def check_configured(spark: SparkSession) -> None:
    """Refuse a session in which the results would be others."""
    wrong = [option for option, value in REQUIRED.items() if spark.conf.get(option) != value]
    if wrong:
        raise RuntimeError(f"call configure(spark) first; not set as required: {', '.join(wrong)}")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir.

    Only a local-mode session without that setting gets a temporary folder; on a
    cluster a machine-local folder would be lost with its executor, so we refuse.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    spark.conf.set(CHECKPOINT_DIR, tempfile.mkdtemp(prefix="quirefold-"))
    return spark.conf.get(CHECKPOINT_DIR)


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
