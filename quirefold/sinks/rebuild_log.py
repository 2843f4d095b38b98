"""The audit log table of rebuilds, and the lock that lets one run at a time."""

from __future__ import annotations

import threading
import time
import uuid
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.instants import short_error
from ..schemas import REBUILD_LOG
from . import files

STATUSES = ("running", "succeeded", "failed")


class RebuildLog:
    def __init__(self, spark: SparkSession, root: str, stale_after_seconds: float = 6 * 3600):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/rebuild_log"
        self.lock_path = f"{root.rstrip('/')}/rebuild.lock"
        self.stale_after_seconds = stale_after_seconds
        self.token: str | None = None

    def read(self) -> DataFrame:
        if not files.exists(self.spark, self.path):
            return self.spark.createDataFrame([], REBUILD_LOG)
        return self.spark.read.schema(REBUILD_LOG).parquet(self.path)

    def append(
        self,
        id: int,
        step: int,
        status: str,
        started_at: datetime,
        completed_at: datetime | None = None,
        events_replayed: int | None = None,
        discrepancy_count: int | None = None,
        error_message: str | None = None,
    ) -> None:
        if status not in STATUSES:
            raise ValueError(f"unknown status {status}")
        row = (id, step, started_at, completed_at, status, events_replayed, discrepancy_count, error_message)
        entry = self.spark.createDataFrame([row], REBUILD_LOG)
        entry.withColumn("error_message", short_error(F.col("error_message"))).coalesce(1).write.mode("append").parquet(
            self.path
        )

    def next_id(self) -> int:
        return self.read().agg(F.coalesce(F.max("id"), F.lit(0)) + 1).first()[0]

    # --- single flight ---
    def try_lock(self) -> bool:
        """Take the lock, which then bears this log's token.

        A lock that was not refreshed for ``stale_after_seconds`` was left by a crash and is taken over. Of
        several that try, the one that creates the claim on that very lock replaces it, in one step, if it is
        still the lock that was found stale; the others are refused.
        """
        token = uuid.uuid4().hex
        if not files.create_new(self.spark, self.lock_path, token):
            holder = self._holder()
            if holder is None or not self._is_stale(self.lock_path):
                return False
            claim = f"{self.lock_path}.claim-{holder}"
            if not files.create_new(self.spark, claim, token):
                if self._is_stale(claim):  # its maker crashed too; the next one that tries may claim again
                    files.delete(self.spark, claim)
                return False
            try:
                if self._holder() != holder:
                    return False
                files.replace_text(self.spark, self.lock_path, token)
            finally:
                files.delete(self.spark, claim)
        self.token = token
        return True

    def refresh(self) -> bool:
        """Show that the holder is alive; False if the lock is no longer ours."""
        if self.token is None or self._holder() != self.token:
            return False
        files.touch(self.spark, self.lock_path)
        return True

    def is_locked(self) -> bool:
        return self._holder() is not None and not self._is_stale(self.lock_path)

    def unlock(self) -> None:
        """Give the lock back, if it is still ours."""
        if self.token is not None and self._holder() == self.token:
            files.delete(self.spark, self.lock_path)
        self.token = None

    @contextmanager
    def kept_alive(self):
        """Refreshes the lock, a few times in each period after which it would be stale."""
        over = threading.Event()

        def keep() -> None:
            while not over.wait(max(self.stale_after_seconds / 4, 0.05)) and self.refresh():
                pass

        keeper = threading.Thread(target=keep, daemon=True)
        keeper.start()
        try:
            yield
        finally:
            over.set()
            keeper.join()

    def _holder(self) -> str | None:
        try:
            return files.read_text(self.spark, self.lock_path)
        except Exception:
            if files.exists(self.spark, self.lock_path):
                raise
            return None

    def _is_stale(self, path: str) -> bool:
        try:
            modified = files.modified_millis(self.spark, path)
        except Exception:
            if files.exists(self.spark, path):
                raise
            return False  # given back meanwhile
        return time.time() - modified / 1000 >= self.stale_after_seconds
