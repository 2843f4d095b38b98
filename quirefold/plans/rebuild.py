"""Rebuild of page_state from the whole valid log, with comparison and atomic swap."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import audit, compare
from ..operators.fold import fold_distinct, fold_pages
from ..sinks.page_state import PageStateTable
from ..sinks.rebuild_log import RebuildLog


class RebuildRefused(Exception):
    """No rebuild may start now; ``reason`` says why."""

    def __init__(self, reason: str):
        super().__init__(reason)
        self.reason = reason


LOCKED, COOLING = "locked", "cooldown"


class Rebuild:
    """Replays the valid log into a shadow of page_state and makes it live.

    The caller stops the fold stream first, as both write page_state; the swap checks that
    nothing was written in between.
    """

    def __init__(self, log: RebuildLog, target: PageStateTable):
        self.spark = target.spark
        self.log = log
        self.target = target

    def run(self, valid: DataFrame, asof=None) -> dict:
        """Rebuild and give the audit row of the attempt. Raises RebuildRefused if one may not start."""
        attempt, started_at = self._begin(asof)
        try:
            with self.log.kept_alive():
                events, different = self._replay(attempt, valid)
            self.log.append(attempt, 1, "succeeded", started_at, _now(), events, different)
        except Exception as error:
            # page_state still points at the old snapshot; the shadow is never read
            self.log.append(attempt, 1, "failed", started_at, _now(), error_message=str(error))
        finally:
            self.log.unlock()
        return self.status().first().asDict()

    def _replay(self, attempt: int, valid: DataFrame) -> tuple[int, int]:
        """Events replayed and pages that differed; the new state is live."""
        before = self.target.current()
        counted = Observation(f"replay-{attempt}")
        replayed = valid.observe(counted, F.count(F.lit(1)).alias("events"))
        if "first_arrival" in valid.columns:
            # which copy counts was settled when the log was written, for the stream and for us
            state = fold_distinct(replayed.filter("first_arrival"))
        else:
            state = fold_pages(replayed)
        shadow = self._as_job_group(attempt, lambda: self.target.write_shadow(state))
        events = counted.get["events"]
        different = compare.discrepancy_count(self.target.read(before), self.target.read(shadow)).first()[0]
        if not self.log.refresh():
            raise RuntimeError("the lock was taken over while the replacement was being built")
        self.target.swap_in(shadow, before)
        return events, different

    def _begin(self, asof) -> tuple[int, datetime]:
        if not self.log.try_lock():
            raise RebuildRefused(LOCKED)
        try:
            self._close_abandoned()
            guard = audit.start_guard(self.log.read(), asof).first()
            if not guard.may_start:
                raise RebuildRefused(LOCKED if guard.is_running else COOLING)
            attempt, started_at = self.log.next_id(), _now()
            self.log.append(attempt, 0, "running", started_at)
            return attempt, started_at
        except Exception:
            self.log.unlock()
            raise

    def _close_abandoned(self) -> None:
        """Whoever holds the lock knows that an attempt still marked running has crashed."""
        for row in audit.current_status(self.log.read()).filter("status = 'running'").toLocalIterator():
            self.log.append(row.id, 1, "failed", row.started_at, row.started_at, error_message="abandoned")

    def _as_job_group(self, attempt: int, write):
        """Run a write as a job group of its own, by which its progress can be asked for."""
        context = self.spark.sparkContext
        context.setLocalProperty("spark.jobGroup.id", self._group(attempt))
        try:
            return write()
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)

    def _group(self, attempt: int) -> str:
        return f"rebuild {self.log.path} {attempt}"

    def tasks_done(self, attempt: int) -> tuple[int, int]:
        """Tasks that the replay of an attempt has finished, and those known so far."""
        tracker = self.spark.sparkContext.statusTracker()
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(self._group(attempt))]
        stages = [tracker.getStageInfo(s) for job in jobs if job for s in job.stageIds]
        known = [stage for stage in stages if stage]
        return sum(s.numCompletedTasks for s in known), sum(s.numTasks for s in known)

    def status(self) -> DataFrame:
        """The newest attempt as one row; no row before the first. ``progress`` is the share of the
        replay's tasks that are done, of those Spark has planned so far; 1 when it is over."""
        newest = audit.latest_attempt(self.log.read()).drop("step")
        attempt = newest.select("id").first()
        done, known = self.tasks_done(attempt.id) if attempt else (0, 0)
        share = audit.progress(F.lit(done), F.lit(known))
        return newest.withColumn("progress", F.when(F.col("status") == "running", share).otherwise(F.lit(1.0)))


def _now() -> datetime:
    return datetime.now(timezone.utc)
