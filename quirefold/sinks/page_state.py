"""The page_state read model: immutable snapshots of key buckets behind one pointer file.

A write puts new files for the buckets it touches beside the old ones and then replaces the
pointer, which names the version of every bucket. Readers see the old or the new state, and
a failed write leaves the pointer and so the state as it was.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import upsert
from ..operators.reads import of_page
from ..schemas import PAGE_KEY, PAGE_STATE
from . import files


class PageStateTable:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        self.pointer = f"{self.root}/CURRENT"
        self.buckets = buckets

    # --- reads ---
    def current(self) -> dict:
        """The pointer: number of buckets, and the version directory of each that has rows."""
        if not files.exists(self.spark, self.pointer):
            return {"buckets": self.buckets, "versions": {}}
        return json.loads(files.read_text(self.spark, self.pointer))

    def read(self, pointer: dict | None = None) -> DataFrame:
        pointer = pointer or self.current()
        return self._read_buckets(pointer, list(pointer["versions"]))

    def lookup(self, wiki: str, page_title: str) -> DataFrame:
        """Current row of one page, reading its bucket only."""
        pointer = self.current()
        at = self.spark.range(1).select(_bucket(F.lit(wiki), F.lit(page_title), pointer["buckets"])).first()[0]
        touched = [b for b in (str(at),) if b in pointer["versions"]]
        return of_page(self._read_buckets(pointer, touched), wiki, page_title)

    def _read_buckets(self, pointer: dict, touched: list[str]) -> DataFrame:
        paths = [f"{self._version_dir(pointer['versions'][b])}/bucket={b}" for b in touched]
        if not paths:
            return self.spark.createDataFrame([], PAGE_STATE)
        return self.spark.read.schema(PAGE_STATE).parquet(*paths)

    def _version_dir(self, version: str) -> str:
        return f"{self.root}/data/version={version}"

    # --- writes ---
    def upsert(self, updates: DataFrame) -> dict:
        """Replace or add the given pages (one row each); all non-key columns are replaced."""
        pointer = self.current()
        # the updates are used twice, and may come from a stream: compute them once, to files
        staged = self._write(updates.select(*PAGE_STATE.fieldNames()), pointer["buckets"])
        touched = self._buckets_in(staged)
        held = [b for b in touched if b in pointer["versions"]]
        version = staged
        if held:
            fresh = self._read_buckets({"versions": dict.fromkeys(touched, staged)}, touched)
            version = self._write(upsert(self._read_buckets(pointer, held), fresh, PAGE_KEY), pointer["buckets"])
            files.delete(self.spark, self._version_dir(staged))
        return self._swap(pointer, {**pointer["versions"], **dict.fromkeys(touched, version)})

    def write_shadow(self, state: DataFrame) -> dict:
        """Write a whole new state beside the live one; gives the pointer that would make it live."""
        version = self._write(state, self.buckets)
        return {"buckets": self.buckets, "versions": dict.fromkeys(self._buckets_in(version), version)}

    def swap_in(self, shadow: dict, expected: dict) -> dict:
        """Make a shadow live, if the live state is still the one it was compared with."""
        if self.current() != expected:
            raise RuntimeError("page_state changed while its replacement was being built")
        return self._swap(shadow, shadow["versions"])

    def remove_superseded(self, older_than_seconds: float = 86_400, log=None) -> int:
        """Delete versions the pointer no longer names, once no reader can still be on them.

        None while a rebuild holds the lock of the given rebuild log: its shadow is not named yet.
        """
        if log is not None and log.is_locked():
            return 0
        named = set(self.current()["versions"].values())
        removed = 0
        for version in files.partition_values(self.spark, f"{self.root}/data", "version"):
            path = self._version_dir(version)
            age = time.time() - files.modified_millis(self.spark, path) / 1000
            if version not in named and age >= older_than_seconds:
                files.delete(self.spark, path)
                removed += 1
        return removed

    def _buckets_in(self, version: str) -> list[str]:
        """Buckets a version has rows of: at most one name per bucket comes to the driver."""
        return files.partition_values(self.spark, self._version_dir(version), "bucket")

    def _write(self, state: DataFrame, buckets: int) -> str:
        version = uuid.uuid4().hex
        placed = state.withColumn("bucket", _bucket("wiki", "page_title", buckets))
        # rebalance: whole buckets per task, but a large one is split and small ones are merged
        placed.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", *PAGE_KEY).write.mode(
            "overwrite"
        ).partitionBy("bucket").parquet(self._version_dir(version))
        return version

    def _swap(self, pointer: dict, versions: dict) -> dict:
        fresh = {"buckets": pointer["buckets"], "versions": versions}
        files.replace_text(self.spark, self.pointer, json.dumps(fresh))
        return fresh


def _bucket(wiki: str | Column, page_title: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(wiki, page_title), F.lit(buckets)).cast("int")
