"""Which revisions of each wiki a stored table holds, as bitmaps beside it.

A batch appends one bitmap per wiki and slot of 32,768 revision ids that it added to. To know whether
revisions were seen, the bitmaps of their ranges are read, one bit an id, instead of the stored rows. Now and
then the bitmaps of a range that many batches added to are merged into one per slot, so that what a batch reads
is bounded by the ranges it touches and not by how many batches came before.

A batch's bitmaps bear its name and follow its rows: the repetition of a failed batch does not take its own rows
for earlier ones. ``index_missing`` adds what a crash between the two, or a table from before, left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BATCH_ID, REV_RANGE, RUN_ID, stored_at
from . import files
from .ranges import BATCH, of_other_batches, read_all, read_ranges_of, write_ranges

SEEN = stored_at(
    T.StructType(
        [
            T.StructField("wiki", T.StringType()),
            T.StructField("slot", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    ),
    REV_RANGE,
    RUN_ID,
    BATCH_ID,
)
#: the run that merged bitmaps are written as
MERGED = "merged"


class SeenRevisions:
    """The bitmaps of one table; ``merge_after`` batches of a range make it worth merging."""

    def __init__(self, spark: SparkSession, path: str, merge_after: int = 32):
        self.spark, self.path, self.merge_after = spark, path, merge_after

    def read(self) -> DataFrame:
        return read_all(self.spark, self.path, SEEN)

    def mark(self, events: DataFrame, run_id: str, batch_id: int) -> DataFrame:
        """The events with ``_seen``: does a batch other than this one hold their wiki and revision?"""
        stored = of_other_batches(read_ranges_of(self.spark, self.path, SEEN, events), run_id, batch_id)
        held = stored.groupBy("wiki", F.col("slot").alias("_slot")).agg(F.bitmap_or_agg("ids").alias("_ids"))
        slotted = events.withColumn("_slot", F.bitmap_bucket_number("revision_id"))
        seen = F.coalesce(_has_bit(F.col("_ids"), F.bitmap_bit_position("revision_id")), F.lit(False))
        return slotted.join(held, ["wiki", "_slot"], "left").select(*events.columns, seen.alias("_seen"))

    def add(self, rows: DataFrame, run_id: str, batch_id: int) -> None:
        """Note the revisions of the rows that a batch stored."""
        write_ranges(_bitmaps(rows, "rev_range"), self.path, run_id, batch_id, "wiki", "slot")

    def index_missing(self, stored: DataFrame) -> None:
        """Note again what each run stored in the last batch noted, and what came after it."""
        noted = self.read().groupBy("run_id").agg(F.max("batch_id")).collect()  # a row per checkpoint there ever was
        noted.append(("", 0))
        upto = F.create_map(*[F.lit(value) for row in noted for value in row])
        # on directory names alone, so that older batches are not opened
        rest = stored.filter(F.col("batch_id") >= F.coalesce(F.try_element_at(upto, F.col("run_id")), F.lit(0)))
        write = _bitmaps(rest, *BATCH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        write.partitionBy(*BATCH).parquet(self.path)

    def merge(self) -> int:
        """One bitmap per wiki and slot, in ranges of many batches; gives the number of batches merged away.

        The last batch of each run stays as it is, since it may be repeated. Merged bitmaps are there before
        the old ones go; a crash between leaves both, which hold the same.
        """
        # from names alone: no column of the table is read for these
        batches = self.read().select(*BATCH).distinct()
        last = batches.filter(F.col("run_id") != MERGED).groupBy("run_id").agg(F.max("batch_id").alias("_last"))
        closed = batches.join(last, "run_id", "left").filter("_last IS NULL OR batch_id < _last").drop("_last")
        many = closed.groupBy("rev_range").count().filter(F.col("count") >= self.merge_after).select("rev_range")
        sources = closed.join(many, "rev_range", "left_semi")
        names = [tuple(r) for r in sources.select(*BATCH).collect()]
        if not names:
            return 0
        number = 1 + max((batch for _, run, batch in names if run == MERGED), default=-1)
        held = self.read().join(sources, BATCH, "left_semi")
        merged = held.groupBy("rev_range", "wiki", "slot").agg(F.bitmap_or_agg("ids").alias("ids"))
        write_ranges(merged, self.path, MERGED, number, "wiki", "slot")
        for rev_range, run, batch in names:
            files.delete(self.spark, f"{self.path}/rev_range={rev_range}/run_id={run}/batch_id={batch}")
        return len(names)


def _bitmaps(rows: DataFrame, *of: str) -> DataFrame:
    slotted = rows.withColumn("slot", F.bitmap_bucket_number("revision_id"))
    bit = F.bitmap_bit_position("revision_id")
    return slotted.groupBy(*of, "wiki", "slot").agg(F.bitmap_construct_agg(bit).alias("ids"))


def _has_bit(bitmap: Column, position: Column) -> Column:
    byte = F.substring(bitmap, (position / 8).cast("int") + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (position % 8).cast("int")) == 1
