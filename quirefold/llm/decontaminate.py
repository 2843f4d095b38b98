"""Benchmark decontamination by a prefix-filtered set join.

A window is ITEM_WINDOW consecutive words of an item (all of a shorter item); a document holds the
window if it has those words in a row.

1. The shingles (five words; all of a shorter window) of the items go into a filter of a fixed number
   of bits, which every task gets.
2. One pass over the documents keeps, per document, its words' number and the places whose shingle
   passes the filter, with the words around.
3. These places are counted per shingle. To hold a window, a document must hold all of its shingles, so
   the prefix to look up is the one shingle that is rarest in the documents; a window with a shingle
   that occurs nowhere is dropped.
4. Places and windows are joined on that shingle. Where the window would start follows from the
   shingle's place in it; a start before the text or an end after it is out; the words decide.
5. Occurrences are merged into the words they cover.

Nothing but the filter is sent to all tasks. A passage may be in any share of the documents: its
places are spread by document everywhere but in the join, where Spark splits the shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import give_back, stored, table
from .wordhash import by_letter, chunks, run_hash

ITEM_WINDOW = 10
SHINGLE = 5
#: bits of the filter; 2 MB are sent to each task
FILTER_BITS = 1 << 24

WINDOWS = "item_id string, words int, text binary, shingles array<struct<hash: bigint, at: int>>, size int"
PLACES = "doc_id bigint, row string, n_words bigint, places array<struct<size: int, hash: bigint, at: int, before: int, words: binary>>"


def item_windows(window: int, shingle: int):
    """All windows of the items, with their shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            ids = batch.column(0).to_pylist()
            for row, found in chunks(batch.column(1), by_letter()):
                for doc in range(len(found.first) - 1):
                    first, last = int(found.first[doc]), int(found.first[doc + 1])
                    words = [found.text(k) for k in range(first, last)]
                    length = min(window, len(words))
                    size = min(shingle, length)
                    for start in range(len(words) - length + 1 if words else 0):
                        at = range(first + start, first + start + length - size + 1)
                        hashes = run_hash([found.hash[at.start + k : at.stop + k] for k in range(size)]).view("<i8")
                        values = (
                            ids[row + doc],
                            length,
                            b" ".join(words[start : start + length]),
                            [{"hash": int(h), "at": k} for k, h in enumerate(hashes)],
                            size,
                        )
                        for column, value in zip(out, values, strict=True):
                            column.append(value)
            kinds = (
                pa.string(),
                pa.int32(),
                pa.binary(),
                pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int32())])),
                pa.int32(),
            )
            names = ["item_id", "words", "text", "shingles", "size"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)

    return run


def filter_places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return hashes & np.uint64(bits - 1), (hashes >> np.uint64(32)) & np.uint64(bits - 1)


def shingle_filter(windows: DataFrame, bits: int) -> tuple[np.ndarray, list[int]]:
    """The filter's bits, packed into bytes, and the shingle sizes in use. The driver gets at most
    ``bits`` bits, in 64-bit words."""
    hashes = windows.select("size", F.explode("shingles.hash").alias("h"))
    low, high = F.col("h").bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned("h", 32).bitwiseAND(F.lit(bits - 1))
    places = hashes.select("size", F.explode(F.array(low, high)).alias("p"))
    words = (
        places.groupBy(F.shiftright("p", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits"), F.collect_set("size").alias("sizes"))
        .toArrow()
    )
    packed = np.zeros(bits // 64, "<i8")
    packed[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return packed.view(np.uint8), sorted({s for sizes in words.column("sizes").to_pylist() for s in sizes})


def find_places(shared, bits: int, sizes: list[int], window: int):
    """Of each document: words, and the places whose shingle passes the filter."""
    kind = pa.struct(
        [("size", pa.int32()), ("hash", pa.int64()), ("at", pa.int32()), ("before", pa.int32()), ("words", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        member = shared.value
        for batch in batches:
            counts = np.zeros(batch.num_rows, "<i8")
            places: list[list] = [[] for _ in range(batch.num_rows)]
            for row, found in chunks(batch.column(2), by_letter()):
                counts[row : row + len(found.first) - 1] = np.diff(found.first)
                for size in sizes:
                    hashes, at = found.shingles(size)
                    passed = np.ones(len(hashes), bool)
                    for place in filter_places(hashes, bits):
                        passed &= (member[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
                    for k in np.flatnonzero(passed).tolist():
                        word = int(at[k])
                        doc = int(found.doc[word])
                        first, last = int(found.first[doc]), int(found.first[doc + 1])
                        begin, stop = max(first, word - window + size), min(last, word + window)
                        places[row + doc].append(
                            {
                                "size": size,
                                "hash": int(hashes[k : k + 1].view("<i8")[0]),
                                "at": word - first,
                                "before": word - begin,
                                "words": b" ".join(found.text(w) for w in range(begin, stop)),
                            }
                        )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts), pa.array(places, pa.list_(kind))],
                names=["doc_id", "row", "n_words", "places"],
            )
        give_back()

    return run


def occurrences(places: DataFrame, windows: DataFrame) -> DataFrame:
    """``row, item_id, start, words`` of every window in every document; start and words in words."""
    here = places.select("row", F.explode("places").alias("p")).select("row", "p.*")
    df = here.groupBy("size", "hash").agg(F.count("*").alias("df"))
    numbered = stored(windows.withColumn("window", F.monotonically_increasing_id()), "numbered-windows")
    known = numbered.select("window", "size", F.explode("shingles").alias("s")).select("window", "size", "s.*")
    prefix = (
        known.join(df, ["size", "hash"], "left")
        .groupBy("window")
        .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "hash", "at")).alias("rarest"))
        .filter("rarest.df > 0")
        .select("window", "rarest.hash", F.col("rarest.at").alias("inside"))
    )
    sought = stored(
        prefix.join(numbered.select("window", "item_id", "words", "text", "size"), "window")
        .groupBy("size", "hash", "inside", "words", "text")
        .agg(F.collect_set("item_id").alias("items")),
        "sought-windows",
    ).withColumnRenamed("words", "length")
    met = here.join(sought, ["size", "hash"]).filter("at >= inside and before >= inside")
    around = F.split(F.col("words").cast("string"), " ")
    cut = F.array_join(F.slice(around, F.col("before") - F.col("inside") + 1, F.col("length")), " ")
    return met.filter(cut == F.col("text").cast("string")).select(
        "row", F.explode("items").alias("item_id"), (F.col("at") - F.col("inside")).alias("start"), F.col("length").alias("words")
    )


def row_key():
    """Names a row's contents: rows that repeat share it, and with it their result."""
    return F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("-"), F.xxhash64("text").cast("string"))


def contamination(
    docs: DataFrame, items: DataFrame, window: int = ITEM_WINDOW, shingle: int = SHINGLE, filter_bits: int = FILTER_BITS
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of each row of ``docs``.

    ``item_ids`` has the items, sorted as strings. A null text or item has no words; an item without
    words has no window; a null item_id counts as the empty string. No items: nothing is hit.
    """
    spark = docs.sparkSession
    windows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), "text").mapInArrow(
        item_windows(window, shingle), WINDOWS
    )
    windows = stored(windows, "item-windows")
    bits, sizes = shingle_filter(windows, filter_bits)
    shared = spark.sparkContext.broadcast(bits)
    rows = docs.select("doc_id", row_key().alias("row"), "text")
    scanned = stored(rows.mapInArrow(find_places(shared, filter_bits, sizes, window), PLACES), "scanned")
    found = stored(occurrences(scanned.filter("size(places) > 0"), windows), "occurrences")
    covered = Window.partitionBy("row").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.groupBy("row", "start").agg(F.max(F.col("start") + F.col("words")).alias("stop"))
    reached = F.coalesce(F.max("stop").over(covered), F.lit(0))
    hits = (
        spans.withColumn("fresh", F.greatest(F.col("stop") - F.greatest("start", reached), F.lit(0)))
        .groupBy("row")
        .agg(F.sum("fresh").alias("n_hit"))
    )
    named = found.groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    all_rows = scanned.select("doc_id", "row", "n_words").join(hits, "row", "left").join(named, "row", "left")
    item_ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0))
    return all_rows.select(
        "doc_id",
        "row",
        "n_words",
        n_hit.cast("bigint").alias("n_hit"),
        F.size(item_ids).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(item_ids, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        item_ids.alias("item_ids"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs, with all their columns."""
    found = contamination(docs, items)
    bad = stored(found.filter("contaminated").select("row").distinct(), "contaminated")
    return docs.join(bad, row_key() == bad["row"], "left_anti")


def op8_prefix_filtered_windows(spark, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")


OP8_SQL = """
WITH b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w
  FROM benchmark
), d AS (
  SELECT doc_id, coalesce(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[0-9a-z\\x{80}-\\x{10FFFF}]+'), []) AS w
  FROM documents
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
), places AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d
), occurrences AS (
  SELECT p.doc_id, x.item_id, p.i, x.k
  FROM (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS t
        FROM places, (SELECT DISTINCT k FROM windows) WHERE i + k - 1 <= len(w)) AS p
  JOIN windows AS x USING (k, t)
), hits AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS word FROM occurrences) GROUP BY doc_id
), items AS (
  SELECT doc_id, list_sort(list(DISTINCT item_id)) AS ids FROM occurrences GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, coalesce(ids, []) AS item_ids
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""
