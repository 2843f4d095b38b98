"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised to a few bits each, a row's cell gets its index on the
Hilbert curve through them, rows are ordered by that index, and the order is cut into runs. Rows of
a run lie close together in every dimension at once, so that a filter on any of them leaves whole
shards unread (``extents`` shows the ranges).

Everything is column expressions. The global order needs no global sort: the curve has a fixed
number of cells, so a row's rank is the rows of earlier cells, plus those of earlier strands of its
cell, plus its place in its strand. A cell may hold any share of the rows; its strands (a hash of
the row) spread it over the tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored, table

BITS = 5
STRANDS = 1024


def curve_steps(dims: int) -> tuple[list[int], list[int]]:
    """For each state (entry corner, direction) and corner of the cube: the corner's place on the
    curve, and the state inside it."""
    corners, mask = 1 << dims, (1 << dims) - 1

    def turn_right(x: int, by: int) -> int:
        by %= dims
        return ((x >> by) | (x << (dims - by))) & mask

    def gray(x: int) -> int:
        return x ^ (x >> 1)

    def trailing_ones(x: int) -> int:
        return ((x ^ (x + 1)).bit_length() - 1) % dims

    place_of = {gray(place): place for place in range(corners)}
    places, states = [], []
    for entry in range(corners):
        for direction in range(dims):
            for corner in range(corners):
                place = place_of[turn_right(corner ^ entry, direction + 1)]
                into = gray(2 * ((place - 1) // 2)) if place else 0
                along = 0 if not place else trailing_ones(place if place % 2 else place - 1)
                places.append(place)
                states.append(
                    (entry ^ turn_right(into, dims - (direction + 1) % dims)) * dims + (direction + along + 1) % dims
                )
    return places, states


def hilbert_index(dims: Sequence[Column], bits: int = BITS) -> Column:
    """Index on the curve of the cell with these coordinates, each in 0 .. 2^bits - 1.

    Null if a coordinate is null.
    """
    n = len(dims)
    places, states = (F.array(*map(F.lit, values)) for values in curve_steps(n))
    cell = F.array(*(d.cast("int") for d in dims))

    def step(at: Column, bit: Column, cell: Column, places: Column, states: Column) -> Column:
        corner = sum(
            (F.call_function("shiftright", F.get(cell, F.lit(k)), bit).bitwiseAND(F.lit(1)) * F.lit(1 << k) for k in range(n)),
            F.lit(0),
        )
        key = at["state"] * F.lit(1 << n) + corner
        return F.struct(
            (at["index"] * F.lit(1 << n) + F.get(places, key)).cast("bigint").alias("index"),
            F.get(states, key).cast("int").alias("state"),
        )

    start = F.struct(F.lit(0).cast("bigint").alias("index"), F.lit(0).alias("state"))
    order = F.array(*(F.lit(b) for b in reversed(range(bits))))
    return F.aggregate(order, start, lambda at, bit: step(at, bit, cell, places, states))["index"]


def magnitude(size: Column, bits: int = BITS) -> Column:
    """A count on a logarithmic scale: half powers of two, so 16 bits of range in 5 bits."""
    return F.least(
        F.floor(F.log2(F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)) + F.lit(1.0)) * F.lit(2.0 * (1 << bits) / 64)),
        F.lit((1 << bits) - 1),
    ).cast("int")


def category(value: Column, bits: int = BITS) -> Column:
    """A name as a coordinate: its hash; a null is a category of its own."""
    return F.pmod(F.xxhash64(F.coalesce(value.cast("string"), F.lit(""))), F.lit(1 << bits)).cast("int")


def shard_rows(rows: DataFrame, index: Column, tie: Sequence[Column], shards: int, strands: int = STRANDS) -> DataFrame:
    """The rows with ``shard`` and ``slot``: runs of the curve, row counts at most one apart.

    ``index`` orders the rows and takes a bounded number of values; ``tie`` orders rows of one
    cell. Repeated rows take neighbouring slots. A null index counts as the first cell. An empty
    table gives an empty table.
    """
    placed = stored(
        rows.withColumns(
            {"_cell": F.coalesce(index, F.lit(-1)), "_strand": F.pmod(F.xxhash64(*tie), F.lit(strands)).cast("int")}
        ),
        "placed",
    )
    counts = placed.groupBy("_cell", "_strand").agg(F.count("*").alias("_n"))
    in_cell = Window.partitionBy("_cell").orderBy("_strand").rowsBetween(Window.unboundedPreceding, -1)
    along = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)  # cells are bounded in number
    everywhere = Window.partitionBy()
    cells = (
        counts.groupBy("_cell")
        .agg(F.sum("_n").alias("_rows"))
        .select(
            "_cell",
            F.coalesce(F.sum("_rows").over(along), F.lit(0)).alias("_before"),
            F.sum("_rows").over(everywhere).alias("_total"),
        )
    )
    starts = (
        counts.withColumn("_earlier", F.coalesce(F.sum("_n").over(in_cell), F.lit(0)))
        .join(cells, "_cell")
        .select("_cell", "_strand", (F.col("_earlier") + F.col("_before")).alias("_first"), "_total")
    )
    place = F.row_number().over(Window.partitionBy("_cell", "_strand").orderBy(*tie)) - 1
    ranked = placed.withColumn("_place", place).join(starts, ["_cell", "_strand"])
    rank = F.col("_first") + F.col("_place")
    shard = F.expr(f"((_first + _place) * {shards}) div _total")
    first_slot = F.expr(f"(shard * _total + {shards - 1}) div {shards}")
    return (
        ranked.withColumn("shard", shard.cast("int"))
        .withColumn("slot", (rank - first_slot).cast("bigint"))
        .drop("_strand", "_place", "_first", "_total")
        .withColumnRenamed("_cell", "curve_index")
    )


def extents(sharded: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Each shard's range in every dimension: what a reader needs to skip shards."""
    return sharded.groupBy("shard").agg(
        F.count("*").alias("rows"),
        *(f(d).alias(f"{d}_{name}") for d in dims for name, f in (("min", F.min), ("max", F.max))),
    )


def shard_documents(docs: DataFrame, shards: int = 16, bits: int = BITS) -> DataFrame:
    """Documents along the curve through source, language and size.

    Size is the UTF-8 bytes of the text (null: none) plus one. Nulls in source or language are a
    category; a null doc_id sorts first in its strand. Columns: doc_id, size, text_crc32, the three
    coordinates, curve_index, shard, slot.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    size = (F.octet_length(text) + 1).cast("bigint")
    rows = docs.select(
        F.col("doc_id"),
        size.alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        category(F.col("source"), bits).alias("source_bin"),
        category(F.col("lang"), bits).alias("lang_bin"),
        magnitude(size, bits).alias("size_bin"),
    )
    index = hilbert_index([F.col("source_bin"), F.col("lang_bin"), F.col("size_bin")], bits)
    return shard_rows(rows, index, [F.col("doc_id"), F.col("text_crc32"), F.col("size")], shards)


def op9_hilbert_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 16 shards, law `rows`."""
    sharded = shard_documents(table(spark, sf_dir, "documents"))
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve_index",
        "source_bin",
        "lang_bin",
        "size_bin",
    )
