"""Threshold-scaled sketches of documents.

A document's shingles are its runs of five lower-cased words (with fewer words, the whole sequence).
A shingle's hash is 48 bits wide. The sketch keeps every distinct hash below a fixed fraction of the
hash range, and in any case the ``floor`` smallest ones, so that a short text is kept whole. Each
sketch has a threshold below which it knows *all* hashes of its document: the fixed one, or, where
the floor reached further, one above its last hash; a sketch that kept all has none. Two sketches are compared below
the smaller of their thresholds, which estimates resemblance and containment also for documents of
very different length, and the sketch of a union of shingle sets is made from their sketches.

Column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import table, tasks

WORDS = 5
FRACTION = 1 / 8
FLOOR = 64
HASH_BITS = 48
EVERYTHING = 1 << HASH_BITS


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """Distinct 48-bit shingle hashes of a text, ascending. Null: none."""
    tokens = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[ \t\n\x0B\f\r]+"), lambda w: w != F.lit(""))
    hashed = F.transform(tokens, lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.size(h) - F.lit(words)),
            lambda at: F.xxhash64(*(F.get(h, at + F.lit(k)) for k in range(words))),
        )
        whole = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(h) >= words, runs).otherwise(whole)

    narrowed = F.transform(let(hashed, shingles), lambda x: F.shiftrightunsigned(x, 64 - HASH_BITS))
    return F.sort_array(F.array_distinct(narrowed))


def sketch(text: Column, fraction: float = FRACTION, floor: int = FLOOR) -> Column:
    """struct(hashes, below, shingles): the kept hashes, the threshold under which none is missing,
    and the number of distinct shingles."""
    limit = F.lit(int(EVERYTHING * fraction))

    def cut(h: Column) -> Column:
        kept = F.filter(h, lambda x, at: (x < limit) | (at < F.lit(floor)))
        return let(
            kept,
            lambda k: F.struct(
                k.alias("hashes"),
                F.when(F.size(k) == F.size(h), F.lit(EVERYTHING))
                .otherwise(F.greatest(limit, F.get(k, F.size(k) - F.lit(1)) + F.lit(1)))
                .alias("below"),
                F.size(h).alias("shingles"),
            ),
        )

    return let(shingle_hashes(text), cut)


def merged(a: Column, b: Column) -> Column:
    """Sketch of the union of two shingle sets; ``shingles`` is then an estimate."""

    def union(below: Column) -> Column:
        kept = F.filter(F.sort_array(F.array_union(a["hashes"], b["hashes"])), lambda x: x < below)
        scale = F.lit(float(EVERYTHING)) / below
        return F.struct(
            kept.alias("hashes"), below.alias("below"), F.round(F.size(kept) * scale).cast("int").alias("shingles")
        )

    return let(F.least(a["below"], b["below"]), union)


def _compared(a: Column, b: Column, ratio) -> Column:
    def below(limit: Column) -> Column:
        left, right = (F.filter(s["hashes"], lambda x: x < limit) for s in (a, b))
        return let(
            F.struct(F.size(left).alias("a"), F.size(right).alias("b"), F.size(F.array_intersect(left, right)).alias("both")),
            ratio,
        )

    return let(F.least(a["below"], b["below"]), below)


def resemblance(a: Column, b: Column) -> Column:
    """Estimated share of common shingles among all of both (0 to 1); 1 for two empty sets."""
    return _compared(
        a,
        b,
        lambda n: F.when(n["a"] + n["b"] == 0, (a["shingles"] + b["shingles"] == 0).cast("double")).otherwise(
            n["both"] / (n["a"] + n["b"] - n["both"])
        ),
    )


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has too; 1 for an empty ``a``."""
    return _compared(
        a,
        b,
        lambda n: F.when(n["a"] == 0, (a["shingles"] == 0).cast("double")).otherwise(n["both"] / n["a"]),
    )


def as_text(s: Column) -> Column:
    """The sketch as text: shingle count, a colon, the kept hashes in 12 hexadecimal digits each."""
    digits = F.transform(s["hashes"], lambda x: F.lpad(F.hex(x), HASH_BITS // 4, "0"))
    return F.lower(F.concat(F.hex(s["shingles"]), F.lit(":"), F.array_join(digits, "")))


def with_next(docs: DataFrame, following: list[str], key: str = "doc_id") -> DataFrame:
    """Each row with ``next_<column>`` of the next row in descending key order (the last: of the first).

    Rows are dealt into key ranges by quantiles; a range's last row gets its successor from the
    first rows of the ranges, which are one row per range. Rows of equal key are ordered by the
    first column that is passed on; a null key comes last. A single row follows itself.
    """
    n = tasks(docs.sparkSession)
    place = F.coalesce(F.col(key), F.lit(-(1 << 63)))
    shares = F.array(*(F.lit((i + 1) / n) for i in range(n)))
    cuts = docs.select(place.alias("k")).agg(F.percentile_approx("k", shares, F.lit(100 * n)).alias("cuts")).first()["cuts"]
    cuts = sorted(set(cuts or []))
    jumps = [1 << b for b in reversed(range(len(cuts).bit_length()))]
    bound = F.array(*map(F.lit, cuts)) if cuts else F.array().cast("array<bigint>")
    # binary search: how many cuts lie below the key
    part = F.aggregate(
        F.array(*map(F.lit, jumps)) if jumps else F.array().cast("array<int>"),
        F.lit(0),
        lambda at, by: F.when(
            (at + by <= F.lit(len(cuts))) & (F.get(bound, at + by - F.lit(1)) < place), at + by
        ).otherwise(at),
    )
    dealt = docs.withColumn("_part", part)
    order = [place.desc(), F.col(following[0])]
    in_part = Window.partitionBy("_part").orderBy(*order)
    placed = dealt.withColumns(
        {"_last": F.lead(F.lit(False), 1, True).over(in_part)}
        | {f"next_{c}": F.lead(c).over(in_part) for c in following}
    )
    tops = dealt.groupBy("_part").agg(F.max(place).alias("_top"))
    # one row per range, so small enough to send to every task
    at_top = (F.col("_part") == F.col("_tp")) & (place == F.col("_top"))
    heads = (
        dealt.join(F.broadcast(tops.withColumnRenamed("_part", "_tp")), at_top, "left_semi")
        .withColumn("_row", F.row_number().over(in_part))
        .filter("_row = 1")
    )
    around = Window.orderBy(F.col("_part").desc())  # one row per range
    ends = Window.orderBy(F.col("_part").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = heads.select(
        "_part",
        *(F.coalesce(F.lead(c).over(around), F.first(c).over(ends)).alias(f"_edge_{c}") for c in following),
    )
    return (
        placed.join(edges, "_part")
        .withColumns({f"next_{c}": F.when(F.col("_last"), F.col(f"_edge_{c}")).otherwise(F.col(f"next_{c}")) for c in following})
        .drop("_part", "_last", *(f"_edge_{c}" for c in following))
    )


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of whole texts (null: empty) and of their edited texts.

    The edited text has its last third replaced by the beginning of the next document in descending
    doc_id order.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("own", sketch(F.col("text")))
    chained = with_next(rows, ["text", "own"])
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    edited = chained.withColumn(
        "edited", F.concat(F.left("text", n - third), F.left("next_text", third))
    ).select("doc_id", "text", "own", "next_own", "edited", sketch(F.col("edited")).alias("changed"))
    own, changed, following = F.col("own"), F.col("changed"), F.col("next_own")
    return edited.select(
        "doc_id",
        F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(own).alias("fingerprint"),
        as_text(changed).alias("edited_fingerprint"),
        resemblance(own, changed).alias("near_edited"),
        resemblance(own, following).alias("near_next"),
        containment(changed, own).alias("edited_in_own"),
    )


def op6_threshold_sketch(spark, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))
