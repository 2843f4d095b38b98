"""Differences between two versions of page state."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import PAGE_KEY


def rows_only_in(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of one side that the other lacks; NULLs are equal."""
    return left.subtract(right.select(*left.columns))


def differing_keys(live: DataFrame, shadow: DataFrame) -> DataFrame:
    """Keys whose rows are not the same on both sides, by set operations."""
    return (
        rows_only_in(live, shadow).select(*PAGE_KEY).union(rows_only_in(shadow, live).select(*PAGE_KEY)).distinct()
    )


def compare_states(live: DataFrame, shadow: DataFrame) -> DataFrame:
    """Per key: is it on each side, and which columns differ. One shuffle per side."""
    values = [c for c in live.columns if c not in PAGE_KEY]
    a = live.select(*PAGE_KEY, F.struct(*values).alias("a"))
    b = shadow.select(*PAGE_KEY, F.struct(*values).alias("b"))
    differs = F.array_compact(
        F.array(*[F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in values])
    )
    return a.join(b, PAGE_KEY, "full_outer").select(
        *PAGE_KEY,
        F.col("a").isNotNull().alias("in_live"),
        F.col("b").isNotNull().alias("in_shadow"),
        differs.alias("differing"),
    )


def discrepancy_count(live: DataFrame, shadow: DataFrame) -> DataFrame:
    """Number of keys that differ in a column or exist on one side only, as one row."""
    wrong = ~F.col("in_live") | ~F.col("in_shadow") | (F.size("differing") > 0)
    return compare_states(live, shadow).agg(F.count_if(wrong).alias("discrepancy_count"))


def state_check(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Per page and column, whether the actual value equals the expected one; absent pages fail."""
    values = [c for c in expected.columns if c not in PAGE_KEY]
    a = actual.select(*PAGE_KEY, F.struct(*values).alias("a"))
    e = expected.select(*PAGE_KEY, F.struct(*values).alias("e"))
    oks = [F.col(f"a.{c}").eqNullSafe(F.col(f"e.{c}")).alias(f"{c}_ok") for c in values]
    both = F.col("a").isNotNull() & F.col("e").isNotNull()
    joined = a.join(e, PAGE_KEY, "full_outer").select(*PAGE_KEY, both.alias("in_both"), *oks)
    return joined.withColumn("all_ok", reduce(lambda x, y: x & y, [F.col(f"{c}_ok") for c in values], F.col("in_both")))


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """True if both hold the same rows equally often."""
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
