"""The read queries over the ledger (page_events) and the read model (page_state)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.instants import newer_than
from ..schemas import PAGE_KEY

FEED_LIMITS = (15, 100)
LEADERBOARD_LIMITS = (50, 200)
STATE_COLUMNS = ["edit_count", "net_byte_delta", "unique_editors", "last_editor", "created_at", "last_edited_at"]


def checked_limit(limit: int, highest: int) -> int:
    if not 1 <= limit <= highest:
        raise ValueError(f"limit must be between 1 and {highest}, got {limit}")
    return limit


def as_of(moment) -> Column:
    """An instant as a column; None means now."""
    if isinstance(moment, Column):
        return moment
    return F.current_timestamp() if moment is None else F.lit(moment).cast("timestamp")


def events_per_minute(page_events: DataFrame, asof=None) -> DataFrame:
    recent = page_events.filter(newer_than(F.col("ingested_at"), as_of(asof), "1 MINUTE"))
    return recent.agg(F.count("*").alias("events_per_min"))


def pages_tracked(page_state: DataFrame) -> DataFrame:
    return page_state.agg(F.count("*").alias("pages_tracked"))


def editors_seen(page_events: DataFrame) -> DataFrame:
    return page_events.agg(F.countDistinct("editor").alias("editors_seen"))


#: log2 of the registers of an editor sketch
SKETCH_BITS = 12
#: three standard errors of such a sketch, 1.04 / sqrt(registers) each: its estimate's relative error
#: is larger in about three of a thousand
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def editor_sketches(page_events: DataFrame) -> DataFrame:
    """``day, events, editors``: per UTC day of the event time, a sketch of its editors of bounded size.

    Sketches merge: ``editors_in`` gives the editors of any set of days without the ledger. Events without a
    time make a day of their own, null.
    """
    return page_events.groupBy(F.to_date("occurred_at").alias("day")).agg(
        F.count("*").alias("events"), F.hll_sketch_agg("editor", SKETCH_BITS).alias("editors")
    )


def editors_in(sketches: DataFrame, *keys: Column) -> DataFrame:
    """``keys, editors_estimate`` from the sketches of the days that share the keys; without keys, of all days."""
    merged = F.hll_sketch_estimate(F.hll_union_agg("editors"))
    return sketches.groupBy(*keys).agg(F.coalesce(merged, F.lit(0)).cast("bigint").alias("editors_estimate"))


def editors_by_day(page_events: DataFrame) -> DataFrame:
    """``day, editors``, counted exactly, and in the row without a day all of them."""
    per_editor = page_events.select(F.to_date("occurred_at").alias("day"), "editor").distinct()
    return per_editor.rollup("day").agg(F.countDistinct("editor").alias("editors"))


def total_events(page_events: DataFrame) -> DataFrame:
    return page_events.agg(F.count("*").alias("total_events"))


def stats(page_events: DataFrame, page_state: DataFrame, asof=None) -> DataFrame:
    """The four summary numbers as one row, from one pass over the ledger."""
    recent = newer_than(F.col("ingested_at"), as_of(asof), "1 MINUTE")
    # per editor first: the distinct count is then a plain row count
    per_editor = page_events.groupBy("editor").agg(F.count_if(recent).alias("recent"), F.count("*").alias("events"))
    return per_editor.agg(
        F.coalesce(F.sum("recent"), F.lit(0)).alias("events_per_min"),
        F.count("*").alias("editors_seen"),
        F.coalesce(F.sum("events"), F.lit(0)).alias("total_events"),
    ).select("events_per_min", pages_tracked(page_state).scalar().alias("pages_tracked"), "editors_seen", "total_events")


def feed(page_events: DataFrame, limit: int = FEED_LIMITS[0]) -> DataFrame:
    """The events taken in last, newest first."""
    checked_limit(limit, FEED_LIMITS[1])
    return (
        page_events.orderBy(F.desc("ingested_at"), F.desc("ingest_seq"))
        .limit(limit)
        .select("wiki", "page_title", "event_type", "editor", "byte_delta", "occurred_at", "ingested_at")
    )


def leaderboard(page_state: DataFrame, limit: int = LEADERBOARD_LIMITS[0]) -> DataFrame:
    """The pages edited last; equal times in key order."""
    checked_limit(limit, LEADERBOARD_LIMITS[1])
    return (
        page_state.orderBy(F.desc("last_edited_at"), *PAGE_KEY)
        .limit(limit)
        .select(*PAGE_KEY, *STATE_COLUMNS[:4], "created_at", "last_edited_at", "is_deleted")
    )


def of_page(rows: DataFrame, wiki: str, page_title: str) -> DataFrame:
    return rows.filter((F.col("wiki") == wiki) & (F.col("page_title") == page_title))


def page_history(page_events: DataFrame, wiki: str, page_title: str) -> DataFrame:
    """All events of one page in order of event time."""
    return (
        of_page(page_events, wiki, page_title)
        .orderBy("occurred_at", "ingest_seq")
        .select("event_type", "editor", "byte_delta", "revision_id", "occurred_at")
    )


def page_current(page_state: DataFrame, wiki: str, page_title: str) -> DataFrame:
    """Current state of one page, no row if the page is unknown."""
    return of_page(page_state, wiki, page_title).select(*STATE_COLUMNS)


def history_with_state(page_events: DataFrame, page_state: DataFrame, hot_edits: int = 1_000_000) -> DataFrame:
    """Every ledger event beside the current state of its page, which may be absent.

    Page state holds a page once, so the join does not multiply rows. Pages of more than ``hot_edits`` edits
    are at most that part of all edits in number: their states are broadcast, and their events stay
    where they lie. All other events meet their state by page.
    """
    events = page_events.select(
        *PAGE_KEY, "ingest_seq", "event_type", "editor", "byte_delta", "revision_id", "occurred_at"
    )
    state = page_state.select(*PAGE_KEY, *STATE_COLUMNS)
    hot = F.broadcast(state.filter(F.col("edit_count") > hot_edits))
    others = state.filter(F.coalesce(F.col("edit_count") <= hot_edits, F.lit(True)))
    of_others = events.join(hot.select(*PAGE_KEY), PAGE_KEY, "left_anti").join(others, PAGE_KEY, "left")
    return events.join(hot, PAGE_KEY).unionAll(of_others)


def exists(rows: DataFrame) -> bool:
    """True if there is any row; stops at the first."""
    return not rows.limit(1).isEmpty()


def canonical(page_state: DataFrame) -> DataFrame:
    """Page state in key order, for comparing snapshots side by side."""
    return page_state.orderBy(*PAGE_KEY)
