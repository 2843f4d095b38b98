"""The registered queries: every operator run over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import instants
from ..operators import audit, compare, dedup, fold, ingest, reads, validate
from ..schemas import LEDGER_KEY, PAGE_EVENTS, PAGE_KEY, PAGE_STATE, REBUILD_LOG, VALID, stored_at
from ..session import configure, new_run_dir
from ..sinks import layouts
from ..sinks.event_logs import EventLogs, append_raw_log, publish_counted, published_counts
from ..sinks.page_state import PageStateTable
from ..sinks.rebuild_log import RebuildLog
from ..sources import logs
from ..sources.testdata import events_table, raw_events
from ..streaming.fold_stream import start_fold
from ..streaming.validate_stream import start_validation
from .rebuild import Rebuild

# the derived log has one arrival per 10 milliseconds from here on
ARRIVAL_START = "2024-03-01 00:00:00"
ARRIVAL_MILLIS = 10


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.classify(raw_events(spark, sf_dir))


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.valid_events(_classified(spark, sf_dir))


def _valid_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The valid log as a table, with the mark of the ingest filter, for queries that read it more
    than once: the records are then parsed once."""
    path = new_run_dir(spark, "valid")
    records = ingest.read_ingest_fields(raw_events(spark, sf_dir))
    classified = validate.classify(records, keep=("accepted",)).filter("reason IS NULL")
    classified.select(*VALID.fieldNames(), "accepted").write.parquet(path)
    return spark.read.schema(stored_at(VALID, T.StructField("accepted", T.BooleanType()))).parquet(path)


def _arrival(seq: Column) -> Column:
    start = F.unix_micros(F.lit(ARRIVAL_START).cast("timestamp"))
    return F.timestamp_micros(start + seq * (ARRIVAL_MILLIS * 1000))


def _ledger(valid: DataFrame) -> DataFrame:
    first = dedup.first_arrival(valid, LEDGER_KEY)
    return validate.to_page_events(first, _arrival(F.col("ingest_seq")))


def _asof(spark: SparkSession, sf_dir: str) -> Column:
    """When all first deliveries had arrived."""
    return _arrival(events_table(spark, sf_dir).agg(F.count("*")).scalar())


def _zoneless(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock time, so that results compare across engines."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else f.name
            for f in df.schema.fields
        ]
    )


# --- ingest ---
def ingest_counts(spark, sf_dir):
    return ingest.seen_and_sent(raw_events(spark, sf_dir))


def accept_filter(spark, sf_dir):
    return ingest.accept(raw_events(spark, sf_dir)).select("ingest_seq", "epoch_seconds")


def publish(spark, sf_dir):
    return ingest.to_raw_log(ingest.accept(raw_events(spark, sf_dir)))


def replay_pacing(spark, sf_dir):
    accepted = ingest.accept(raw_events(spark, sf_dir))
    return ingest.replay_schedule(accepted, speed=4.0, rows_per_slice=1000, slices_per_block=4).drop("epoch_seconds")


def jsonl_scan(spark, sf_dir):
    path = new_run_dir(spark, "jsonl")
    # a blank line after every record, as captured files may have
    raw_events(spark, sf_dir).select("value").write.option("lineSep", "\n\n").text(path)
    return logs.jsonl_records(spark, path)


def sse_scan(spark, sf_dir):
    path = new_run_dir(spark, "sse")
    two_lines = F.regexp_replace("value", ',"wiki"', ',\ndata:  "wiki"')
    data = F.when(F.col("ingest_seq") % 2 == 0, two_lines).otherwise(F.col("value"))
    id_line = F.concat(F.lit("id: "), F.col("ingest_seq").cast("string"), F.lit("\n"))
    number = F.when(F.col("ingest_seq") % 3 == 0, "").otherwise(id_line)
    frame = F.concat(F.lit("event: message\n"), number, F.lit("data: "), data)
    raw_events(spark, sf_dir).select(frame.alias("value")).write.option("lineSep", "\n\n").text(path)
    return logs.sse_events(logs.sse_frames(spark, path))


def sse_resume(spark, sf_dir):
    """The id to go on from after the captured stream, whose ids rise."""
    return logs.last_event_id(sse_scan(spark, sf_dir).withColumn("number", F.col("event_id").cast("bigint")), "number")


def delivery_counts(spark, sf_dir):
    """The raw log published in its three deliveries: what each saw, sent, delivered and failed to."""
    path = new_run_dir(spark, "published")
    records = raw_events(spark, sf_dir)
    n = events_table(spark, sf_dir).agg(F.count("*")).scalar()
    for k in range(3):
        publish_counted(records.filter(F.expr("ingest_seq") >= k * n).filter(F.expr("ingest_seq") < (k + 1) * n), path)
    return published_counts(spark, path).drop("published_at")


# --- validation ---
def validate_reasons(spark, sf_dir):
    return validate.counts_by_reason(_classified(spark, sf_dir))


def classify_records(spark, sf_dir):
    reason = F.col("reason")
    return _classified(spark, sf_dir).select("ingest_seq", reason.isNull().alias("is_ok"), "reason")


def valid_events(spark, sf_dir):
    return _zoneless(_valid(spark, sf_dir))


def valid_json(spark, sf_dir):
    return validate.to_valid_json(_valid(spark, sf_dir))


def valid_json_read_back(spark, sf_dir):
    return _zoneless(validate.from_valid_json(validate.to_valid_json(_valid(spark, sf_dir))))


def first_deadletter(spark, sf_dir):
    """The earliest dead letter without a revision."""
    return logs.first_match(validate.dead_letters(_classified(spark, sf_dir)), F.col("reason") == "missing_revision")


def deadletter(spark, sf_dir):
    return validate.dead_letters(_classified(spark, sf_dir))


def deadletter_json(spark, sf_dir):
    return validate.to_deadletter_json(validate.dead_letters(_classified(spark, sf_dir)))


def parse_instants(spark, sf_dir):
    """The event times written in the forms of ISO-8601 that occur, and read back."""
    form, ts = F.col("event_id") % 12, F.col("ts")
    shifted = ts + F.expr("INTERVAL 2 HOURS")
    full = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    # the year of an ISO week is that of its Thursday
    monday = F.date_trunc("week", "ts")
    week_date = F.concat(
        F.date_format(F.date_add(monday, 3), "yyyy"),
        F.format_string("-W%02d-%d", F.weekofyear("ts"), F.weekday("ts") + 1),
        F.date_format(ts, "'T'HH:mm:ss.SSSSSS"),
    )
    text = (
        F.when(form == 0, F.date_format(ts, full + "'Z'"))
        .when(form == 1, F.date_format(ts, full + "'+00:00'"))
        .when(form == 2, F.date_format(shifted, full + "'+0200'"))
        .when(form == 3, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(form == 4, F.date_format(shifted, "yyyy-MM-dd'T'HH:mm'+02:00'"))
        .when(form == 5, F.date_format(ts, "HH:mm"))
        .when(form == 6, F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'"))
        .when(form == 7, F.date_format(ts, "yyyy-MM-dd'T'HH'Z'"))
        .when(form == 8, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss,SSSSSS'9999Z'"))
        .when(form == 9, F.date_format(shifted, "yyyyMMdd HHmmss.SSSSSS'+020000'"))
        .when(form == 10, week_date)
        .otherwise(F.date_format(ts, "yyyy-MM"))
    )
    parsed = instants.parse_iso(text)
    return _zoneless(events_table(spark, sf_dir).select("event_id", parsed.alias("instant")))


def epoch_instants(spark, sf_dir):
    """Event times as epoch seconds and back to an instant and its text."""
    seconds = F.unix_micros(F.date_trunc("second", "ts").cast("timestamp")) / 1_000_000 + (F.col("event_id") % 4) / 4
    instant = instants.from_epoch(seconds)
    rows = events_table(spark, sf_dir).select("event_id", instant.alias("instant"))
    return _zoneless(rows.withColumn("iso", instants.to_iso(F.col("instant"))))


# --- ledger and fold ---
def ledger_dedup(spark, sf_dir):
    return _zoneless(_ledger(_valid(spark, sf_dir)))


def page_state(spark, sf_dir):
    return _zoneless(fold.fold_pages(_valid(spark, sf_dir)))


def page_state_sorted(spark, sf_dir):
    return _zoneless(reads.canonical(fold.fold_pages(_valid(spark, sf_dir))))


def fold_dedup_vs_ledger(spark, sf_dir):
    """Per page, the events that count in the fold and in the ledger: two identities of an event."""
    valid = _valid_table(spark, sf_dir)
    in_fold = fold.fold_pages(valid).select(*PAGE_KEY, F.col("edit_count").alias("fold_events"))
    in_ledger = _ledger(valid).groupBy(*PAGE_KEY).agg(F.count("*").alias("ledger_events"))
    return in_fold.join(in_ledger, PAGE_KEY, "full_outer").select(
        *PAGE_KEY, "fold_events", F.coalesce("ledger_events", F.lit(0)).alias("ledger_events")
    )


def changelog(spark, sf_dir):
    return _zoneless(fold.changelog(_valid(spark, sf_dir)))


def changelog_in_slices(spark, sf_dir):
    """The same where pages are larger than one task takes."""
    return _zoneless(fold.changelog(_valid(spark, sf_dir), max_rows_per_task=16))


def sample_fold(spark, sf_dir):
    accepted = validate.classify(ingest.accept(raw_events(spark, sf_dir)))
    return _zoneless(fold.fold_accepted_by_title(validate.valid_events(accepted)))


def upsert(spark, sf_dir):
    """State after the first deliveries, with the pages of later deliveries brought up to date."""
    valid = _valid_table(spark, sf_dir)
    later = F.col("ingest_seq") >= events_table(spark, sf_dir).agg(F.count("*")).scalar()
    before = fold.fold_pages(valid.filter(~later))
    touched = valid.filter(later).select(*PAGE_KEY).distinct()
    updates = fold.fold_pages(valid).join(touched, PAGE_KEY, "left_semi")
    return _zoneless(dedup.upsert(before, updates, PAGE_KEY))


# --- reads ---
def stats(spark, sf_dir):
    valid = _valid_table(spark, sf_dir)
    return reads.stats(_ledger(valid), fold.fold_pages(valid), _asof(spark, sf_dir))


def events_per_min(spark, sf_dir):
    return reads.events_per_minute(_ledger(_valid(spark, sf_dir)), _asof(spark, sf_dir))


def pages_tracked(spark, sf_dir):
    return reads.pages_tracked(fold.fold_pages(_valid(spark, sf_dir)))


def editors_seen(spark, sf_dir):
    return reads.editors_seen(_ledger(_valid(spark, sf_dir)))


def total_events(spark, sf_dir):
    return reads.total_events(_ledger(_valid(spark, sf_dir)))


def feed(spark, sf_dir):
    return _zoneless(reads.feed(_ledger(_valid(spark, sf_dir))))


def leaderboard(spark, sf_dir):
    return _zoneless(reads.leaderboard(fold.fold_pages(_valid(spark, sf_dir))))


def page_history(spark, sf_dir):
    return _zoneless(reads.page_history(_ledger(_valid(spark, sf_dir)), "enwiki", "page-7"))


def page_current(spark, sf_dir):
    return _zoneless(reads.page_current(fold.fold_pages(_valid(spark, sf_dir)), "enwiki", "page-7"))


def history_with_state(spark, sf_dir):
    valid = _valid_table(spark, sf_dir)
    return _zoneless(reads.history_with_state(_ledger(valid), fold.fold_pages(valid)))


def _laid_out(spark, sf_dir, valid: DataFrame, layout: type[layouts.Layout], size: int) -> layouts.Layout:
    """The ledger of the valid log in a layout, written in three batches by range of arrival."""
    # stored once: cut by arrival, each batch would take the first arrivals of the whole log again
    path = new_run_dir(spark, "ledger")
    _ledger(valid).write.parquet(path)
    ledger = logs.table(spark, path, PAGE_EVENTS)
    found = layout(spark, new_run_dir(spark, "ledger-layout"), PAGE_EVENTS, size)
    n = events_table(spark, sf_dir).agg(F.count("*")).scalar()
    seq = F.col("ingest_seq")
    for k, batch in enumerate((seq < n, (seq >= n) & (seq < 2 * n), seq >= 2 * n)):
        found.append(ledger.filter(batch), "first", k)
    return found


def feed_stored(spark, sf_dir):
    events = _laid_out(spark, sf_dir, _valid_table(spark, sf_dir), layouts.ByTime, 30)
    return _zoneless(layouts.feed(events))


def events_per_min_stored(spark, sf_dir):
    events = _laid_out(spark, sf_dir, _valid_table(spark, sf_dir), layouts.ByTime, 30)
    return layouts.events_per_minute(events, _asof(spark, sf_dir))


def page_history_stored(spark, sf_dir):
    events = _laid_out(spark, sf_dir, _valid_table(spark, sf_dir), layouts.ByPage, 16)
    return _zoneless(layouts.page_history(events, "enwiki", "page-7"))


def page_lookup(spark, sf_dir):
    valid = _valid_table(spark, sf_dir)
    events = _laid_out(spark, sf_dir, valid, layouts.ByPage, 16)
    state = layouts.ByPage(spark, new_run_dir(spark, "state-layout"), PAGE_STATE, 16)
    state.append(fold.fold_pages(valid), "first", 0)
    return _zoneless(layouts.page_lookup(events, state, "enwiki", "page-7"))


def editors_by_day(spark, sf_dir):
    """Editors of each day and, in the row without a day, of all: the exact count, and whether merged
    sketches keep their error bound."""
    ledger = _ledger(_valid_table(spark, sf_dir))
    path = new_run_dir(spark, "editor-sketches")
    reads.editor_sketches(ledger).write.parquet(path)
    sketches = spark.read.parquet(path)
    every = reads.editors_in(sketches, F.col("day")).unionAll(
        reads.editors_in(sketches).select(F.lit(None).cast("date"), "editors_estimate")
    )
    both = reads.editors_by_day(ledger).alias("e").join(every.alias("s"), F.expr("e.day <=> s.day"))
    off = F.abs(F.col("editors_estimate") - F.col("editors"))
    within = off <= F.greatest(F.lit(1), F.ceil(F.col("editors") * reads.SKETCH_ERROR))
    return both.select("e.day", "editors", within.alias("sketch_within_bound"))


# --- comparison ---
def _two_states(spark, sf_dir):
    """State of the accepted events, and state of all."""
    valid = _valid_table(spark, sf_dir)
    return fold.fold_pages(valid.filter("accepted")), fold.fold_pages(valid)


def discrepancy(spark, sf_dir):
    return compare.discrepancy_count(*_two_states(spark, sf_dir))


def set_diff_rows(spark, sf_dir):
    live, shadow = _two_states(spark, sf_dir)
    return _zoneless(compare.rows_only_in(live, shadow))


def set_diff_keys(spark, sf_dir):
    return compare.differing_keys(*_two_states(spark, sf_dir))


def compare_states(spark, sf_dir):
    compared = compare.compare_states(*_two_states(spark, sf_dir))
    return compared.withColumn("differing", F.array_join("differing", ","))


def same_states(spark, sf_dir):
    """Whether the state is the one folded from the log dealt otherwise, and the one before the repeats."""
    valid = _valid_table(spark, sf_dir)
    n = events_table(spark, sf_dir).agg(F.count("*")).scalar()
    state, again = fold.fold_pages(valid), fold.fold_pages(valid.repartition("editor"))
    before = fold.fold_pages(valid.filter(F.col("ingest_seq") < n))
    same, earlier = compare.same_rows(state, again), compare.same_rows(state, before)
    return spark.range(1).select(F.lit(same).alias("same_again"), F.lit(earlier).alias("same_before"))


def page_exists(spark, sf_dir):
    """Whether the ledger has events of a page that occurs, and of one that does not."""
    ledger = _ledger(_valid(spark, sf_dir))
    known, unknown = (reads.exists(reads.of_page(ledger, "enwiki", title)) for title in ("page-7", "no such page"))
    return spark.range(1).select(F.lit(known).alias("known"), F.lit(unknown).alias("unknown"))


def state_check(spark, sf_dir):
    """Folded state of the accepted events against the independent fold of the sample."""
    accepted = _valid_table(spark, sf_dir).filter("accepted")
    expected = fold.fold_accepted_by_title(accepted).withColumn("wiki", F.lit("enwiki"))
    return compare.state_check(fold.fold_pages(accepted), expected)


# --- rebuild audit: attempts derived from the orders table ---
def rebuild_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An audit log with an attempt per order: open orders still run, the others ended."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    started = F.col("o_orderdate").cast("timestamp")
    ended = F.col("o_orderstatus") != "O"
    steps = F.array(
        F.struct(
            F.lit(0).alias("step"),
            F.lit("running").alias("status"),
            F.lit(None).cast("timestamp").alias("completed_at"),
        ),
        F.when(
            ended,
            F.struct(
                F.lit(1).alias("step"),
                F.when(F.col("o_orderstatus") == "F", "succeeded").otherwise("failed").alias("status"),
                (started + F.expr("INTERVAL 1 HOUR")).alias("completed_at"),
            ),
        ),
    )
    rows = orders.select(
        F.col("o_orderkey").cast("bigint").alias("id"),
        started.alias("started_at"),
        F.col("o_custkey").cast("bigint").alias("customer"),
        F.inline(F.array_compact(steps)),
    )
    message = instants.short_error(F.repeat(F.lit("stalled "), 200))
    return rows.select(
        "id",
        "step",
        "started_at",
        "completed_at",
        "status",
        F.when(F.col("status") == "succeeded", F.col("customer")).alias("events_replayed"),
        F.when(F.col("status") == "succeeded", F.lit(0)).cast("bigint").alias("discrepancy_count"),
        F.when(F.col("status") == "failed", message).alias("error_message"),
    ).select(*REBUILD_LOG.fieldNames())


def rebuild_current(spark, sf_dir):
    return _zoneless(audit.current_status(rebuild_attempts(spark, sf_dir)))


def rebuild_latest(spark, sf_dir):
    return _zoneless(audit.latest_attempt(rebuild_attempts(spark, sf_dir)))


def rebuild_guard(spark, sf_dir):
    last = spark.read.parquet(f"{sf_dir}/orders.parquet").agg(F.max("o_orderdate").cast("timestamp")).scalar()
    return audit.start_guard(rebuild_attempts(spark, sf_dir), last)


def rebuild_guard_answers(spark, sf_dir):
    """The guard's answers while attempts run, just after the last one ended, and a minute after it."""
    log = rebuild_attempts(spark, sf_dir)
    ended = log.join(log.filter("step = 1").select("id"), "id", "left_semi")
    last = log.agg(F.max("completed_at")).scalar()
    cases = (("running", log, 60), ("cooling", ended, 10), ("rested", ended, 60))
    answers = [
        audit.start_guard(rows, last + F.expr(f"INTERVAL {seconds} SECONDS")).select(F.lit(name).alias("moment"), "*")
        for name, rows, seconds in cases
    ]
    return answers[0].unionAll(answers[1]).unionAll(answers[2])


def rebuild_progress(spark, sf_dir):
    """Per page, the share of its valid records (copies too) that the ledger holds."""
    valid = _valid_table(spark, sf_dir)
    total = valid.groupBy(*PAGE_KEY).agg(F.count("*").alias("total"))
    processed = _ledger(valid).groupBy(*PAGE_KEY).agg(F.count("*").alias("processed"))
    both = total.join(processed, PAGE_KEY, "left")
    return both.select(*PAGE_KEY, audit.progress(F.coalesce("processed", F.lit(0)), F.col("total")).alias("progress"))


# --- the streams, drained over the derived log ---
def _stream_ledger(spark: SparkSession, sf_dir: str, everything: bool = False) -> tuple[EventLogs, str]:
    """Publish the accepted events, or all, in their deliveries, and drain the validation stream over them."""
    root = new_run_dir(spark, "streams")
    records = raw_events(spark, sf_dir)
    chosen = ingest.read_ingest_fields(records) if everything else ingest.accept(records)
    append_raw_log(ingest.to_raw_log(chosen), f"{root}/published")
    published = logs.raw_log(spark, f"{root}/published")
    n = events_table(spark, sf_dir).agg(F.count("*")).scalar()
    # files are taken in the order they were written: first deliveries, repeats, moved copies
    seq = F.col("ingest_seq")
    for part in (seq < n, (seq >= n) & (seq < 2 * n), seq >= 2 * n):
        append_raw_log(published.filter(part), f"{root}/raw")
    events = EventLogs(spark, root)
    raw = logs.raw_log_stream(spark, f"{root}/raw", max_files=8)
    start_validation(spark, raw, events, f"{root}/checkpoints/validate", drain=True).awaitTermination()
    return events, root


def _stream_state(spark: SparkSession, sf_dir: str) -> tuple[EventLogs, PageStateTable, str]:
    events, root = _stream_ledger(spark, sf_dir)
    target = PageStateTable(spark, f"{root}/page_state", buckets=8)
    valid = logs.valid_log_stream(spark, events.valid_path)
    start_fold(spark, valid, target, f"{root}/checkpoints/fold", drain=True).awaitTermination()
    return events, target, root


def stream_ledger(spark, sf_dir):
    events, _ = _stream_ledger(spark, sf_dir)
    return _zoneless(events.page_events().drop("ingested_at", "run_id", "batch_id", "rev_range"))


def stream_deadletter(spark, sf_dir):
    events, _ = _stream_ledger(spark, sf_dir)
    return events.deadletter().drop("run_id", "batch_id")


def stream_deadletter_raw(spark, sf_dir):
    """The dead letters of the whole raw log, also of what the ingest filter would keep out."""
    events, _ = _stream_ledger(spark, sf_dir, everything=True)
    return events.deadletter().drop("run_id", "batch_id")


def stream_ingested_at(spark, sf_dir):
    """Ledger events, and those stamped with a time while the stream ran."""
    before = datetime.now(timezone.utc)
    events, _ = _stream_ledger(spark, sf_dir)
    during = F.col("ingested_at").between(F.lit(before), F.current_timestamp())
    return events.page_events().agg(F.count("*").alias("events"), F.count_if(during).alias("stamped"))


def stream_page_state(spark, sf_dir):
    _, target, _ = _stream_state(spark, sf_dir)
    return _zoneless(target.read())


def rebuild(spark, sf_dir):
    """Rebuild the streamed state from its log: the audit row, and the state it left."""
    events, target, root = _stream_state(spark, sf_dir)
    log = RebuildLog(spark, root)
    Rebuild(log, target).run(events.valid())
    outcome = audit.latest_attempt(log.read()).select("id", "status", "events_replayed", "discrepancy_count")
    state = target.read()
    pages, edits = state.agg(F.count("*")).scalar(), state.agg(F.sum("edit_count")).scalar()
    return outcome.withColumn("pages", pages).withColumn("edits", edits)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        ingest_counts,
        accept_filter,
        publish,
        replay_pacing,
        jsonl_scan,
        sse_scan,
        sse_resume,
        delivery_counts,
        validate_reasons,
        classify_records,
        valid_events,
        valid_json,
        valid_json_read_back,
        deadletter,
        first_deadletter,
        deadletter_json,
        parse_instants,
        epoch_instants,
        ledger_dedup,
        page_state,
        page_state_sorted,
        fold_dedup_vs_ledger,
        changelog,
        changelog_in_slices,
        sample_fold,
        upsert,
        stats,
        events_per_min,
        pages_tracked,
        editors_seen,
        total_events,
        feed,
        leaderboard,
        page_history,
        page_current,
        history_with_state,
        feed_stored,
        events_per_min_stored,
        page_history_stored,
        page_lookup,
        editors_by_day,
        discrepancy,
        set_diff_rows,
        set_diff_keys,
        compare_states,
        state_check,
        same_states,
        page_exists,
        rebuild_guard_answers,
        stream_deadletter_raw,
        stream_ingested_at,
        rebuild_current,
        rebuild_latest,
        rebuild_guard,
        rebuild_progress,
        stream_ledger,
        stream_deadletter,
        stream_page_state,
        rebuild,
    )
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries by name; each sets the session options it relies on."""

    def prepared(query):
        return lambda spark, sf_dir: query(configure(spark), sf_dir)

    return {name: prepared(query) for name, query in QUERIES.items()}
