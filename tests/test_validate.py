"""Validation: every reason, every boundary, and the inputs that are easy to get wrong."""

import random
from datetime import datetime, timezone
import json

import pytest
from pyspark.sql import functions as F

from quirefold.functions import instants
from quirefold.operators import ingest, validate
from support import event, raw, text

BIG = 9223372036854775808
CASES = [
    # not exactly one JSON value
    ("", "invalid_json"),
    ("   ", "invalid_json"),
    (None, "invalid_json"),
    (text() + " x", "invalid_json"),
    (text() + "]", "invalid_json"),
    (text() + "] junk}", "invalid_json"),
    (text() + "," + text(), "invalid_json"),
    ("{'r':1}", "invalid_json"),
    ("NaN", "invalid_json"),
    (text()[:30], "invalid_json"),
    ('{"n":01}', "invalid_json"),
    # JSON, but no object
    ("null", "not_object"),
    ('"str"', "not_object"),
    ("[1]", "not_object"),
    (" [1, 2] ", "not_object"),
    ("12", "not_object"),
    # type
    (text(type="log"), "bad_type"),
    (text(type=None), "bad_type"),
    (text(type=5), "bad_type"),
    ("{}", "bad_type"),
    # texts
    (text(user=""), "missing_field"),
    (text(wiki=None), "missing_field"),
    (text(title=None), "missing_field"),
    (text(user=5), "missing_field"),
    (json.dumps({**event(), "title": None}), "missing_field"),
    # revision
    (text(revision=None), "missing_revision"),
    (text(revision={}), "missing_revision"),
    (text(revision="x"), "missing_revision"),
    (text(revision=[1]), "missing_revision"),
    (text(revision={"new": 12.0}), "missing_revision"),
    (text(revision={"new": "12"}), "missing_revision"),
    (text(revision={"new": True}), "missing_revision"),
    (text(revision={"new": BIG}), "missing_revision"),
    # lengths
    (text(length=None), "bad_length"),
    (text(length="x"), "bad_length"),
    (text(length={"old": 1}), "bad_length"),
    (text(length={"old": "1", "new": 2}), "bad_length"),
    (text(length={"old": 1.5, "new": 2}), "bad_length"),
    (text(length={"old": 1, "new": 2.0}), "bad_length"),
    (text(length={"old": False, "new": 2}), "bad_length"),
    # byte delta
    (text(length={"old": 0, "new": 10_000_001}), "bad_byte_delta"),
    (text(length={"old": 10_000_001, "new": 0}), "bad_byte_delta"),
    (text(length={"old": -(2**63), "new": 2**63 - 1}), "bad_byte_delta"),
    (text(length={"old": 0, "new": -(2**63)}), "bad_byte_delta"),
    # event time
    (text(meta=None, timestamp=None), "missing_timestamp"),
    (text(meta={"dt": ""}, timestamp="1767225600"), "missing_timestamp"),
    (text(meta={"dt": 0}, timestamp=True), "missing_timestamp"),
    (text(meta={"dt": "garbage"}), "bad_timestamp"),
    (text(meta={"dt": "12:00"}), "bad_timestamp"),
    (text(meta={"dt": "2026-01"}), "bad_timestamp"),
    (text(meta={"dt": "2026-02-30T00:00:00Z"}), "bad_timestamp"),
    (text(meta={"dt": 5}), "bad_timestamp"),
    (text(meta=None, timestamp=1e18), "bad_timestamp"),
    (text(meta=None, timestamp=253402300800), "bad_timestamp"),
    # the first failing check wins
    (text(type="log", user="", revision=None), "bad_type"),
    (text(user="", revision=None, length=None), "missing_field"),
    (text(revision=None, length=None), "missing_revision"),
]


def test_reasons(spark):
    found = validate.classify(raw(spark, [value for value, _ in CASES])).orderBy("ingest_seq").collect()
    wrong = [(value, row.reason, reason) for (value, reason), row in zip(CASES, found) if row.reason != reason]
    assert not wrong
    assert {reason for _, reason in CASES} == set(validate.REASONS)


GOOD = [
    (text(), {}),
    (" " + text() + "\n", {}),
    (text(type="new"), {"event_type": "PageCreated"}),
    (text(length={"old": None, "new": 5}), {"byte_delta": 5}),
    (text(length={"new": 5}), {"byte_delta": 5}),
    (text(length={"old": 0, "new": 10_000_000}), {"byte_delta": 10_000_000}),
    (text(length={"old": 10_000_000, "new": 0}), {"byte_delta": -10_000_000}),
    (text(revision={"new": 2**63 - 1}), {"revision_id": 2**63 - 1}),
    (text(bot=True, server_name="de.wikipedia.org"), {}),
    (text(title="A/b"), {"page_title": "A/b"}),
    (text(title="a\u001fb"), {"page_title": "a\u001fb"}),
    (text(title="Zürich ]"), {"page_title": "Zürich ]"}),
    ('{"user":"bob",' + text(user="eve")[1:], {"editor": "eve"}),
    (text(meta={"dt": "2026-01-01T02:00:00+02:00"}), {"instant": "2026-01-01 00:00:00"}),
    (text(meta={"dt": "2026-01-01T02:00+0200"}), {"instant": "2026-01-01 00:00:00"}),
    (text(meta={"dt": "2026-01-01"}), {"instant": "2026-01-01 00:00:00"}),
    (text(meta={"dt": "2026-01-01 00:00:00"}), {"instant": "2026-01-01 00:00:00"}),
    (
        text(meta={"dt": ""}, timestamp=1767225600.5),
        {"instant": "2026-01-01 00:00:00.5", "occurred_at": "2026-01-01T00:00:00.500000+00:00"},
    ),
    (text(meta=None), {"occurred_at": "2026-01-01T00:00:00+00:00"}),
    (text(meta="x"), {"occurred_at": "2026-01-01T00:00:00+00:00"}),
    (text(meta={"dt": False}, timestamp=-1.5), {"instant": "1969-12-31 23:59:58.5"}),
]


def test_valid(spark):
    classified = validate.classify(raw(spark, [value for value, _ in GOOD]))
    assert validate.dead_letters(classified).collect() == []
    rows = classified.withColumn("instant", F.col("occurred_ts").cast("string")).orderBy("ingest_seq").collect()
    default = {
        "wiki": "enwiki",
        "page_title": "A page",
        "event_type": "PageEdited",
        "revision_id": 7,
        "editor": "ann",
        "byte_delta": 15,
        "instant": "2026-01-01 00:00:00",
    }
    for (value, changes), row in zip(GOOD, rows, strict=True):
        expected = {**default, **changes}
        assert {name: row[name] for name in expected} == expected, value


def test_malformed_event_is_dead_lettered(spark):
    broken = text(title="marker", revision=None)
    classified = validate.classify(raw(spark, [text(), broken, text(revision={"new": 8})]))
    dead = validate.dead_letters(classified)
    assert [(r.reason, r.raw) for r in dead.collect()] == [("missing_revision", broken)]
    sent = validate.to_deadletter_json(dead).first().value
    assert json.loads(sent) == {"reason": "missing_revision", "raw": broken}
    log = validate.valid_events(classified)
    assert log.filter("page_title = 'marker'").isEmpty() and log.count() == 2
    assert validate.to_page_events(log, F.current_timestamp()).filter("page_title = 'marker'").isEmpty()


def test_valid_json_is_compact_and_reads_back(spark):
    log = validate.valid_events(validate.classify(raw(spark, [text(title='a "quoted" é')])))
    sent = validate.to_valid_json(log)
    assert sent.first().value == (
        '{"wiki":"enwiki","page_title":"a \\"quoted\\" é","event_type":"PageEdited","revision_id":7,'
        '"editor":"ann","byte_delta":15,"occurred_at":"2026-01-01T00:00:00Z"}'
    )
    assert validate.from_valid_json(sent).collect() == log.collect()


@pytest.mark.parametrize(
    "value,accepted",
    [
        (text(), True),
        (text(type="new"), True),
        (text(bot=True), False),
        (text(bot=None), False),
        (text(bot=0), False),
        (text(bot="false"), False),
        (text(server_name="de.wikipedia.org"), False),
        (text(server_name=None), False),
        (text(type="log"), False),
        (text() + " x", False),
        ("[1]", False),
        ("null", False),
    ],
)
def test_accept(spark, value, accepted):
    assert ingest.accept(raw(spark, [value])).count() == accepted


def test_log_key_keeps_slashes(spark):
    log = ingest.to_raw_log(ingest.accept(raw(spark, [text(title="A/b")])))
    assert [tuple(r) for r in log.collect()] == [(0, "enwiki/A/b", text(title="A/b"))]


def test_seen_and_sent(spark):
    counts = ingest.seen_and_sent(raw(spark, [text(), text(bot=True), "[1]", "{", ""])).first()
    assert (counts.seen, counts.sent) == (3, 1)


def test_epoch_rounds_half_even(spark):
    seconds = [0.0000005, 0.0000015, 1.25, -0.75, 1e300]
    frame = spark.createDataFrame([(s,) for s in seconds], "s double")
    micros = [r[0] for r in frame.select(F.unix_micros(instants.from_epoch(F.col("s")))).collect()]
    assert micros == [0, 2, 1_250_000, -750_000, None]


def test_error_text_is_cut(spark):
    row = spark.range(1).select(F.length(instants.short_error(F.repeat(F.lit("x"), 1500)))).first()
    assert row[0] == 1000


def test_replay_pace(spark):
    stamps = [100, 101, 101, None, 99, 130, 131.5]
    values = [text(meta=None, timestamp=t, revision={"new": i}) for i, t in enumerate(stamps)]
    accepted = ingest.accept(raw(spark, values))
    expected = [0, 500_000, 0, 0, 0, 10_000_000, 750_000]
    for size in (1, 2, 3, 100):
        rows = ingest.replay_schedule(accepted, speed=2.0, rows_per_slice=size).orderBy("ingest_seq").collect()
        assert [r.pause_micros for r in rows] == expected
        assert [r.release_micros for r in rows] == [sum(expected[: i + 1]) for i in range(len(expected))]
    unpaced = ingest.replay_schedule(accepted, speed=0).agg(F.sum("pause_micros")).first()[0]
    assert unpaced == 0
    with pytest.raises(ValueError):
        ingest.replay_schedule(accepted, rows_per_slice=0)


def iso_texts():
    """Dates, times and offsets in all forms, in and out of range."""
    draw = random.Random(4)

    def day():
        y, m, d = draw.choice([1, 1583, 2020, 2024, 2026, 9999]), draw.randrange(14), draw.randrange(33)
        w, k = draw.randrange(55), draw.randrange(9)
        forms = [f"{y:04}-{m:02}-{d:02}"] * 3 + [f"{y:04}{m:02}{d:02}", f"{y:04}-W{w:02}-{k}", f"{y:04}-W{w:02}", f"{y:04}W{w:02}{k}"]
        return draw.choice(forms)

    def clock(digits):
        h, m, s = draw.randrange(26), draw.randrange(62), draw.randrange(62)
        f = "".join(draw.choices("0123456789", k=draw.randrange(1, digits)))
        basic, extended = f"{h:02}{m:02}{s:02}", f"{h:02}:{m:02}:{s:02}"
        return draw.choice([f"{h:02}", extended[:5], basic[:4], extended, basic, f"{extended}.{f}", f"{basic},{f}", f"{extended},{f}"])

    for _ in range(4000):
        text = day()
        if draw.random() < 0.9:
            text += draw.choice("TTTT tx") + clock(12) + draw.choice(["", "Z", "Z", draw.choice("+-") + clock(7)])
        yield text[: draw.randrange(len(text))] if draw.random() < 0.05 else text


def test_instants_are_those_of_the_iso_grammar(spark):
    extra = ["12:00", "2026-01", "", " 2026-01-01", "2026-01-01T24:00", "0000-01-01", "2026-01-01T00:00:00Z\n", "20260101T000000Z"]
    extra += ["2026-01-01T00Z", "2026-01-01T00:00:00,5Z", "2026-01-01T00:00:00.1234567891Z", "9999-12-31T23:59:59-01:00"]

    def by_hand(text):
        try:
            found = datetime.fromisoformat(text.replace("Z", "+00:00"))
            found = found if found.tzinfo else found.replace(tzinfo=timezone.utc)
            return found.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f").zfill(26)
        except (ValueError, OverflowError):
            return None

    texts = sorted({*iso_texts(), *extra})
    shown = F.date_format(instants.parse_iso(F.col("s")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    found = dict(spark.createDataFrame([(t,) for t in texts], "s string").select("s", shown).collect())
    wanted = {t: by_hand(t) for t in texts}
    assert sum(w is not None for w in wanted.values()) > 1500
    assert {t: (found[t], w) for t, w in wanted.items() if found[t] != w} == {}


def test_validation_is_small_enough_to_be_compiled(spark):
    """Only the last step is a generator, and an event time is matched once for all its groups."""
    text_of = validate.classify(raw(spark, [text()]))._jdf.queryExecution().optimizedPlan().toString()
    assert text_of.count("Generate ") == 1
    assert text_of.count("regexp_extract(") == 0


def test_brackets_and_white_space_are_no_json(spark):
    values = ["", " \t\r\n", "]", " ],[1", "],5", "null", " 7 ", "7,8", '{"a":1}]', '"]"', None]
    found = validate.classify(raw(spark, values)).orderBy("ingest_seq").select("reason").collect()
    assert [r.reason == "invalid_json" for r in found] == [True] * 5 + [False, False, True, True, False, True]
