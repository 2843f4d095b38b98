"""Helpers for building events by hand."""

import json
from datetime import datetime, timezone

from quirefold.schemas import VALID


def event(**changes) -> dict:
    """A raw event that passes every check; a change to None removes the field."""
    found = {
        "type": "edit",
        "wiki": "enwiki",
        "server_name": "en.wikipedia.org",
        "bot": False,
        "title": "A page",
        "user": "ann",
        "revision": {"new": 7},
        "length": {"old": 10, "new": 25},
        "meta": {"dt": "2026-01-01T00:00:00Z"},
        "timestamp": 1767225600,
    }
    found.update(changes)
    return {k: v for k, v in found.items() if v is not None}


def text(**changes) -> str:
    return json.dumps(event(**changes))


def raw(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "ingest_seq bigint, value string")


def at(second: int) -> datetime:
    return datetime.fromtimestamp(1_767_225_600 + second, tz=timezone.utc)


def valid(spark, rows):
    """Valid events from ``(ingest_seq, title, revision, editor, delta, second)``."""
    full = [
        (seq, "enwiki", title, "PageEdited", rev, editor, delta, at(second).isoformat(), at(second))
        for seq, title, rev, editor, delta, second in rows
    ]
    return spark.createDataFrame(full, VALID)


def fold_by_hand(rows):
    """The page fold in plain Python, the first arrival of each revision of a page counting."""
    pages = {}
    for _, title, rev, editor, delta, second in sorted(rows):
        page = pages.setdefault(title, {})
        page.setdefault(rev, (editor, delta, second))
    return {
        title: (
            min(s for _, _, s in revs.values()),
            max(s for _, _, s in revs.values()),
            len(revs),
            sum(d for _, d, _ in revs.values()),
            len({e for e, _, _ in revs.values()}),
            max((s, rev, e) for rev, (e, _, s) in revs.items())[2],
        )
        for title, revs in pages.items()
    }


def fold_rows(state):
    """Page state as the plain Python fold gives it."""
    epoch = "CAST(unix_seconds({}) - 1767225600 AS int)"
    found = state.selectExpr(
        "page_title",
        epoch.format("created_at"),
        epoch.format("last_edited_at"),
        "edit_count",
        "net_byte_delta",
        "unique_editors",
        "last_editor",
    ).collect()
    return {row[0]: tuple(row[1:]) for row in found}
