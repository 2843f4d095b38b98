"""Decontamination against a plain search for every window."""

import hashlib
import re

import duckdb
import pytest

from quirefold.llm import decontaminate
from quirefold.llm.decontaminate import OP8_SQL

DOCS = "doc_id bigint, text string, row string, words int"
ITEMS = "item_id bigint, text string, doc_id int"


def words(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, window=10):
    out = []
    for doc, text in docs:
        have, hit, named = words(text), set(), set()
        for item, other in items:
            w = words(other)
            k = min(window, len(w))
            for i in range(len(w) - k + 1 if w else 0):
                for at in range(len(have) - k + 1):
                    if have[at : at + k] == w[i : i + k]:
                        hit.update(range(at, at + k))
                        named.add(str(item) if item is not None else "")
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out.append((doc, len(have), len(hit), len(named), digest, bool(hit)))
    return sorted(out, key=repr)


def result(spark, docs, items, **more):
    d = spark.createDataFrame([(a, b, "r", 1) for a, b in docs], DOCS)
    i = spark.createDataFrame([(a, b, 1) for a, b in items], ITEMS)
    found = decontaminate.contamination(d, i, **more)
    rows = found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    return sorted(map(tuple, rows), key=repr)


LONG = " ".join(f"w{k}" for k in range(40))
CASES = [
    (1, LONG),
    (2, LONG.upper().replace(" ", ", ")),
    (3, "pre " + LONG[: LONG.index(" w9")] + " w9 post"),
    (4, "w0 w1 w2 w3 w4 w5 w6 w7 w8"),
    (5, "a quick é test"),
    (6, "AÉB x a  quick\té!test a quick é test"),
    (7, ""),
    (8, None),
    (None, "solo"),
    (9, "solo solo"),
    (9, "solo solo"),
    (10, "x y x y x y x y x y x y x y"),
    (11, "w5 " * 3000),
]
BENCH = [(10, LONG), (2, "a quick é test"), (3, "solo"), (4, ""), (5, None), (6, "?!"), (None, "Solo"), (7, "x y x y x y x y x y"), (8, "never seen words at all here in any document of these"), (2, "é test")]


def test_against_plain_search(spark):
    assert result(spark, CASES, BENCH) == brute(CASES, BENCH)


def test_a_full_filter_changes_nothing(spark):
    assert result(spark, CASES, BENCH, filter_bits=64) == brute(CASES, BENCH)


def test_other_window_sizes(spark):
    assert result(spark, CASES, BENCH, window=3, shingle=5) == brute(CASES, BENCH, 3)


def test_nothing_to_search(spark):
    assert result(spark, [], BENCH) == []
    assert result(spark, CASES, []) == brute(CASES, [])


def test_filtering_keeps_whole_rows(spark):
    docs = spark.createDataFrame([(a, b, "r", 1) for a, b in CASES], DOCS)
    items = spark.createDataFrame([(a, b, 1) for a, b in BENCH], ITEMS)
    kept = decontaminate.without_contaminated(docs, items).collect()
    clean = [doc for doc in CASES if not brute([doc], BENCH)[0][5]]
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted(clean, key=repr)
    assert all((r.row, r.words) == ("r", 1) for r in kept)


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/{sf}/{table}.parquet'")
    relation = con.sql(OP8_SQL)
    frame = decontaminate.op8_prefix_filtered_windows(spark, f"/root/testdata/{sf}").select(relation.columns)
    assert sorted(map(tuple, frame.collect())) == sorted(relation.fetchall())
