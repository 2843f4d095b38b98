"""The prefix trie against one built by hand, in SQL and in Python; deep and odd conversations."""

import hashlib
import random
import zlib

import duckdb
import pytest

from quirefold.llm import prefixtrie


def by_hand(conversations):
    """Rows of the trie of {conv_id: [(role, text), ...]}."""
    members, ends = {}, {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children, leaves, saved = {}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    for node, own in members.items():
        worth = (len(own) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += worth
            leaves[node[:d]] += node not in children
    rows = []
    for node, own in members.items():
        told = ",".join(map(str, sorted(ends.get(node, []))))
        parent = min(members[node[:-1]]) if node else None
        rows.append(
            (min(own), len(node), parent, len(own), len(children.get(node, [])), leaves[node], saved[node],
             hashlib.sha256(told.encode()).hexdigest())
        )
    return sorted(rows, key=str)


def rebuilt(conversations):
    out = {}
    for c, own in conversations.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = conversations.get(c - c % 5, []) if c >= 0 else conversations.get(-(-c - -c % 5), [])
        out[c] = base[:h] + own[h:]
    return out


def table(spark, conversations, shuffled=7):
    rows = [(c, k, role, text, "x", 1) for c, turns in conversations.items() for k, (role, text) in enumerate(turns)]
    random.Random(shuffled).shuffle(rows)
    schema = "conv_id bigint, turn bigint, role string, text string, path string, depth int"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def conversations():
    draw = random.Random(1)
    texts = ["", "hi", "ä", "more words"]
    found = {}
    for c in [*range(0, 120), 1 << 40, (1 << 40) + 3, -7, -10, 4096, 4097, 8192]:
        found[c] = [(draw.choice("ua"), draw.choice(texts)) for _ in range(draw.randrange(1, 6))]
    for c in range(200, 260):  # one hot conversation
        found[c] = [("u", "hi"), ("a", "ä")]
    long = [("u", str(k)) for k in range(70)]
    found |= {300: long, 301: long, 302: [*long[:40], ("a", "other"), *long[:30]], 303: long[:20], 304: [("a", "")] * 33}
    return found


def read(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_the_trie_as_built_by_hand(spark, conversations):
    own = prefixtrie.turns_of(table(spark, conversations))
    assert read(prefixtrie.prefix_trie(own)) == by_hand(conversations)


def test_the_query_and_its_sql(spark, shared, conversations):
    table(spark, conversations).write.parquet(f"{shared}/conversations.parquet")
    found = read(prefixtrie.op11_truncation_peeling(spark, shared))
    assert found == by_hand(rebuilt(conversations))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{shared}/conversations.parquet/*.parquet'")
    assert sorted(con.execute(prefixtrie.OP11_SQL).fetchall(), key=str) == found


def test_the_last_turns_of_a_lone_conversation_take_no_rounds(spark, shared):
    lone = {1: [("u", str(k)) for k in range(300)], 2: [("u", "0"), ("a", "x")]}
    own = prefixtrie.turns_of(table(spark, lone))
    classes = prefixtrie.with_paths(own).selectExpr("path", "conv_id", "1L as n_convs")
    written = prefixtrie.grow(prefixtrie.stored(classes, "c"), f"{shared}/trie")
    assert len(written) == 1 + prefixtrie.ALONE + 1


def test_digests_do_not_depend_on_chunks(spark, conversations, monkeypatch):
    own = prefixtrie.turns_of(table(spark, conversations))
    monkeypatch.setattr(prefixtrie, "IDS", 1)
    assert read(prefixtrie.prefix_trie(own)) == by_hand(conversations)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (1, None, None, None), (1, 0, "u", "a"), (2, 3, "u", "a"), (2, -1, "", ""), (None, 0, "u", "lost"),
        (3, 1, "u", "z"), (3, 1, "u", "y"), (4, 1, "u", "y"), (4, 1, "u", "z"), (5, 1, "u", "y"), (5, 1, "u", "y"),
    ]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = read(prefixtrie.prefix_trie(prefixtrie.turns_of(frame)))
    tied = [t for t in ([("u", "z"), ("u", "y")], [("u", "y"), ("u", "z")])]
    wanted = [
        by_hand({1: [("", ""), ("u", "a")], 2: [("", ""), ("u", "a")], 3: t, 4: t, 5: [("u", "y")] * 2}) for t in tied
    ]
    assert found in wanted


def test_empty_tables_and_turnless_conversations(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert prefixtrie.prefix_trie(prefixtrie.turns_of(empty)).collect() == []
    none = prefixtrie.turns_of(table(spark, {1: [("u", "x")], 2: [("u", "x")]}))
    none = none.withColumn("turns", prefixtrie.F.slice("turns", 1, 0))
    assert read(prefixtrie.prefix_trie(none)) == by_hand({1: [], 2: []})
