"""The set join against all pairs of shingle sets."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from quirefold.llm import components, setjoin

SCHEMA = "doc_id bigint, text string, key string, n int"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def brute(rows):
    """doc_id: (n_shingles, component_id, n_links)."""
    found = [(d, shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in found}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = defaultdict(int)
    for i, (a, x) in enumerate(found):
        for b, y in found[i + 1 :]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                links[a] += 1
                links[b] += 1
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {d: (len(s), root(d), links[d]) for d, s in found}


def edited(draw, words, share):
    return [w if draw.random() > share else f"x{draw.randrange(10**6)}" for w in words]


def texts():
    draw = random.Random(5)
    vocabulary = [f"w{k}" for k in range(3000)]
    out = ["", " \t\n ", "one", "one", "two words", "Two WORDS", "a b c d e", "a b c d e f", "É b c d e", "é b c d e"]
    passage = draw.choices(vocabulary, k=60)
    for _ in range(25):  # a passage that many texts share
        out.append(" ".join(passage + draw.choices(vocabulary, k=draw.choice([3, 30, 200]))))
    for size in (40, 120, 400):
        base = draw.choices(vocabulary, k=size)
        out += [" ".join(base)] * 4
        out += [" ".join(edited(draw, base, share)) for share in (0.005, 0.01, 0.02, 0.03, 0.05) for _ in range(6)]
        out += [" ".join(base[:cut]) for cut in range(size // 2, size, max(1, size // 25))]
    out.append(" ".join(["again"] * 3000))
    draw.shuffle(out)
    return out


def result(frame):
    return {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in frame.collect()}


def test_all_links_are_found(spark):
    rows = [(7 * k, t, "k", 1) for k, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    wanted = brute([(d, t) for d, t, *_ in rows])
    assert len({c for _, c, _ in wanted.values()}) < len(rows) - 40
    assert result(setjoin.join_documents(docs)) == wanted


def test_small_blocks_and_parts_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(setjoin, "BLOCK_SETS", 4)
    monkeypatch.setattr(setjoin, "FLUSH", 500)
    rows = [(k, t, "k", 1) for k, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(setjoin.join_documents(docs)) == brute([(d, t) for d, t, *_ in rows])


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(setjoin.join_documents(docs)) == brute(rows)


def test_nulls_repeats_and_nothing(spark):
    rows = [(1, None, None, None), (None, "a b c d e", "k", 1), (3, "a b c d e", "k", 1), (3, "a b c d e", "k", 1), (2, "A b c d e", None, 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = sorted(map(tuple, setjoin.join_documents(docs).collect()), key=repr)
    assert found == sorted([(1, 0, 1, 0), (None, 1, None, 0), (3, 1, 2, 2), (3, 1, 2, 2), (2, 1, 2, 2)], key=repr)
    assert setjoin.join_documents(docs.limit(0)).count() == 0
    kept = [(r.doc_id, r.text) for r in setjoin.one_of_each(docs).collect()]
    assert sorted(kept, key=repr) == sorted([(1, None), (None, "a b c d e"), (2, "A b c d e")], key=repr)


def test_overlaps_derived_from_the_set_before():
    draw = np.random.default_rng(1)
    block = [np.unique(draw.integers(0, 400, 150).astype("<u8")) for _ in range(20)]
    probes = [block[0]]
    for _ in range(10):
        probes.append(np.unique(np.append(probes[-1][3:], draw.integers(0, 500, 4).astype("<u8"))))
    overlaps = setjoin.Overlaps(block)
    for probe in probes:
        assert overlaps.of(probe).tolist() == [len(np.intersect1d(probe, b)) for b in block]


def test_shingle_hashes_tell_sets_apart():
    words = pa.array(["a b c d e f", "A  B\tc d\x0be f ", "a b c d e", None, "", "ab c", "a bc"])
    found = dict(setjoin.sets(words, 5))
    assert found.keys() == {0, 1, 2, 5, 6}
    assert found[0].tolist() == found[1].tolist() and len(found[0]) == 2
    assert found[5].tolist() != found[6].tolist()


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    draw = random.Random(2)
    edges = {
        "chain": [(k, k + 1) for k in range(60)] + [(100, 101)],
        "star": [(50, k) for k in range(50)] + [(50, k) for k in range(51, 80)],
        "random": [(draw.randrange(80), draw.randrange(80)) for _ in range(60)] + [(None, 4), (4, None), (5, 5)],
        "none": [],
    }[shape]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else root(parent[x])

    for a, b in edges:
        if a is not None and b is not None and a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    found = components.components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()
    assert sorted((r.node, r.component) for r in found) == sorted((x, root(x)) for x in parent)


def test_a_chain_is_not_compared_as_a_whole(spark):
    """Each text overlaps the next, too little to be linked; sets are sent to their neighbours only."""
    words = [f"w{k}" for k in range(30 * 400 + 100)]
    rows = [(k, " ".join(words[30 * k : 30 * k + 100])) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    live = (
        docs.select("text").mapInArrow(setjoin.deal_shingles(5, 3), setjoin.PACKED)
        .groupBy("part").applyInArrow(setjoin.count_frequencies(3), setjoin.SHARED)
        .groupBy("part").applyInArrow(setjoin.find_prefixes(80), setjoin.LIVE)
    )
    light = setjoin.stored(live.selectExpr("key", "n", "prefix", "place", "home", "octet_length(shared) / 8 as held"), "chain")
    placed = setjoin.stored(setjoin.in_blocks(light), "chain-blocks")
    pairs = setjoin.block_pairs(placed, 80)
    sent = placed.join(pairs, (pairs["l"] == placed["block"]) | (pairs["r"] == placed["block"])).count()
    # the first and the last share too little with anyone
    assert light.count() == 398 and sent < 5 * 400
    assert set(result(setjoin.join_documents(docs)).values()) == {(96, k, 0) for k in range(400)}


def test_one_of_each_loses_no_text(spark):
    a, b = "a b c d e f", "one two three four five six"
    rows = [(3, a, 0, 1), (5, a, 0, 2), (5, b, 0, 3), (6, None, 0, 4), (6, " ", 0, 5), (7, b, 0, 6), (7, b, 0, 6), (None, a, 0, 7)]
    rows += [(9, "only this text here now", 0, 8)] * 2
    for order in (rows, rows[::-1]):
        kept = setjoin.one_of_each(spark.createDataFrame(order, "doc_id bigint, text string, id int, digest int"))
        assert kept.columns == ["doc_id", "text", "id", "digest"]
        found = sorted((tuple(r) for r in kept.collect()), key=repr)
        wanted = [(3, a, 0, 1), (5, b, 0, 3), (6, None, 0, 4), (6, " ", 0, 5), (None, a, 0, 7), (9, "only this text here now", 0, 8)]
        assert found == sorted(wanted, key=repr)


def test_long_texts_hash_as_short_ones(monkeypatch):
    from quirefold.llm import wordhash

    draw = random.Random(3)
    texts = [" ".join("x" * draw.randrange(1, 90) + str(k % 7) for k in range(60)) for _ in range(5)] + ["y" * 500, ""]
    whole = [(row, found.tolist()) for row, found in setjoin.sets(pa.array(texts), 5)]
    monkeypatch.setattr(wordhash, "PIECE", 64)
    assert [(row, found.tolist()) for row, found in setjoin.sets(pa.array(texts), 5)] == whole


def test_a_shingle_costs_the_same_in_many_parts():
    """Names must not go along to each part: near the end of growth every part has one shingle of a set."""
    draw = random.Random(8)
    texts = pa.array([" ".join(f"w{draw.randrange(10**6)}" for _ in range(300)) for _ in range(400)])
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])

    def sent(parts):
        rows = pa.Table.from_batches(setjoin.deal_shingles(5, parts)(iter([batch])))
        columns = [rows.column(c).to_pylist() for c in rows.column_names if c != "part"]
        packs = (pa.compress(b"".join(filter(None, row)), "lz4_raw", asbytes=True) for row in zip(*columns, strict=True))
        return sum(map(len, packs)) / (400 * 296)

    assert sent(1000) < 1.25 * sent(10) and sent(1000) < 11


def test_copies_in_many_tasks_are_one_set(spark):
    """Shingles that only copies of a set have in common are not shared."""
    draw = random.Random(9)
    words = [[f"w{draw.randrange(10**6)}" for _ in range(50)] for _ in range(30)]
    texts = [" ".join(w) for w in words] + [" \t".join(w).upper() for w in words]
    docs = spark.createDataFrame([(t,) for t in texts * 6], "text string").repartition(7)
    dealt = setjoin.deal_classes(docs, 5, 4)
    named = [r.keys for r in dealt.collect() if r.keys]
    assert sum(map(len, named)) == 16 * 30
    live = dealt.groupBy("part").applyInArrow(setjoin.count_frequencies(4), setjoin.SHARED).groupBy("part")
    assert live.applyInArrow(setjoin.find_prefixes(80), setjoin.LIVE).count() == 0


def test_numbers_in_planes():
    for values in ([], [0], [3, 1, 70000, 2**31 - 1]):
        assert setjoin.from_planes(setjoin.planes(np.array(values, "<i4")), "<i4").tolist() == values


def test_texts_of_any_length_travel(spark, monkeypatch):
    monkeypatch.setattr(setjoin, "UNPACKED", 10)
    texts = ["again " * 5000, "a b c d e", "é b c d e", None, " ", "again " * 5000]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    rows = pa.Table.from_batches(setjoin.name_texts(5)(iter([batch, batch]))).sort_by("key")
    found = [b.column(0).to_pylist() for b in setjoin.first_texts(iter(rows.to_batches()))]
    assert sorted(sum(found, [])) == sorted(texts[:3]) and all(len(b) == 1 for b in found)
