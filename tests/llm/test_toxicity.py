"""Toxic segments: the segment search against its definition, scores on held-out documents, odd rows."""

import inspect
import math
import random
import zlib

import numpy as np
import pytest

from quirefold.llm import toxicity

ROWS = 240


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


@pytest.fixture(scope="module")
def tables(spark):
    """Documents of random words; in every third a run of words from a small list."""
    draw = random.Random(5)
    plain = ["".join(draw.choices("abcdefgh", k=draw.randrange(3, 7))) for _ in range(400)]
    bad = ["vexgrim", "droskul", "mirthbane", "zoltrash", "krunge"]
    docs, labels = [], []
    for k in range(ROWS):
        words = draw.choices(plain, k=draw.randrange(60, 160))
        toxic = int(k % 3 == 0)
        if toxic:
            at = draw.randrange(len(words))
            words[at:at] = draw.choices(bad, k=12)
        docs.append((k, " ".join(words), "src", 1.0))
        labels.append((k, toxic))
    odd = [(1000, None, None, None), (1001, "", "x", 0.0), (None, "krunge " * 40, "x", 0.0), (0, docs[0][1], "src", 1.0), (1002, "mild words " * 30000, "x", 0.0)]
    frame = spark.createDataFrame(docs + odd, "doc_id bigint, text string, score string, total double")
    return frame, spark.createDataFrame([*labels, (1000, 1), (1001, None), (1001, 0), (None, 1)], "doc_id bigint, toxic int"), dict(labels)


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.fit(tables[0], tables[1])


def brute_segments(scores):
    """By the recursive definition: the best segment (shortest, first), then left and right of it."""

    def within(first, last):
        best = None
        for a in range(first, last):
            for b in range(a + 1, last + 1):
                total = sum(scores[a:b])
                if total > 0 and (best is None or (total, a - b) > (best[0], best[1] - best[2])):
                    best = total, a, b
        if best is None:
            return []
        _, a, b = best
        return [*within(first, a), (a, b, best[0]), *within(b, last)]

    return within(0, len(scores))


def test_maximal_segments_follow_their_definition():
    draw = random.Random(2)
    for _ in range(300):
        # different powers of two: sums are exact and no two segments tie
        scores = [draw.choice([-1, 1]) * 2.0**k for k in draw.sample(range(-20, 20), draw.randrange(12))]
        assert toxicity.maximal_segments(np.array(scores)) == brute_segments(scores)
    assert toxicity.maximal_segments(np.array([])) == []


def test_held_out_documents_are_told_apart(tables, model):
    docs, _, toxic = tables
    rows = toxicity.score_documents(docs, model).collect()
    assert len(rows) == docs.count()
    judged = [(r.score >= toxicity.THRESHOLD, toxic[r.doc_id] == 1) for r in rows if r.doc_id in toxic and held_out(r.doc_id)]
    assert len(judged) > ROWS // 5 and all(found == wanted for found, wanted in judged)
    by_id = {r.doc_id: r for r in rows}
    # no words, no segments: the score of clean text
    assert by_id[1000].score == by_id[1001].score == by_id[1002].score < 0.5 and by_id[1000].passages == []
    assert by_id[None].score >= toxicity.THRESHOLD
    assert [r.score for r in rows if r.doc_id == 0] == [by_id[0].score] * 2
    start, stop = by_id[0].passages[0][:2]
    assert 10 <= stop - start <= 14


def test_rejected_rows_go_and_others_keep_their_columns(tables, model):
    docs, _, _ = tables
    scores = [(r.doc_id, r.score) for r in toxicity.score_documents(docs, model).collect()]
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    found = [r.doc_id for r in kept.collect()]
    assert sorted(map(str, found)) == sorted(str(d) for d, score in scores if score < toxicity.THRESHOLD)


def test_word_pairs_are_whole_whatever_is_held(spark, tables, monkeypatch):
    sample = tables[0].selectExpr("cast(coalesce(doc_id, 0) % 2 as int) as toxic", "text").toArrow().to_batches()

    def pairs():
        return {row for b in toxicity.word_pairs(iter(sample)) for row in zip(*(c.to_pylist() for c in b.columns), strict=True)}

    whole = pairs()
    monkeypatch.setattr(toxicity, "FLUSH", 50)
    assert pairs() == whole and len(whole) > 1000


def test_without_labels_or_rows_nothing_is_toxic(spark, tables):
    docs, labels, _ = tables
    unfitted = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.score_documents(docs, unfitted).collect()} == {0.0}
    assert toxicity.score_documents(docs.limit(0), unfitted).count() == 0


def test_the_search_takes_time_in_proportion():
    """Falling sums, the normal case of clean text, and rising ones: steps per score do not grow."""

    class Counted(list):
        reads = 0

        def __getitem__(self, at):
            Counted.reads += 1
            return super().__getitem__(at)

    def steps(scores):
        Counted.reads = 0
        source = inspect.getsource(toxicity.maximal_segments).replace("= []  #", "= Counted()  #")
        space = {"np": np, "Counted": Counted}
        exec(source.replace("from __future__ import annotations", ""), space)
        assert space["maximal_segments"](scores) == toxicity.maximal_segments(scores)
        return Counted.reads

    draw = random.Random(1)
    for unit in ([-1.0, 0.5], [-0.5, 1.0], [-1.0, 0.25, -0.25, 0.75]):
        for shape in (np.array(unit * 4000), np.array([s * draw.random() for s in unit * 4000])):
            assert steps(shape) <= 8 * len(shape)


def test_scores_from_end_to_end(tables, model):
    """Each document's score, from its words and the model's tables, by the definitions."""
    rows = toxicity.score_documents(tables[0], model).collect()
    texts = {}
    for r in tables[0].collect():
        texts.setdefault(r.doc_id, r.text)
    for row in rows[:: len(rows) // 40]:
        words = toxicity.words_of(texts[row.doc_id])
        if len(words) > 200:
            continue
        scores = [model.words.get(w, model.prefixes.get(w[:4], model.rest) if len(w) > 4 else model.rest) for w in words]
        worth = [-math.log(max(model.rate * len(words) * math.exp(-model.scale * s), 1e-300)) for *_, s in brute_segments(scores)]
        total = math.log1p(sum(w for w in worth if w > -math.log(toxicity.SIGNIFICANT)))
        best = max([-5.0, *worth])
        x = model.weights @ np.array([1, total, max(-5.0, min(best, 15.0)) / 5])
        assert row.score == pytest.approx(1 / (1 + math.exp(-x)))
