"""Runs of words: against the definition, whatever the pieces; odd rows; the registered query by hand."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from quirefold.llm import runs


def brute(words, least):
    """By definition: maximal stretches of each period, of those that are equal the smallest period."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, 2 * p):
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted(
        (a, b - a, p)
        for (a, b), p in found.items()
        if not any(all(words[t] == words[t + q] for t in range(a, b - q)) for q in range(1, p))
    )


def sequences():
    draw = random.Random(3)
    for turn in range(900):
        n = draw.randrange(90)
        words = [draw.randrange(2 + turn % 3) for _ in range(n)]
        if turn % 4 == 1:
            words = []
            while len(words) < n:
                words += [draw.randrange(3) for _ in range(draw.randrange(1, 9))] * draw.randrange(1, 6)
        elif turn % 4 == 2:  # a Fibonacci word, with a fault
            words = [0, 1]
            while len(words) < n:
                words = [x for w in words for x in ([0, 1] if w == 0 else [0])]
            words[draw.randrange(len(words))] = 2
        elif turn % 4 == 3 and n:
            a = draw.randrange(n)
            p = 1 + (n - a) // (3 + draw.randrange(8))
            words = [draw.randrange(30) for _ in range(n)]
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        yield words, draw.choice([12, 12, 2, 5])


def test_runs_follow_their_definition_whatever_the_pieces():
    draw = random.Random(4)
    for words, least in sequences():
        wanted = brute(words, least)
        assert runs.find_runs(words, least) == wanted
        catchers, k = runs.Catchers(least), 0
        while k < len(words):
            step = draw.randrange(1, 9)
            catchers.append(np.array(words[k : k + step], "<i4"))
            k += step
        assert catchers.finish() == wanted


def test_small_slices_change_nothing(monkeypatch):
    monkeypatch.setattr(runs, "PIECE", 16)
    monkeypatch.setattr(runs, "TOGETHER", 2)
    for words, least in list(sequences())[:300]:
        assert runs.find_runs(words, least) == brute(words, least)


@pytest.mark.parametrize("unit", [[0], [0] * 9 + [1], [0, 1, 0, 0, 2]])
def test_periodic_texts_take_time_in_proportion(unit):
    compared = []
    for n in (20_000, 40_000):
        catchers = Counting()
        catchers.append(np.array((unit * n)[:n], "<i4"))
        found = catchers.finish()
        assert (0, n, len(unit)) in found
        compared.append(catchers.followed)
    assert compared[1] <= 3 * compared[0] + 200


class Counting(runs.Catchers):
    followed = 0

    def _back(self, i, j):
        self.followed += 1
        return super()._back(i, j)


def test_collapse_keeps_the_first_period():
    words = "x a b a b a b a b a b a b a b y".split()
    found = runs.find_runs(words)
    assert found == [(1, 14, 2)]
    assert runs.collapse(words, found) == "x a b y".split()


def contract(doc_id, text):
    """The registered query's row, by its definition."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words, 12)
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    kept = [w for i, w in enumerate(words) if not any(s + p <= i < s + m for s, m, p in found)]

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    milli = best[1] * 1000 // best[2] if found else None
    return (doc_id, len(found), *best, milli, sha("".join(f"{s},{m},{p}\n" for s, m, p in found)), sha(" ".join(kept)))


def test_the_query_on_small_documents(spark, shared):
    draw = random.Random(9)
    rows = []
    for k in range(400):
        words = [draw.choice("abcdefgh") * draw.randrange(1, 4) for _ in range(draw.randrange(70))]
        if k % 5 == 0:
            words += words[:7] * 3
        rows.append((k, draw.choice([" ", "\n", " \t "]).join(words)))
    rows += [(1000, None), (1001, ""), (1002, " \n "), (1003, "Ä b " * 13), (1003, "Ä b " * 13), (-5, "a " * 40)]
    odd = [(None, "b " * 30), (1004, "long tale of words " * 20_000)]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows + odd], "doc_id bigint, text string, runs string, n_words int")
    docs.write.parquet(f"{shared}/documents.parquet")
    found = [tuple(r)[:8] for r in runs.op12_dyadic_runs(spark, shared).collect()]
    by_id = {}
    for row in found:
        by_id.setdefault(row[0], []).append(row)
    assert len(found) == len(rows) + 2
    assert sum(zlib.crc32(str(k).encode()) % 10 == 0 for k in range(400)) > 20
    for doc_id, text in rows:
        assert by_id[doc_id] == [contract(doc_id, text)] * len(by_id[doc_id])
    assert len(by_id[1003]) == 2 and by_id[None][0][1:6] == (1, 0, 30, 1, 30000)
    assert by_id[1004][0][3] >= 70_000


def test_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert runs.document_runs(empty).collect() == []
