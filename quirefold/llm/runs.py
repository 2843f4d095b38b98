"""Runs (maximal periodic stretches) of words, found online by dyadic square catching.

A run of period q is a stretch of at least 2 q words in which words q apart are identical, that cannot be
lengthened, and that has no smaller period. It begins as a square: twice the same q words.

The words seen so far fall, for every k, into blocks of 2^k. A completed block sets a catcher at its
last word e, for the periods from 2^k up to 2^(k+1): the left half of such a square is at least a block
long, so some catcher's word lies in it. Each appended word y belongs to one catcher of each level, and
is compared with its word e; on a match, the suffixes that end at e and y are compared backwards, and both go on
forwards with the words that follow. As many matches as the period, and a square is caught; squares of the same
period that overlap are one run, which stays open while it reaches the last word.

A word meets one catcher a level: n log n comparisons, made on whole arrays. A pair that cannot grow
to a square is dropped after a logarithmic number of probes. Inside a run of period q, a pair at a multiple of q
finds that run again, and other pairs beyond q and away from the run's ends find nothing (Fine and Wilf,
1965), so neither is followed: highly periodic texts cost no more than others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import table

#: a run has at least so many words
LEAST = 12
#: words that are appended, and compared on a level, at once
PIECE = 1 << 16
#: promising pairs that are weeded out together whenever a run is found
TOGETHER = 128
#: documents and bytes of collapsed text of a batch handed on
ROWS, BYTES = 500, 4 << 20

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


class Catchers:
    """The runs of a sequence of word numbers that is appended piece by piece."""

    def __init__(self, least: int = LEAST):
        self.least = least
        self.n = 0
        self.words = np.empty(64, "<i4")
        #: the longest known run that covers a word, and its length
        self.cover = np.full(64, -1, "<i4")
        self.extent = np.zeros(64, "<i4")
        #: first word that a level has not compared yet
        self.next: list[int] = []
        #: [start, stop, period] of matching stretches; some may still become runs
        self.found: list[list[int]] = []
        self.open: list[int] = []
        self.known: set[tuple[int, int]] = set()

    def append(self, words: np.ndarray) -> None:
        """Take the next words. Any cut into pieces gives the same runs."""
        for first in range(0, len(words), PIECE):
            self._take(words[first : first + PIECE])

    def finish(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs, by start, then period. Nothing can be appended after it."""
        for k in range(len(self.next)):
            self._compare(k, self.n)
        runs: dict[tuple[int, int], int] = {}
        for start, stop, period in self.found:
            if self._is_run(start, stop, period):
                runs[start, stop] = min(period, runs.get((start, stop), period))
        return sorted((start, stop - start, period) for (start, stop), period in runs.items())

    def _take(self, words: np.ndarray) -> None:
        n = self.n + len(words)
        if n > len(self.words):
            room = max(n, 2 * len(self.words))
            self.words, self.cover, self.extent = (np.resize(a, room) for a in (self.words, self.cover, self.extent))
        self.words[self.n : n] = words
        self.cover[self.n : n] = -1
        self.extent[self.n : n] = 0
        self.n = n
        still = []
        for k in self.open:
            start, stop, period = self.found[k]
            self.found[k][1] = stop + self._ahead(stop - period, stop)
            if self._is_run(*self.found[k]):
                self._cover(k)
            if self.found[k][1] == n:
                still.append(k)
        self.open = still
        while 2 << len(self.next) <= n:
            self.next.append((2 << len(self.next)) - 1)
        for k in range(len(self.next)):
            self._compare(k, n - self._side(np.array([1 << k, (2 << k) - 1])).max())

    def _is_run(self, start: int, stop: int, period: int) -> bool:
        return stop - start >= max(self.least, 2 * period)

    def _cover(self, k: int) -> None:
        start, stop, _ = self.found[k]
        less = self.extent[start:stop] < stop - start
        self.cover[start:stop][less] = k
        self.extent[start:stop][less] = stop - start

    def _side(self, period: np.ndarray) -> np.ndarray:
        """Matches next to a pair, on one of its sides, that a run cannot do without."""
        return np.maximum(period, self.least - period) // 2

    def _ahead(self, i: int, j: int) -> int:
        """How many words from i on equal those from j on."""
        same, step = 0, 32
        while j + same < self.n:
            width = min(step, self.n - j - same)
            equal = self.words[i + same : i + same + width] == self.words[j + same : j + same + width]
            if not equal.all():
                return same + int(equal.argmin())
            same, step = same + width, min(4 * step, PIECE)
        return same

    def _back(self, i: int, j: int) -> int:
        """How many words up to i, backwards, equal those up to j."""
        same, step = 0, 32
        while same <= i:
            width = min(step, i + 1 - same)
            a, b = i + 1 - same, j + 1 - same
            equal = (self.words[a - width : a] == self.words[b - width : b])[::-1]
            if not equal.all():
                return same + int(equal.argmin())
            same, step = same + width, min(4 * step, PIECE)
        return same

    def _compare(self, k: int, stop: int) -> None:
        """Level k meets the words before ``stop``."""
        while self.next[k] < stop:
            last = min(stop, self.next[k] + PIECE)
            y = np.arange(self.next[k], last)
            self.next[k] = last
            e = ((y + 1 >> k) - 1 << k) - 1
            match = np.flatnonzero(self.words[e] == self.words[y])
            if len(match):
                e, y = self._promising(e[match], y[match])
                for first in range(0, len(e), TOGETHER):
                    self._follow(*self._unknown(e[first : first + TOGETHER], y[first : first + TOGETHER]))

    def _promising(self, e: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that are not known and whose neighbours match on one side, as far as probed."""
        e, y = self._unknown(e, y)
        side = self._side(y - e)
        left, right = np.ones(len(e), bool), np.ones(len(e), bool)
        step = 1
        while len(e) and (far := side >= step).any():
            # beyond a side's length, its end is probed instead
            j = np.where(far, step, np.maximum(side, 0))
            left &= (e >= j) & (self.words[e - j] == self.words[y - j])
            ahead = np.minimum(j, self.n - 1 - y)
            right &= (ahead == j) & (self.words[e + ahead] == self.words[y + ahead])
            keep = left | right
            e, y, side, left, right = e[keep], y[keep], side[keep], left[keep], right[keep]
            step *= 2
        return e, y

    def _unknown(self, e: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Without the pairs that lie in a known run and cannot show another."""
        cover = self.cover[e]
        some = np.flatnonzero(cover >= 0)
        if not len(some):
            return e, y
        used, at = np.unique(cover[some], return_inverse=True)
        start, stop, q = np.array([self.found[k] for k in used]).T
        start, stop, q, p = start[at], stop[at], q[at], (y - e)[some]
        settled = (p % q == 0) | ((p >= q) & (e[some] - start >= q) & (stop - y[some] >= q))
        keep = np.ones(len(e), bool)
        keep[some] = ~(settled & (y[some] < stop))
        return e[keep], y[keep]

    def _follow(self, e: np.ndarray, y: np.ndarray) -> None:
        """Compare the suffixes of each pair and what follows them."""
        while len(e):
            i, j = int(e[0]), int(y[0])
            period = j - i
            start = i - self._back(i - 1, j - 1) if i else 0
            stop = j + 1 + self._ahead(i + 1, j + 1)
            run = self._is_run(start, stop, period)
            if (run or stop == self.n) and (start, period) not in self.known:
                self.known.add((start, period))
                if stop == self.n:
                    self.open.append(len(self.found))
                self.found.append([start, stop, period])
                if run:
                    self._cover(len(self.found) - 1)
            # other pairs of the period in this stretch are the same
            keep = (y - e != period) | (e < start) | (y >= stop)
            e, y = e[keep], y[keep]
            if run:
                e, y = self._unknown(e, y)


def find_runs(words: list, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of the sequence, by start, then period."""
    if len(words) < least:
        return []
    numbers: dict = {}
    catchers = Catchers(least)
    catchers.append(np.array([numbers.setdefault(w, len(numbers)) for w in words], "<i4"))
    return catchers.finish()


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words, of each run only its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, "<i8")
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(depth)[:-1] == 0)]


def detect(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for k, text in enumerate(batch.column(1)):
                # splits at space and the control characters 9 to 13
                words = (text.as_py() or "").encode().split()
                runs = find_runs(words, least)
                kept = b" ".join(collapse(words, runs))
                rows.append((batch.column(0)[k], len(words), runs, kept))
                held += len(kept)
                if len(rows) >= ROWS or held >= BYTES or k + 1 == batch.num_rows:
                    yield _batch(rows)
                    rows, held = [], 0

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    ids, n, runs, kept = zip(*rows, strict=True)
    named = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in found] for found in runs]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array(n, pa.int64()),
            pa.array(named, pa.list_(RUN)),
            pa.array(kept, pa.binary()).cast(pa.string()),
        ],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def document_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of each row; ``runs``: start, length and period in words, by
    start, then period; ``collapsed``: the text's words, each run cut to its first period.

    Words are maximal runs of other characters than space and the control characters 9 to 13, compared
    as they are. A null or empty text has no words, no runs and collapses to an empty text. A null doc_id
    and repeated rows are kept as they are; other columns are not looked at. A text of any length is
    searched whole, in memory proportional to its words. No rows: an empty table.
    """
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(detect(least), SCHEMA)


def with_planted_period(doc_id: Column, text: Column) -> Column:
    """The text; for a tenth of the documents, by a hash, its words from a place on repeat periodically."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("bigint")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def planted(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        return F.array_join(
            F.transform(
                w, lambda x, i: F.when(i < a, x).otherwise(F.element_at(w, (a + (i - a) % p + 1).cast("int")))
            ),
            " ",
        )

    changed = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, planted(w)).otherwise(""))
    return F.when((h % 10 == 0) & text.isNotNull(), F.element_at(changed, 1)).otherwise(text)


def op12_dyadic_runs(spark, sf_dir: str) -> DataFrame:
    """Per document its runs of at least 12 words, the longest of them, and digests of all runs and of
    the collapsed text; the longest is the first by start, then period, among equals. A document without
    doc_id is searched as it is."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", with_planted_period(F.col("doc_id"), F.col("text")).alias("text")
    )
    found = document_runs(docs)
    order = F.transform(
        "runs", lambda r: F.struct(r["length"], (-r["start"]).alias("a"), (-r["period"]).alias("b"))
    )
    best = F.array_max(order)
    told = F.array_join(
        F.transform(
            "runs",
            lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")),
        ),
        "",
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.a")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.b")).alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / (-F.col("best.b"))).cast("bigint").alias("exponent_milli"),
        F.sha2(told, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
