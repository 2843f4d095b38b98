"""Toxic passages as maximum-scoring segments, with extreme-value calibration.

Fitting, on a bounded sample of labelled documents (MOST_LABELLED of each class, drawn by a hash):

* A word's count in a class is the number of distinct words that follow it there, so that copies of a
  passage count once. Words beyond four letters are also counted by their first four.
* A word's score is its log-odds between the classes under Dirichlet priors: a prefix is drawn to the
  classes' overall ratio, a word to its prefix. Words that are not significantly toxic all get one small
  negative score, which makes the expected score of clean text negative.
* The scale of the scores is the root of E[exp(scale x score)] = 1 over clean text; the rate of
  segments per token comes from the clean documents. Together they give a segment's expected number in clean
  text of that length (Karlin and Altschul, 1990).
* A logistic regression turns a document's segments into a probability.

Scoring a document takes time linear in its words: all maximal segments are found in one pass (Ruzzo and
Tompa, 1999), each gets its expected number, and significant ones are added up.

Labels, language, source and id never enter a score. Without toxic and clean labelled documents every
score is 0. A null or empty text has no segment and gets the score of clean text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import give_back, stored, table

MOST_LABELLED = 8_000
THRESHOLD = 0.7
PREFIX = 4
PREFIX_PRIOR = 20.0
WORD_PRIOR = 5.0
LEAST_Z = 2.5
LEAST_SCORE = 1.0
#: a significant segment: expected less than this often in clean text of the document's length
SIGNIFICANT = 0.1
#: scores of words that a worker remembers
CACHE = 60_000
#: distinct word pairs that a task holds before it hands them on
FLUSH = 100_000
#: rows of a batch that are scored and handed on at once
ROWS = 500

WORD = re.compile(r"[^\W_]+")
SEGMENT = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())])
FEATURES = "n_words bigint, total double, best double"


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """``toxic, text`` of at most so many documents a class, none of them held out."""
    open_rows = labels.filter(F.col("toxic").isin(0, 1) & (remainder(F.col("doc_id")) != 1)).select("doc_id", "toxic").distinct()
    sizes = dict(open_rows.groupBy("toxic").count().collect())

    def draw(kind: int) -> DataFrame:
        # a share by hash first, a fifth more than wanted and some, so that few rows meet in one task
        share = min(1.0, (1.2 * most + 100) / max(sizes.get(kind, 0), 1))
        few = (F.col("toxic") == kind) & (F.xxhash64("doc_id").cast("double") <= (2 * share - 1) * 2.0**63)
        return open_rows.filter(few).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)

    drawn = [draw(kind) for kind in (0, 1)]
    chosen = F.broadcast(drawn[0].unionAll(drawn[1]))  # at most 2 x most rows of two numbers
    return stored(docs.select("doc_id", "text").join(chosen, "doc_id").select("toxic", "text"), "labelled-sample")


def word_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, word, next word) of the texts, most repetitions left out."""

    def flush(found: set[tuple[int, str, str]]) -> pa.RecordBatch:
        columns = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.string(), pa.string()), strict=True)],
            names=["toxic", "word", "following"],
        )

    found: set[tuple[int, str, str]] = set()
    for batch in batches:
        for kind, text in zip(*batch.columns, strict=True):
            words = words_of(text.as_py())
            if words:
                found.update(zip([kind.as_py()] * len(words), words, [*words[1:], ""], strict=True))
            if len(found) >= FLUSH:
                yield flush(found)
                found = set()
    if found:
        yield flush(found)


class Model:
    """Word scores and their calibration; small enough to be sent to every task, as the sample is bounded."""

    def __init__(self, words: dict[str, float], prefixes: dict[str, float], rest: float):
        self.words, self.prefixes, self.rest = words, prefixes, rest
        self.scale, self.rate = 1.0, 1.0
        self.weights = np.zeros(3)
        self.fitted = False
        self.cache: dict[str, float] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"cache": {}}

    def score(self, word: str) -> float:
        found = self.words.get(word)
        if found is None:
            found = self.prefixes.get(word[:PREFIX], self.rest) if len(word) > PREFIX else self.rest
        if len(self.cache) >= CACHE:
            self.cache.clear()
        self.cache[word] = found
        return found

    def scores(self, words: list[str]) -> np.ndarray:
        known, score = self.cache.get, self.score
        return np.array([s if (s := known(w)) is not None else score(w) for w in words], float)

    def segments(self, words: list[str]) -> list[tuple[int, int, float, float]]:
        """(start, stop, score, expected number in clean text) of all maximal segments."""
        if not words:
            return []
        scores = self.scores(words)
        norm = self.rate * len(words)
        return [(a, b, s, norm * math.exp(-self.scale * s)) for a, b, s in maximal_segments(scores)]

    def features(self, segments: list[tuple[int, int, float, float]]) -> tuple[float, float]:
        """Sum over the significant segments, and the best: how much less than once each is expected."""
        worth = [-math.log(max(e, 1e-300)) for *_, e in segments]
        total = sum(w for w in worth if w > -math.log(SIGNIFICANT))
        return math.log1p(total), max([*worth, -5.0])

    def probability(self, total: float, best: float) -> float:
        if not self.fitted:
            return 0.0
        x = float(self.weights @ np.array([1.0, total, squash(best)]))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def squash(best: float) -> float:
    return max(-5.0, min(best, 15.0)) / 5


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of a sequence, in order."""
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    kept: list[tuple[int, int, float, float, int]] = []  # start, stop, sum before, sum after, link
    for at in np.flatnonzero(scores > 0).tolist():
        start, left, right = at, float(sums[at]), float(sums[at + 1])
        # the nearest segment to the left that begins at a smaller sum; a segment links to its own, and
        # those in between are not looked at again
        j = len(kept) - 1
        while j >= 0 and kept[j][2] >= left:
            j = kept[j][4]
        while j >= 0 and kept[j][3] < right:
            start, _, left, _, link = kept[j]
            del kept[j:]
            j = link
        kept.append((start, at + 1, left, right, j))
    return [(a, b, right - left) for a, b, left, right, _ in kept]


def log_odds(toxic: np.ndarray, clean: np.ndarray, prior_toxic: np.ndarray, prior: float, ratio: float):
    """(log-odds, z) of counts in two classes; ``prior`` pseudo-counts, a share of them toxic."""
    a, b = toxic + prior * prior_toxic, clean + prior * (1 - prior_toxic)
    value = np.log(a / b) - math.log(ratio)
    return value, value / np.sqrt(1 / a + 1 / b)


def fit_scores(sample: DataFrame) -> tuple[Model, int] | None:
    """Word scores from the sample's words, and the number of clean contexts."""
    pairs = stored(
        sample.mapInArrow(word_pairs, "toxic int, word string, following string").distinct(), "labelled-words"
    )
    counts = (
        pairs.groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    )
    counts = stored(counts, "labelled-counts")
    total = counts.agg(F.sum("t"), F.sum("c")).first()
    if not total[0] or not total[1]:
        return None
    ratio = total[0] / total[1]
    share = total[0] / (total[0] + total[1])
    head = F.when(F.length("word") > PREFIX, F.left("word", F.lit(PREFIX)))
    heads = (
        counts.select(head.alias("word"), "t", "c").filter("word is not null").groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    )

    def taken(frame: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
        # only what is more frequent among toxic documents can score; the sample bounds it
        rows = frame.filter(F.col("t") > ratio * F.col("c")).filter("t >= 2").toArrow()
        return rows.column("word").to_pylist(), rows.column("t").to_numpy().astype(float), rows.column("c").to_numpy().astype(float)

    names, t, c = taken(heads)
    value, z = log_odds(t, c, np.full(len(t), share), PREFIX_PRIOR, ratio)
    prefixes = {w: float(v) for w, v, k in zip(names, value, z, strict=True) if v >= LEAST_SCORE and k >= LEAST_Z}
    lean = {w: float((a + PREFIX_PRIOR * share) / (a + b + PREFIX_PRIOR)) for w, a, b in zip(names, t, c, strict=True)}
    names, t, c = taken(counts)
    prior = np.array([lean.get(w[:PREFIX], share) if len(w) > PREFIX else share for w in names])
    value, z = log_odds(t, c, prior, WORD_PRIOR, ratio)
    words = {w: float(v) for w, v, k in zip(names, value, z, strict=True) if v >= LEAST_SCORE and k >= LEAST_Z}
    mass = sum(a for w, a in zip(names, t, strict=True) if w in words) / total[0]
    clean_mass = sum(b for w, b in zip(names, c, strict=True) if w in words) / total[1]
    rest = min(-0.01, math.log(max(1 - mass, 1e-6) / max(1 - clean_mass, 1e-6)))
    return Model(words, prefixes, rest), int(total[1])


def scored(model, keep_segments: bool):
    """Each row's other columns with its features, and with its significant segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = model.value
        for batch in batches:
            n, total, best, probability, found = [], [], [], [], []
            for text in batch.column(batch.num_columns - 1):
                words = words_of(text.as_py())
                segments = own.segments(words)
                t, b = own.features(segments)
                n.append(len(words))
                total.append(t)
                best.append(b)
                probability.append(own.probability(t, b))
                if keep_segments:
                    names = ("start", "stop", "score", "expected")
                    found.append([dict(zip(names, s, strict=True)) for s in segments if s[3] < SIGNIFICANT])
            arrays = [
                *batch.columns[:-1],
                pa.array(n, pa.int64()),
                pa.array(total, pa.float64()),
                pa.array(best, pa.float64()),
                pa.array(probability, pa.float64()),
            ]
            names = [*batch.schema.names[:-1], "n_words", "total", "best", "score"]
            if keep_segments:
                arrays.append(pa.array(found, pa.list_(SEGMENT)))
                names.append("passages")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            yield batch.slice(first, ROWS)


def clean_distribution(model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of clean documents: how often each score occurs, and the segments' scores."""
    own: Model = model.value
    for batch in slices(batches):
        values: list[float] = []
        kinds: list[int] = []
        for text in batch.column(0):
            words = words_of(text.as_py())
            if words:
                scores = own.scores(words)
                values += scores[scores > 0].tolist()
                kinds += [0] * int((scores > 0).sum())
                segments = [s for *_, s in maximal_segments(scores)]
                values += [*segments, float(len(words))]
                kinds += [1] * len(segments) + [2]
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(values, pa.float64())], names=["kind", "value"])


def calibrate(model: Model, positive: np.ndarray, segments: np.ndarray, tokens: float) -> None:
    """Scale and rate of the extreme-value law of segment scores in clean text."""

    def excess(scale: float) -> float:
        rest = (tokens - len(positive)) * math.exp(scale * model.rest)
        return (rest + float(np.exp(scale * positive).sum())) / tokens - 1

    low, high = 0.0, 1.0
    while high < 8 and excess(high) < 0:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    model.scale = max(high, 0.2)
    if len(segments):
        seen = float(np.median(segments))
        at_least = float((segments >= seen).sum())
        model.rate = min(1.0, max(at_least * math.exp(model.scale * seen) / tokens, 1e-3))
    else:
        model.rate = 1.0


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a ridge logistic regression with balanced classes, by Newton's method."""
    w = np.zeros(x.shape[1])
    balance = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (balance * (p - y)) + ridge * w
        curve = (x * (balance * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Model:
    """A model from the labelled documents that are not held out."""
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, most).select("toxic", "text")
    sample = sample.withColumn("toxic", F.col("toxic").cast("int"))
    started = fit_scores(sample)
    if started is None:
        return Model({}, {}, -0.01)
    model, _ = started
    shared = spark.sparkContext.broadcast(model)
    seen = (
        sample.filter("toxic = 0")
        .select("text")
        .mapInArrow(lambda batches: clean_distribution(shared, batches), "kind int, value double")
        .groupBy("kind", "value")
        .agg(F.count("*").alias("n"))
        .toArrow()
    )
    kind, value, n = (seen.column(c).to_numpy() for c in ("kind", "value", "n"))
    parts = [np.repeat(value[kind == k], n[kind == k]) for k in (0, 1, 2)]
    calibrate(model, parts[0], parts[1], float(parts[2].sum()))
    shared = spark.sparkContext.broadcast(model)
    rows = sample.mapInArrow(scored(shared, False), f"toxic int, {FEATURES}, score double").select("toxic", "total", "best").toArrow()
    total, best, toxic = (rows.column(c).to_numpy().astype(float) for c in ("total", "best", "toxic"))
    x = np.stack([np.ones(len(total)), total, np.array([squash(b) for b in best])], axis=1)
    order = np.lexsort((toxic, best, total))  # the same sums whatever the order of arrival
    model.weights = logistic(x[order], toxic[order])
    model.fitted = True
    return model


def score_documents(docs: DataFrame, model: Model, keep_segments: bool = True) -> DataFrame:
    """``doc_id, n_words, total, best, score`` of each row, and its ``passages`` in words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = f"doc_id bigint, {FEATURES}, score double"
    if keep_segments:
        schema += ", passages array<struct<start: int, stop: int, score: double, expected: double>>"
    return docs.select("doc_id", "text").mapInArrow(scored(shared, keep_segments), schema)


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = shared.value
        for batch in slices(batches):
            keep = [own.probability(*own.features(own.segments(words_of(t.as_py())))) < threshold for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))
        own.cache.clear()
        give_back()

    return docs.mapInArrow(run, docs.schema)


def op4_maximal_segments(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score_documents(docs, model).select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_words",
        "passages",
    )
