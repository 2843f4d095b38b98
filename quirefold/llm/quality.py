"""Text quality by naive Bayes support vectors.

A text's tokens are maximal runs of letters, digits and bytes beyond ASCII, and of other visible
characters, upper and lower case apart. Its features are the indicators of its tokens, of its pairs of
adjacent tokens, and of how the tokens of its runs of four repeat each other, hashed to 2^BITS numbers.

Fitting, on a bounded sample of labelled documents (MOST_LABELLED of each class, drawn by a hash):

* A feature's ratio is the logarithm of how much more often, smoothed, documents of the good class have it.
  Features of fewer than LEAST_DOCUMENTS documents of the sample have none.
* A document is the vector of its features' ratios, at unit length. A linear hinge-loss model with
  a constant is fitted to these by dual coordinate descent (Hsieh et al., 2008); the classes weigh alike.
* Margins become probabilities by a logistic curve. It is fitted to margins of models that have not seen the
  document: the sample falls into FOLDS parts, and each part is judged by a model of the others. The classes'
  shares of all labels that are not held out shift the curve.

Labels, language, source and id never enter a score. A null or empty text has no features and gets the
score of the constant alone. Without labelled documents of both classes every score is 0.5.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored, table
from .toxicity import remainder
from .wordhash import mix

MOST_LABELLED = 3_000
THRESHOLD = 0.5
BITS = 20
SMOOTHING = 1.0
LEAST_DOCUMENTS = 3
#: upper bound of a document's dual variable, divided by its class's share
COST = 1.0
FOLDS = 3
ROUNDS = 15
CONSTANT = 0.1
#: bytes of text whose features are found at once
PIECE = 1 << 18

#: what a byte belongs to: 0 space and control characters, 1 letters and digits, 2 other visible characters
KIND = np.zeros(256, np.uint8)
KIND[0x21:0x7F] = 2
KIND[0x80:] = 1
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
    KIND[_first : _last + 1] = 1
_U = np.uint64
STEP = 0x9E3779B97F4A7C15
#: powers of STEP modulo 2^64, and of its inverse, for one piece
UP, DOWN = (
    np.cumprod(np.concatenate([np.ones(1, "<u8"), np.full(PIECE, base, "<u8")]), dtype="<u8")
    for base in (STEP, pow(STEP, -1, 1 << 64))
)


def token_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of the tokens of a piece of at most PIECE bytes."""
    kind = KIND[data]
    edge = np.flatnonzero(np.diff(kind, prepend=0, append=0))
    first, last = edge[:-1], edge[1:]
    some = kind[first] > 0 if len(first) else np.zeros(0, bool)
    first, last = first[some], last[some]
    sums = np.zeros(len(data) + 1, "<u8")
    np.cumsum((data.astype("<u8") + _U(1)) * UP[: len(data)], out=sums[1:])
    return mix((sums[last] - sums[first]) * DOWN[first] + (last - first).astype("<u8")), first


def pieces(text: np.ndarray) -> Iterator[np.ndarray]:
    """A text's bytes in pieces of at most PIECE, cut at a space where one is near the end.

    A token that is longer than a piece is cut.
    """
    while len(text) > PIECE:
        spaces = np.flatnonzero(KIND[text[PIECE // 2 : PIECE]] == 0)
        stop = PIECE // 2 + int(spaces[-1]) if len(spaces) else PIECE
        yield text[:stop]
        text = text[stop:]
    yield text


def text_features(text: np.ndarray, bits: int) -> np.ndarray:
    """The distinct features of one text of any length, ascending."""
    found = np.zeros(0, "<u8")
    before = np.zeros(0, "<u8")
    for piece in pieces(text):
        tokens = np.concatenate([before, token_hashes(piece)[0]])
        before = tokens[-3:]
        hashes = np.concatenate([tokens, pairs(tokens), repeats(tokens)])
        found = np.unique(np.concatenate([found, hashes >> _U(64 - bits)]))
    return found


def pairs(tokens: np.ndarray) -> np.ndarray:
    return mix(tokens[:-1] * _U(3) + tokens[1:] * _U(5) + _U(1))


def repeats(tokens: np.ndarray) -> np.ndarray:
    """Of each run of four tokens, which of them are equal."""
    a, b, c, d = (tokens[k : len(tokens) - 3 + k] for k in range(4)) if len(tokens) > 3 else [tokens[:0]] * 4
    pattern = np.zeros(len(a), "<u8")
    for bit, (x, y) in enumerate(((a, b), (b, c), (c, d), (a, c), (b, d), (a, d))):
        pattern |= (x == y).astype("<u8") << _U(bit)
    return mix(pattern)


def features(texts: pa.Array, bits: int = BITS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row of the first text, number of each feature's text, feature) of some texts at a time; a text's
    features are distinct."""
    texts = pc.fill_null(texts, "")
    if not len(texts):
        return
    kind = "<i8" if pa.types.is_large_string(texts.type) else "<i4"
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, kind)[texts.offset : texts.offset + len(texts) + 1].astype("<i8")
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = int(np.searchsorted(offsets, offsets[row] + PIECE - 2 * (1 << 12), side="right")) - 1
        stop = min(max(stop, row), row + (1 << 12), len(texts))
        if stop <= row:
            own = text_features(data[offsets[row] : offsets[row + 1]], bits)
            yield row, np.zeros(len(own), "<i8"), own
            row += 1
            continue
        # a space between texts, so that no token goes on
        bounds = offsets[row : stop + 1] - offsets[row]
        joined = np.insert(data[offsets[row] : offsets[stop]], bounds[1:-1], 0x20)
        tokens, first = token_hashes(joined)
        doc = np.searchsorted(bounds[1:] + np.arange(1, stop - row + 1), first, side="right")
        owner, hashes = [doc], [tokens]
        for of, words in ((pairs, 2), (repeats, 4)):
            within = np.flatnonzero(doc[: len(doc) - words + 1] == doc[words - 1 :])
            owner.append(doc[within])
            hashes.append(of(tokens)[within])
        found = np.concatenate(hashes) >> _U(64 - bits)
        own = np.unique(np.concatenate(owner).astype("<u8") << _U(bits) | found)
        yield row, (own >> _U(bits)).astype("<i8"), own & _U((1 << bits) - 1)
        row = stop


class Model:
    """Weights and ratios by feature, 2^BITS numbers each whatever the corpus."""

    def __init__(self, ratio: np.ndarray, weight: np.ndarray, constant: float, slope: float, offset: float):
        self.ratio, self.weight, self.constant = ratio.astype("<f4"), weight.astype("<f4"), constant
        self.slope, self.offset = slope, offset

    def margins(self, owner: np.ndarray, found: np.ndarray, n: int) -> np.ndarray:
        ratio = self.ratio[found].astype(float)
        length = np.sqrt(np.bincount(owner, ratio * ratio, n))
        sums = np.bincount(owner, ratio * self.weight[found], n)
        return np.divide(sums, length, out=np.zeros(n), where=length > 0) + self.constant

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts))
        done = 0
        for row, owner, found in features(texts):
            n = int(owner[-1]) + 1 if len(owner) else 0
            out[done:row] = self.constant
            out[row : row + n] = self.margins(owner, found, n)
            done = row + n
        out[done:] = self.constant
        return 1 / (1 + np.exp(-np.clip(self.slope * out + self.offset, -500, 500)))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int) -> tuple[DataFrame, dict[int, int]]:
    """``good, text`` of at most so many documents a class, none of them held out, and how many labels that are
    not held out each class has.

    A document that is labelled both ways counts in both classes.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & (remainder(F.col("doc_id")) != 1))
    known = known.select("doc_id", F.col("quality").cast("int").alias("good"), F.xxhash64("doc_id").alias("draw")).distinct()
    sizes = dict(known.groupBy("good").count().collect())

    def drawn(kind: int, size: int) -> DataFrame:
        # a share by hash first, a fifth more than wanted and some, so that few rows meet in one task
        share = min(1.0, (1.2 * most + 100) / max(size, 1))
        few = known.filter((F.col("good") == kind) & (F.pmod("draw", F.lit(1 << 30)) < int(share * (1 << 30))))
        return few.orderBy("draw", "doc_id").limit(most)

    chosen = drawn(0, sizes.get(0, 0)).unionAll(drawn(1, sizes.get(1, 0))).drop("draw")
    chosen = F.broadcast(chosen)  # at most 2 x most rows of two numbers
    return docs.select(F.col("doc_id").cast("bigint"), "text").join(chosen, "doc_id").select("good", "text"), sizes


def sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, features) of each text."""
    for batch in batches:
        for row, owner, found in features(batch.column(1)):
            n = int(owner[-1]) + 1 if len(owner) else 1
            bounds = np.searchsorted(owner, np.arange(n + 1)).astype("<i4")
            lists = pa.ListArray.from_arrays(bounds, pa.array(found.astype("<i4")))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, n), lists], names=["good", "features"])


def log_ratios(good: np.ndarray, bad: np.ndarray, n_good: int, n_bad: int) -> np.ndarray:
    """Logarithm of the ratio of a feature's smoothed shares of documents; 0 for rare features."""
    p = (good + SMOOTHING) / (n_good + 2 * SMOOTHING)
    q = (bad + SMOOTHING) / (n_bad + 2 * SMOOTHING)
    return np.where(good + bad >= LEAST_DOCUMENTS, np.log(p / q), 0.0)


class Rows:
    """Sparse unit vectors of documents."""

    def __init__(self, lists: list[np.ndarray], ratio: np.ndarray):
        self.at = [f[ratio[f] != 0] for f in lists]
        self.values = []
        for f in self.at:
            v = ratio[f]
            self.values.append(v / math.sqrt(float(v @ v)) if len(v) else v)

    def margins(self, weight: np.ndarray, constant: float) -> np.ndarray:
        return np.array([float(weight[a] @ v) for a, v in zip(self.at, self.values, strict=True)]) + constant


def descend(rows: Rows, sign: np.ndarray, cost: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """Weights and constant of the hinge-loss model, by dual coordinate descent.

    One document's dual variable at a time is set to its best value between 0 and its cost, and the weights
    follow; documents come in another order every round. A fixed seed: the same rows give the same model.
    """
    weight, constant = np.zeros(size), 0.0
    alpha = np.zeros(len(sign))
    diagonal = np.array([float(v @ v) + CONSTANT**2 for v in rows.values])
    order = np.random.default_rng(1)
    for _ in range(ROUNDS):
        worst = 0.0
        for i in order.permutation(len(sign)).tolist():
            at, v = rows.at[i], rows.values[i]
            gradient = sign[i] * (float(weight[at] @ v) + constant) - 1
            new = min(max(alpha[i] - gradient / diagonal[i], 0.0), cost[i])
            change = new - alpha[i]
            if change:
                alpha[i] = new
                weight[at] += change * sign[i] * v
                constant += change * sign[i] * CONSTANT**2
                worst = max(worst, abs(change) * diagonal[i])
        if worst < 1e-3:
            break
    return weight, constant


def logistic_curve(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability of the good class, by Newton's method, lightly damped."""
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    weigh = np.where(good == 1, 0.5 / good.mean(), 0.5 / (1 - good.mean()))
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weigh * (p - good)) + 1e-3 * w
        curve = (x * (weigh * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        change = np.linalg.solve(curve, gradient)
        w = w - np.clip(change, -5, 5)
        if np.abs(change).max() < 1e-9:
            break
    return max(float(w[0]), 1e-3), float(w[1])


def train(lists: list[np.ndarray], good: np.ndarray, odds: float = 1.0, bits: int = BITS) -> Model:
    """A model from the features and classes of the sample's documents. Both classes must occur; ``odds``:
    how many times as frequent the good class is in all."""

    def fitted(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        def count(kind: int) -> np.ndarray:
            own = [lists[i] for i in chosen[good[chosen] == kind]]
            return np.bincount(np.concatenate(own), minlength=1 << bits) if own else np.zeros(1 << bits)

        kinds = good[chosen]
        n_good, n_bad = int(kinds.sum()), int((1 - kinds).sum())
        ratio = log_ratios(count(1), count(0), n_good, n_bad)
        share = np.where(kinds == 1, n_good, n_bad) / len(kinds)
        rows = Rows([lists[i] for i in chosen], ratio)
        return ratio, *descend(rows, 2.0 * kinds - 1, COST * 0.5 / share, 1 << bits)

    everything = np.arange(len(good))
    ratio, weight, constant = fitted(everything)
    part = everything % FOLDS
    margin = np.zeros(len(good))
    for k in range(FOLDS):
        rest, own = everything[part != k], everything[part == k]
        if not len(own) or len(set(good[rest])) < 2:
            margin[own] = Rows([lists[i] for i in own], ratio).margins(weight, constant)
            continue
        r, w, c = fitted(rest)
        margin[own] = Rows([lists[i] for i in own], r).margins(w, c)
    slope, offset = logistic_curve(margin, good)
    return Model(ratio, weight, constant, slope, offset + math.log(odds))


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Model | None:
    """A model from the labelled documents that are not held out; none without both classes."""
    sample, sizes = labelled_sample(docs, labels, most)
    rows = stored(sample.mapInArrow(sample_features, "good int, features array<int>"), "quality-sample")
    # the sample bounds what the driver takes; its order does not depend on that of arrival
    ordered = rows.orderBy("good", F.xxhash64("features"), "features").toArrow().combine_chunks()
    good = ordered.column("good").to_numpy().astype("<i8")
    if not 0 < good.sum() < len(good):
        return None
    column = ordered.column("features").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    bounds, flat = column.offsets.to_numpy(), column.values.to_numpy()
    lists = [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return train(lists, good, sizes[1] / sizes[0])


def scored(model, at: int):
    """Each row with its score in a column behind the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model | None = model.value
        for batch in batches:
            texts = batch.column(at)
            found = np.full(len(texts), 0.5) if own is None else own.scores(texts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, "_score"])

    return run


def score_documents(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, score`` of each row; null ids, null texts and repeated rows keep their rows, and other
    columns are not looked at. No rows: an empty table."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in scored(shared, 1)(batches):
            yield batch.select(["doc_id", "_score"]).rename_columns(["doc_id", "score"])

    own = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return own.mapInArrow(run, "doc_id bigint, score double")


def of_quality(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model | None = shared.value
        for batch in batches:
            if own is not None:
                batch = batch.filter(pa.array(own.scores(batch.column(at)) >= threshold))
            yield batch

    return docs.mapInArrow(run, docs.schema)


def op13_naive_bayes_svm(spark, sf_dir: str) -> DataFrame:
    """Per document its quality score, and whether its label was held out. A document without doc_id is not
    held out; without text it is scored as an empty one."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score_documents(docs, model).select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
