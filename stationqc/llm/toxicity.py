"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts (P) and texts of which nothing is assumed (U) train a linear classifier in numpy. With the class prior pi, the share of
toxic rows among the labelled ones, the risk is pi * R(P as toxic) + max(0, R(U as clean) - pi * R(P as clean)): the correction takes the
toxic texts hidden in U out of its risk, and is not let below zero, where it would only memorize P.

A text's features are its words (any case, outer punctuation off) and their beginnings, hashed into 2 ** FEATURE_BITS: that one is there, and that one
is dense (at least one in DENSE words), since in some languages toxic words begin like rare harmless ones. Only
features that are clearly more frequent in P than in U are learned. P and U are bounded samples, P_ROWS and U_ROWS at most, the first by a hash of
doc_id, taken from rows whose fold is not held out; every text of the table is scored, whole, where it is read.

Null and empty texts have no features and get the score of the bias. Without confirmed toxic rows all scores are 0. Repeated rows get the
same score; repeated labels count once, the highest; a null doc_id is never learned from, nor held out; extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationqc.llm import tokens
from stationqc.llm.common import read

FOLDS = 5
P_ROWS = 4000
U_ROWS = 8000
FEATURE_BITS = 21
#: Lengths of the word beginnings that are features beside the word.
BEGINNINGS = (4, 5, 6, 7)
#: Words per occurrence of a dense feature, at most.
DENSE = 130
#: A feature is learned if it is RATIO times as frequent in P as in U, and in more texts of P than U lets expect, by SURPRISE standard deviations.
RATIO, SURPRISE = 2.0, 4.0
MOST_FEATURES = 4096
STEPS, RATE, DECAY = 400, 0.05, 1e-4
REMEMBERED = 1_000_000

#: Where the numbers of dense features begin.
_DENSE_FROM = 1 << FEATURE_BITS
_OUTER = "".join(map(chr, range(33, 48))) + ":;<=>?@[]^_`{|}~¡¿«»“”„‘’…"


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def word_features(word: str) -> tuple[int, ...]:
    word = word.strip(_OUTER)
    if not word:
        return ()
    parts = [f"={word}", *(word[:n] for n in BEGINNINGS if len(word) >= n)]
    return tuple(xxhash.xxh3_64_intdigest(p) & _DENSE_FROM - 1 for p in parts)


class Features(dict):
    """Features of words, of those in `only` if it is given; remembered up to a bound."""

    def __init__(self, only: dict[int, float] | None = None):
        super().__init__()
        self.only = only

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        found = word_features(word)
        self[word] = found = found if self.only is None else tuple(f for f in found if f in self.only or f + _DENSE_FROM in self.only)
        return found

    def of(self, text: str | None) -> set[int]:
        words = (text or "").lower().split()
        times = Counter(f for features in map(self.__getitem__, words) if features for f in features)
        found = set(times)
        found.update(f + _DENSE_FROM for f, n in times.items() if n * DENSE >= len(words))
        return found if self.only is None else {f for f in found if f in self.only}


class Model:
    def __init__(self, weights: dict[int, float], bias: float):
        self.weights, self.bias = weights, bias

    def score(self, features: set[int]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.bias + sum(self.weights[f] for f in sorted(features)), -40, 40))))


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model:
    """Of the features of each text of P and of U. Equal texts of P count once."""
    positive = [np.frombuffer(x, np.int32) for x in sorted({np.sort(p).astype(np.int32).tobytes() for p in positive if len(p)})]
    if not positive or not unlabelled:
        return Model({}, -40.0)
    size = 2 * _DENSE_FROM

    def texts_with(rows: list[np.ndarray]) -> np.ndarray:
        found = np.zeros(size, np.int32)
        for r in rows:
            found[r] += 1
        return found

    in_p, in_u = texts_with(positive), texts_with(unlabelled)
    some = np.flatnonzero(in_p > SURPRISE)
    share_p, share_u = in_p[some] / len(positive), (in_u[some] + 1) / len(unlabelled)
    expected = share_u * len(positive)
    usable = (in_p[some] - expected >= SURPRISE * np.sqrt(expected + 1)) & (share_p >= RATIO * share_u)
    some, gain = some[usable], (share_p * np.log(share_p / share_u))[usable]
    chosen = np.sort(some[np.argsort(-gain, kind="stable")[:MOST_FEATURES]])
    column = np.full(size, -1, np.int32)
    column[chosen] = np.arange(len(chosen))

    def matrix(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
        cells = [c[c >= 0] for c in (column[r] for r in rows)]
        return np.repeat(np.arange(len(rows)), [len(c) for c in cells]), np.concatenate([np.empty(0, np.int64), *cells]).astype(np.int64), len(rows)

    p, u = matrix(positive), matrix(unlabelled)
    w, b = np.zeros(len(chosen)), -2.0
    mean, square = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    logit = lambda m: np.bincount(m[0], w[m[1]], m[2]) + b
    back = lambda m, g: np.append(np.bincount(m[1], g[m[0]], len(chosen)), g.sum())
    for step in range(1, STEPS + 1):
        sp, su = sigmoid(logit(p)), sigmoid(logit(u))
        # Mean logistic losses of calling U and P clean, and their gradients by the logit.
        negative = -np.log(np.maximum(1 - su, 1e-12)).mean() + prior * np.log(np.maximum(1 - sp, 1e-12)).mean()
        as_clean = back(u, su / u[2]) - prior * back(p, sp / p[2])
        gradient = prior * back(p, (sp - 1) / p[2]) + as_clean if negative >= 0 else -as_clean
        gradient[:-1] += DECAY * w
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        move = RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Model({int(f): float(x) for f, x in zip(chosen, w, strict=True) if x}, float(b))


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of docs (doc_id, text) and labels (doc_id, toxic), from rows that are not held out."""
    docs = docs.select(F.col("doc_id").cast("long"), "text").filter(fold(F.col("doc_id")) != 0)
    known = labels.filter("toxic is not null").filter(fold(F.col("doc_id")) != 0).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    rate, n = known.agg(F.avg((F.col("toxic") == 1).cast("double")), F.count("*")).first()
    if not n or not rate:
        return Model({}, -40.0)
    order = F.xxhash64("doc_id")
    confirmed = known.filter("toxic = 1").orderBy(order, "doc_id").limit(P_ROWS).select("doc_id", F.lit(1).alias("p"))
    total = docs.count()
    # A hash threshold that lets about U_ROWS texts through, whatever the table's size.
    below = int(-(1 << 63) + (1 << 64) * min(1.0, U_ROWS / max(1, total))) - 1
    texts = docs.join(F.broadcast(confirmed), "doc_id", "left").withColumn("u", order <= F.lit(min(below, (1 << 63) - 1))).filter("p = 1 or u")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Features()
        for batch in batches:
            for part in tokens.slices(batch, "text"):
                found = [np.array(sorted(known.of(t)), np.int32) for t in part.column("text").to_pylist()]
                yield pa.record_batch([part.column("p"), part.column("u"), part.column("doc_id"), pa.array(found, pa.list_(pa.int32()))], names=["p", "u", "doc_id", "features"])

    rows = texts.select("doc_id", "text", "p", "u").mapInArrow(features, "p int, u boolean, doc_id long, features array<int>").toArrow()
    ids, p, u = (rows.column(c).to_pylist() for c in ("doc_id", "p", "u"))
    features_of = [x for chunk in rows.column("features").chunks for x in chunk.to_numpy(zero_copy_only=False)]
    order = sorted(range(len(ids)), key=lambda k: (ids[k], len(features_of[k]), features_of[k].tobytes()))
    return train([features_of[k] for k in order if p[k]], [features_of[k] for k in order if u[k]], rate)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of docs (doc_id, text)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Features(model.weights)
        for batch in batches:
            for part in tokens.slices(batch, "text"):
                scores = [model.score(known.of(t)) for t in part.column("text").to_pylist()]
                yield pa.record_batch([part.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, "doc_id long, score double")


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs that the model doesn't call toxic, with all their columns."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Features(model.weights)
        for batch in batches:
            for part in tokens.slices(batch, "text"):
                yield part.filter(pa.array([model.score(known.of(t)) < 0.5 for t in part.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    rows = scored(docs, fitted(docs, read(spark, sf_dir, "labels", "doc_id", "toxic")))
    return rows.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
