"""Toxicity by FTRL-proximal logistic regression.

Features are the distinct hashed words, word pairs and pairs that skip one or two words of a text.  Every coordinate has a learning
rate of its own, and the L1 term keeps at zero what carries no evidence, so that the weights are few and go to every task.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankweave.llm.common import bound_batches, text_chunks
from bankweave.session import stage

BITS = 22
GAPS = (1, 2, 3)  # a word and the next one, and pairs that skip one or two words
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.0
EPOCHS = 3
MAX_DOCS = 12_000
THRESHOLD = 0.3
_BIAS = -1
_SEGMENT = 1 << 20
_CACHE = 200_000
_WORD = re.compile(r"[^\W_]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Hashes of the words met lately."""

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < _CACHE:
            self[word] = value
        return value

    def of(self, text: str) -> np.ndarray:
        """Hashes of all words; a long text is cut between words, so that the list of its words stays short."""
        parts, at = [], 0
        while at < len(text):
            stop = at + _SEGMENT
            while stop < len(text) and text[stop].isalnum():
                stop += 1
            words = _WORD.findall(text[at:stop].lower())
            parts.append(np.fromiter(map(self.__getitem__, words), np.uint64, len(words)))
            at = stop
        return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def features(known: WordHashes, texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text numbers and features of every kind in turn, one for each place where it occurs."""
    if len(known) >= _CACHE:
        known.clear()
    hashes = [known.of((t or b"").decode("utf-8", "replace")) for t in texts]
    row = np.repeat(np.arange(len(texts)), [len(h) for h in hashes])
    flat = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    place = np.uint64(64 - BITS)
    yield row, (_mix(flat) >> place).astype(np.int64)
    for gap in GAPS:
        inside = row[:-gap] == row[gap:]
        pair = flat[:-gap][inside] * _ODD + flat[gap:][inside] + np.uint64(gap)
        yield row[:-gap][inside], (_mix(pair) >> place).astype(np.int64)


@dataclass
class Model:
    indices: np.ndarray  # features with a weight, sorted
    weights: np.ndarray
    bias: float
    learned: bool


class Learner:
    """FTRL-proximal state: z and n of every feature, and of the bias, which has no L1 term."""

    def __init__(self, alpha: float, beta: float, l1: float, l2: float) -> None:
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, l1 = self.z[at], self.l1
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
        return -shrunk / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)

    def bias(self) -> float:
        return -self.z[-1] / ((self.beta + math.sqrt(self.n[-1])) / self.alpha)

    def learn(self, at: np.ndarray, label: int) -> None:
        w, bias = self.weights(at), self.bias()
        g = _sigmoid(bias + float(w.sum())) - label
        for places, own in ((at, w), (np.array([-1]), np.array([bias]))):
            n = self.n[places]
            rate = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
            self.z[places] += g - rate * own
            self.n[places] = n + g * g


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


def sample(docs: DataFrame, labels: DataFrame, learn: Column | None, most: int, doc: str, text: str, label: str) -> DataFrame:
    """``id``, ``text`` and ``label`` of about ``most`` labelled documents: those whose id hashes into the share that their number asks for.

    An id counts once: with label 1 if any of its labels is 1, and with one of its texts.  The ids chosen, at most about ``most``
    rows, are stored, so that Spark knows their size, sends them to the tasks and shuffles no text but those chosen.
    """
    known = labels.filter((F.lit(True) if learn is None else learn) & F.col(doc).isNotNull() & F.col(label).isin(0, 1))
    known = known.groupBy(F.col(doc).alias("__id")).agg(F.max(label).cast("int").alias("__label"))
    share = most / max(most, known.count())
    place = (F.xxhash64("__id").cast("double") / 2.0**63 + 1) / 2
    chosen = stage(known.filter(place < share), "toxicity-sample")
    held = docs.select(F.col(doc).alias("__id"), F.col(text).alias("__text")).join(chosen, "__id")
    return held.groupBy(F.col("__id").alias("id")).agg(
        F.min_by("__text", F.xxhash64("__text")).alias("text"), F.max("__label").alias("label"))


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column | None = None, most: int = MAX_DOCS, epochs: int = EPOCHS,
    alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2, doc: str = "doc_id", text: str = "text", label: str = "toxic",
) -> Model:
    """Weights learned from about ``most`` documents that ``labels`` marks 0 or 1, of those rows of ``labels`` where ``learn`` holds.

    The bound, an expected number, is a parameter of the fit alone.  The learning is a sequence: one task reads the sampled
    documents once for each epoch, in an order given by hashes, and holds two numbers a feature.  Null ids and labels are
    not used; a null text has no features.  With nothing to learn from, every score will be 0.
    """
    bound_batches(docs.sparkSession)
    rows = sample(docs, labels, learn, most, doc, text, label)
    order = rows.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs)))).repartition(1).sortWithinPartitions("epoch", F.xxhash64("epoch", "id"), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner, known, seen = Learner(alpha, beta, l1, l2), WordHashes(), False
        for batch, texts in text_chunks(batches, "text"):
            kinds = list(features(known, texts))
            key = np.unique(np.concatenate([(row << BITS) | feature for row, feature in kinds]))
            starts = np.searchsorted(key, np.arange(len(texts) + 1) << BITS)
            for i, y in enumerate(batch.column("label").to_pylist()):
                learner.learn(key[starts[i] : starts[i + 1]] & ((1 << BITS) - 1), y)
                seen = True
        if seen:
            weights = learner.weights(slice(0, 1 << BITS))
            at = np.flatnonzero(weights)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, _BIAS)), pa.array(np.append(weights[at], learner.bias()))], names=["at", "weight"])

    found = sorted(order.select("text", "label").mapInArrow(run, "at long, weight double").collect())
    bias = [w for i, w in found if i == _BIAS]
    kept = [(i, w) for i, w in found if i != _BIAS]
    return Model(np.array([i for i, _ in kept], np.int64), np.array([w for _, w in kept], float), bias[0] if bias else 0.0, bool(bias))


def predict(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    The whole text is scored.  A text that is null, empty or has no word gets the score of the bias alone.  If nothing was
    learned, the score is 0.  Rows are judged one by one, so repeated rows and empty tables need no care; columns named
    like the added ones are replaced and all others pass through.
    """
    bound_batches(docs.sparkSession)
    added = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    docs = docs.drop(*added.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense, known = np.zeros(1 << BITS, np.float32), WordHashes()
        dense[model.indices] = 1  # marks the features that have a weight
        for batch, texts in text_chunks(batches, text):
            hits = []
            for row, feature in features(known, texts):
                some = np.flatnonzero(dense[feature])
                hits.append((row[some] << BITS) | feature[some])
            key = np.unique(np.concatenate(hits))
            weights = model.weights[np.searchsorted(model.indices, key & ((1 << BITS) - 1))] if len(key) else np.empty(0)
            margin = model.bias + np.bincount(key >> BITS, weights=weights, minlength=len(texts))
            score = 1 / (1 + np.exp(-np.clip(margin, -35, 35))) if model.learned else np.zeros(len(texts))
            columns = [pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *added.fieldNames()])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added.fields]))
