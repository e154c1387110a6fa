"""Toxicity: logistic regression over hashed word n-grams and skip-grams, trained by FTRL-proximal.

Every coordinate has its own learning rate, and the L1 term keeps coordinates at exactly zero until their gradients
have added up to more than it, so what is broadcast is a short list of weights in an array of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.llm.common import LETTERS, WordHashes, mixed, shingle_hashes

BITS = 18
# Training takes at most so many labelled texts, the first by a hash of their id; all other work covers all rows.
SAMPLE = 16_000
EPOCHS = 6
ALPHA, BETA, L1, L2 = 40.0, 0.1, 0.3, 0.0
# Toxic texts are the rarer ones; each counts as so many.
TOXIC_WEIGHT = 2.0


def features(text: bytes | None, hashes: WordHashes) -> np.ndarray:
    """Distinct buckets of words, neighbours, and words two apart."""
    words = text.translate(LETTERS).split() if text else []
    if not words:
        return np.zeros(0, np.int32)
    found = hashes.of(words)
    parts = [mixed(found)]
    if len(found) > 1:
        parts.append(shingle_hashes(found, 2))
    if len(found) > 2:
        parts.append(mixed(found[:-2] * np.uint64(0xD6E8FEB86659FD93) + found[2:] * np.uint64(0xA0761D6478BD642F)))
    seen = np.zeros(1 << BITS, bool) if len(words) > 20_000 else None
    buckets = (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int32)
    if seen is not None:
        seen[buckets] = True
        return np.flatnonzero(seen).astype(np.int32)
    return np.unique(buckets)


class FTRL:
    """Weights from accumulated gradients; coordinate ``1 << bits`` is the bias, which has no L1 or L2 term.

    A text with k features gives each the value 1 / sqrt(k + 1), so long texts take no longer steps than short ones.
    """

    def __init__(self, bits: int = BITS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        self.alpha, self.beta, self.l1, self.l2, self.bias = alpha, beta, l1, l2, 1 << bits

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, rate = self.z[at], (self.beta + np.sqrt(self.n[at])) / self.alpha
        free = at == self.bias
        l1, l2 = np.where(free, 0.0, self.l1), np.where(free, 0.0, self.l2)
        return np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / (rate + l2), 0.0)

    def learn(self, buckets: np.ndarray, label: int) -> None:
        at = np.append(buckets, self.bias)
        values = np.full(len(at), 1 / np.sqrt(len(at)))
        values[-1] = 1.0
        w = self.weights(at)
        error = 1 / (1 + np.exp(-np.clip((w * values).sum(), -30, 30))) - label
        gradient = error * values * (TOXIC_WEIGHT if label else 1.0)
        n = self.n[at]
        self.z[at] += gradient - (np.sqrt(n + gradient * gradient) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + gradient * gradient


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS) -> np.ndarray:
    """Weights, the bias last, from labelled documents outside the held-out fold; an empty array without any.

    At most ``sample`` documents are used, so the one task that learns has a bounded input.
    """
    known = labels.filter("toxic IS NOT NULL AND crc32(cast(doc_id AS string)) % 5 != 0")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("turn", F.xxhash64("doc_id"))
    known = known.orderBy("turn", "doc_id").limit(sample)

    @F.arrow_udf("array<int>")
    def found(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = WordHashes()
        for part in parts:
            yield pa.array([features(x, hashes) for x in part.cast(pa.binary()).to_pylist()], pa.list_(pa.int32()))

    def learn(batches):
        rows = [(x.as_py(), np.asarray(y.values, np.int32)) for b in batches for x, y in zip(b.column(0), b.column(1), strict=True)]
        if rows:
            model = FTRL()
            for _ in range(epochs):
                for toxic, buckets in rows:
                    model.learn(buckets, int(toxic > 0))
            w = model.weights(np.arange(model.bias + 1))
            at = np.append(np.flatnonzero(w[:-1]), model.bias)
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int32()), "weight": pa.array(w[at], pa.float64())})

    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id"])
    rows = rows.select("toxic", found("text").alias("buckets"), "turn", "doc_id")
    rows = rows.repartition(1).sortWithinPartitions("turn", "doc_id")
    learned = rows.select("toxic", "buckets").mapInArrow(learn, "bucket int, weight double").toPandas()
    if not len(learned):
        return np.zeros(0)
    out = np.zeros((1 << BITS) + 1)
    out[learned.bucket] = learned.weight
    return out


def scored(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """All columns of ``docs`` and ``toxicity``, a number from 0 to 1 that depends on the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes, w = WordHashes(), shared.value
        for part in parts:
            if not len(w):
                yield pa.array(np.zeros(len(part)))
                continue
            found = [features(x, hashes) for x in part.cast(pa.binary()).to_pylist()]
            sums = [w[-1] + w[x].sum() / np.sqrt(len(x) + 1) for x in found]
            yield pa.array(1 / (1 + np.exp(-np.clip(np.array(sums, np.float64), -30, 30))))

    return docs.withColumn("toxicity", score("text"))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """All rows and columns of ``docs`` and ``toxicity`` (0 to 1, higher: more likely toxic).

    ``docs`` needs doc_id and text, ``labels`` doc_id and toxic; a document is toxic if any of its label rows says so. Labels
    with a null id or value are not learned from, nor are those of the fold where crc32(doc_id) mod 5 is 0. Null
    and empty texts have no features and get the score of the bias. Without anything to learn from, all scores are 0. Texts of any length are taken
    whole; equal texts get equal scores; repeated rows each come out, and are learned from once. A column
    called ``toxicity`` in ``docs`` is replaced.
    """
    return scored(docs.drop("toxicity"), train(docs, labels, sample))
