"""Toxicity scores by logistic regression, trained with the FTRL-proximal method.

Features are hashed into `2 ** BITS` coordinates: words, pairs of neighbouring words and
pairs with one word between (skip-grams), by their number in the text. Every coordinate
has a learning rate of its own, and the L1 term leaves most weights at exactly zero, so
the model is a short list of coordinates and weights, at most `2 ** BITS` long, which is
sent to the tasks that score.

Training takes labelled rows of the training folds only, at most about `SAMPLE` of them,
drawn by a hash of the id. They are dealt to `SHARDS` tasks, each runs `EPOCHS` rounds of
the method on its share, and the weights are averaged. Scoring is a narrow projection
over all whole texts.

Rows: null and empty texts score by the bias alone. Repeated rows score alike; a document
with several labels counts as toxic if one says so. Labels without a document or a value
are left out. Without any label to learn from, every score is 0. Rows without an id are
scored and count as not held out.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codonmill.llm import chunks

BITS = 20
SAMPLE = 24_000
SHARDS = 4
EPOCHS = 5
FOLDS = 5

ALPHA, BETA, L1, L2 = 2.0, 1.0, 6.0, 0.1

_WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_SKIP = np.uint64(0x5851F42D4C957F2D)


def features(text: bytes, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of a text in ascending order and their damped numbers."""
    hashes = chunks.word_hashes(_WORD.findall(text.lower()))
    skips = chunks.mixed(hashes[:-2] * _SKIP + hashes[2:])
    every = np.concatenate([hashes, chunks.run_hashes(hashes, 2), skips])
    found, counts = np.unique(every >> np.uint64(64 - bits), return_counts=True)
    return found.astype(np.int64) + 1, np.log1p(counts)  # coordinate 0 is the bias


class Ftrl:
    """State and updates of the method, one pair of sums per coordinate."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.full(len(z), L1)
        if not isinstance(at, slice) and len(at) and at[0] == 0 or isinstance(at, slice):
            l1[0] = 0.0  # the bias is not pulled to zero
        return np.where(
            np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        )

    def learn(self, at: np.ndarray, value: np.ndarray, label: float) -> None:
        weight = self.weights(at)
        gradient = (sigmoid(float(weight @ value)) - label) * value
        n = self.n[at]
        grown = n + gradient * gradient
        self.z[at] += gradient - (np.sqrt(grown) - np.sqrt(n)) / ALPHA * weight
        self.n[at] = grown


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic"
) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates with a weight, ascending, and their weights."""
    usable = (
        labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(doc_id))
        .groupBy(F.col(doc_id).alias("doc_id"))
        .agg(F.max(label).cast("double").alias("label"))
    )
    n_labels = max(1, usable.count())
    drawn = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(n_labels)) < SAMPLE)
    texts = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")
    )

    def coded(batches):
        for batch in batches:
            found = [features(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "label": batch["label"],
                    "at": pa.array([a.astype(np.int32).tobytes() for a, _ in found], pa.binary()),
                    "value": pa.array([v.astype(np.float32).tobytes() for _, v in found], pa.binary()),
                }
            )

    def fit(table: pa.Table) -> pa.Table:
        rows = sorted(
            zip(*(table[c].to_pylist() for c in ("doc_id", "at", "value", "label")), strict=True),
            key=lambda r: r[:3],
        )
        order = np.random.default_rng(0).permutation(len(rows))
        model = Ftrl((1 << BITS) + 1)
        for _ in range(EPOCHS):
            for i in order:
                _, at, value, label_ = rows[i]
                at = np.insert(np.frombuffer(at, np.int32), 0, 0)
                model.learn(at, np.insert(np.frombuffer(value, np.float32), 0, 1.0).astype(float), label_)
        weights = model.weights()
        used = np.flatnonzero(weights)
        return pa.table({"at": used, "weight": weights[used]})

    shares = (
        texts.join(drawn, "doc_id")
        .mapInArrow(coded, "doc_id long, label double, at binary, value binary")
        .withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "doc_id"), F.lit(SHARDS)))
        .groupBy("shard")
        .applyInArrow(fit, "at long, weight double")
    )
    # At most one row per coordinate.
    mean = shares.groupBy("at").agg((F.sum("weight") / SHARDS).alias("weight")).orderBy("at").collect()
    return np.array([r["at"] for r in mean], np.int64), np.array([r["weight"] for r in mean], float)


def score_documents(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic"
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs`."""
    used, weights = train(docs, labels, doc_id, text, label)
    model = docs.sparkSession.sparkContext.broadcast((used, weights))

    def score(batches):
        own = np.zeros((1 << BITS) + 1)
        used_, weights_ = model.value
        own[used_] = weights_
        for batch in batches:
            scores = []
            for text_ in batch["text"].to_pylist():
                at, value = features(text_)
                scores.append(sigmoid(own[0] + float(own[at] @ value)) if len(used_) else 0.0)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": pa.array(scores, pa.float64())}
            )

    given = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        held_out(doc_id).alias("held_out"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    return given.mapInArrow(score, "doc_id long, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
