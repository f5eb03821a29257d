"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are words, pairs of neighbours and pairs with one word between, hashed into 2**20 places; a feature counts once
per text. Training is some passes over a bounded sample of labelled rows (``TRAIN_ROWS``, of each text at most ``TRAIN_PLACES`` of its different
places, which tasks compute) in one task, the rarer label weighted by the root of its rarity; the L1 term leaves few weights other than zero, which are the whole model that travels to the tasks. Every document is scored over its whole text.

Defined cases: a null or empty text has no feature and scores by the bias alone; without labelled rows every
score is the bias's 0.5; very long texts are scored whole; repeated rows score alike; an empty table gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censusmart.llm.labelled import held_out, training_sample

BITS = 20
TRAIN_ROWS = 12_000
TRAIN_PLACES = 8192
PASSES = 6
ALPHA, BETA, L1, L2 = 2.0, 1.0, 4.0, 0.0
KNOWN_WORDS = 500_000
_STRIP = b".,;:!?\"'()[]{}<>#*$%&|"
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class Features:
    """Places of a text's features; remembers the hashes of words, a bounded number of them."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").lower().encode("utf-8", "replace").split()
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        known = self.known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w.strip(_STRIP))
        one = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        grams = [one * _MIX[0], one[:-1] * _MIX[1] + one[1:] * _MIX[2], one[:-2] * _MIX[3] + one[2:] * _MIX[4]]
        mixed = np.concatenate(grams)
        return ((mixed ^ mixed >> np.uint64(29)) * _MIX[0] >> np.uint64(64 - BITS)).astype(np.int64)


def learned_places(places: np.ndarray) -> np.ndarray:
    """The different places of a training text, ``TRAIN_PLACES`` evenly spread ones of them if there are more."""
    different = np.unique(places).astype(np.int32)
    if len(different) <= TRAIN_PLACES:
        return different
    return different[np.arange(TRAIN_PLACES) * len(different) // TRAIN_PLACES]


class Ftrl:
    """Weights with a learning rate per coordinate; the last place is the bias."""

    def __init__(self):
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(np.asarray(at) == 1 << BITS, 0.0, L1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, places: np.ndarray, label: int, weight: float = 1.0) -> None:
        """One step for a text with these different places."""
        at = np.append(places, 1 << BITS)
        w = self.weights(at)
        g = weight * (1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label)
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g

    def sparse(self) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.z)
        w = self.weights(at)
        return at[w != 0], w[w != 0]


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS, **columns) -> dict[int, float]:
    """Weights by place, zeros left out; at most 2**20 + 1 of them, in practice some thousands."""
    def reduced():
        features = Features()
        return lambda text: learned_places(features(text)).tobytes()

    sample = training_sample(docs, labels, label, rows, reduced, **columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Ftrl()
        held = [(np.frombuffer(places.as_py(), np.int32), int(y.as_py() > 0)) for batch in batches for y, places in zip(*batch.columns)]
        share = sum(y for _, y in held) / max(1, len(held))
        weight = {1: 1.0, 0: 1.0} if share in (0.0, 1.0) else {1: max(1.0, 1 / share - 1) ** 0.5, 0: max(1.0, share / (1 - share)) ** 0.5}
        for _ in range(PASSES):
            for places, y in held:
                model.learn(places, y, weight[y])
        at, w = model.sparse()
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(w, pa.float64())], names=["place", "weight"])

    return {r["place"]: r["weight"] for r in sample.mapInArrow(run, "place long, weight double").collect()}


def score_documents(docs: DataFrame, model: dict[int, float], doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    chosen = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        weights = np.zeros((1 << BITS) + 1, np.float32)
        weights[list(shared.value)] = list(shared.value.values())
        bias, weighs = float(weights[-1]), weights != 0
        for batch in batches:
            scores = []
            for t in batch.column(2):
                places = features(t.as_py())
                places = np.unique(places[weighs[places]])
                scores.append(float(1 / (1 + np.exp(-np.clip(bias + weights[places].sum(dtype=np.float64), -30, 30)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "score"])

    scored = chosen.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
