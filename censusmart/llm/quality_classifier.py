"""Quality by compression: which of two Zstandard dictionaries, of good or of bad text, helps a document more.

A text is cut into pieces of ``PIECE`` bytes, and each piece is compressed with either dictionary, so that
the dictionaries matter as much at the end of a long text as at its beginning. The difference of the two total sizes over their
sum, and the size of the text compressed with the good dictionary over its length, go through a logistic curve fitted on labelled
rows that the dictionaries have not seen.

Training takes a bounded sample of labelled rows (``TRAIN_ROWS``, of a text over ``TRAIN_BYTES`` evenly spaced pieces of that many
bytes, of each class at most ``CLASS_BYTES`` for its dictionary) in one task. Scores are of whole texts of any length. Defined cases: a null or empty text has difference 0 and ratio 0 and gets the curve's value there; without labelled rows of both classes
every score is the share of label 1, 0.5 without any; repeated rows score alike; an empty table gives no rows.
Columns other than id and text are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censusmart.llm.labelled import held_out, training_sample

PIECE = 2048
DICTIONARY_BYTES = 48 << 10
CLASS_BYTES = 4 << 20
TRAIN_ROWS = 10_000
TRAIN_BYTES = 32 << 10
LEVEL = 1
STEPS = 60


def pieces(text: bytes) -> list[bytes]:
    return [text[i:i + PIECE] for i in range(0, len(text), PIECE)]


def spread(text: bytes) -> bytes:
    """The text, or pieces spread evenly over it that make up ``TRAIN_BYTES`` at most."""
    parts = pieces(text)
    most = TRAIN_BYTES // PIECE
    return text if len(parts) <= most else b"".join(parts[i * len(parts) // most] for i in range(most))


def dictionary(texts: list[bytes]) -> bytes:
    """A dictionary trained on pieces spread over the texts; raw text where there are too few."""
    parts = [p for t in texts for p in pieces(t)]
    step = -(-sum(map(len, parts)) // CLASS_BYTES) or 1
    parts = parts[::step]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-DICTIONARY_BYTES:]


def _packer(content: bytes):
    data = zstandard.ZstdCompressionDict(content) if content else None
    if data:
        data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False, write_checksum=False).compress


class Model:
    """Two dictionaries and a curve."""

    def __init__(self, good: bytes, bad: bytes, curve: tuple[float, float, float]):
        self.good, self.bad, self.curve = good, bad, curve
        self.packers = None

    def features(self, text: bytes) -> tuple[float, float]:
        """(difference of the sizes over their sum, good size over the length)."""
        if self.packers is None:
            self.packers = _packer(self.good), _packer(self.bad)
        if not text:
            return 0.0, 0.0
        good, bad = (sum(len(pack(p)) for p in pieces(text)) for pack in self.packers)
        return (bad - good) / (bad + good), good / len(text)

    def score(self, text: bytes) -> float:
        x, r = self.features(text)
        a, b, c = self.curve
        return float(1 / (1 + np.exp(-np.clip(a * x + b * r + c, -30, 30))))


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps with a slight ridge, on columns of unit spread."""
    spread = x.std(axis=0) + 1e-9
    rows = np.column_stack([x / spread, np.ones(len(x))])
    w = np.zeros(3)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        slope = rows.T @ (p - y) + 0.05 * w * (1, 1, 0)
        curvature = (rows * (p * (1 - p))[:, None]).T @ rows + 0.05 * np.eye(3)
        move = np.linalg.solve(curvature, slope)
        w -= np.clip(move, -2, 2)
    return float(w[0] / spread[0]), float(w[1] / spread[1]), float(w[2])


def fit(rows: list[tuple[int, bytes]]) -> Model:
    """A model of (label, text): every other row of a class for its dictionary, the rest for the curve."""
    good, bad = ([t for y, t in rows if y == label] for label in (1, 0))
    if not good or not bad:
        share = 0.5 if not rows else min(max(len(good) / len(rows), 1e-6), 1 - 1e-6)
        return Model(b"", b"", (0.0, 0.0, float(np.log(share / (1 - share)))))
    model = Model(dictionary(good[::2]), dictionary(bad[::2]), (0.0, 0.0, 0.0))
    seen = [(1, t) for t in good[1::2] or good] + [(0, t) for t in bad[1::2] or bad]
    x = np.array([model.features(t) for _, t in seen])
    model.curve = fit_curve(x, np.array([y for y, _ in seen], float))
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS, **columns) -> Model:
    """The model of a bounded sample, fitted in one task; two dictionaries of 48 KB and three numbers reach the driver."""
    sample = training_sample(docs, labels, label, rows, lambda: lambda text: spread(text.encode("utf-8", "replace")), **columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = fit([(y.as_py(), t.as_py()) for batch in batches for y, t in zip(*batch.columns)])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((model.good, model.bad, model.curve))], pa.binary())], names=["model"])

    row = sample.mapInArrow(run, "model binary").first()
    return Model(*pickle.loads(row["model"])) if row else fit([])


def score_documents(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    chosen = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    parts = model.good, model.bad, model.curve

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*parts)
        for batch in batches:
            scores = pa.array([own.score(t.as_py()) for t in batch.column(2)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), scores], names=["doc_id", "held_out", "score"])

    scored = chosen.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
