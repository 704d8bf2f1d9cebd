"""Quality scores: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Features are word n-grams hashed into ``2 ** BITS`` buckets: words and runs of punctuation, lower-cased, their
pairs, and two marker words, one for a word in capitals and one for a word said again. A bucket's value grows with
the logarithm of its count, and a text's values have length one, so long and short texts compare.

The model is fitted in one task on a bounded sample (``ROWS`` labelled ids) and is ``2 ** BITS`` numbers whatever
the input. Scoring is a projection over whole texts with the broadcast weights; nothing is shuffled.

Null and empty texts have no features and get the intercept's score. Repeated rows get equal scores, an empty table no
rows. Without any labelled row every score is 0.5.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import per_batch, utf8

BITS = 18
ROWS = 6000  # labelled ids the model is fitted on, at most
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
CAPITALS, AGAIN = 1, 2  # buckets of the marker words; the intercept has bucket 0

WORD = re.compile(rb"[A-Za-z0-9_\x80-\xff]+|[^\sA-Za-z0-9_\x80-\xff]+")


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets in ascending order and their values."""
    words = WORD.findall(text)
    if not words:
        return np.array([0]), np.array([1.0])
    crc = zlib.crc32
    hashes = np.fromiter((crc(word.lower()) for word in words), np.uint64, len(words))
    again = int((hashes[1:] == hashes[:-1]).sum())
    capitals = sum(len(word) > 1 and word.isupper() for word in words)
    pairs = (hashes[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (hashes[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = np.concatenate([hashes * np.uint64(0x9E3779B97F4A7C15), pairs])
    buckets, counts = np.unique(mixed >> np.uint64(64 - BITS), return_counts=True)
    buckets = np.concatenate([[0, CAPITALS, AGAIN], buckets.astype(np.int64) + 3])
    values = np.log1p(np.concatenate([[0, capitals, again], counts]))
    norm = np.sqrt((values * values).sum())
    values /= norm
    values[0] = 1.0
    return buckets, values


def fit(examples: list[tuple[np.ndarray, np.ndarray, int]]) -> np.ndarray:
    """Weights by bucket. Each example moves only the coordinates it has."""
    size = (1 << BITS) + 3
    z, n = np.zeros(size), np.zeros(size)

    def weights(z, n):
        return -np.sign(z) * np.maximum(np.abs(z) - L1, 0.0) / ((BETA + np.sqrt(n)) / ALPHA + L2)

    for _ in range(EPOCHS):
        for at, x, label in examples:
            w = weights(z[at], n[at])
            slope = (1.0 / (1.0 + np.exp(-np.clip(w @ x, -30, 30))) - label) * x
            seen = n[at] + slope * slope
            z[at] += slope - (np.sqrt(seen) - np.sqrt(n[at])) / ALPHA * w
            n[at] = seen
    return weights(z, n)


def train(sample: DataFrame) -> np.ndarray:
    """Weights from rows (key, text, label), which the caller has bounded: one task takes them all."""
    def run(batches):
        rows = []
        for batch in batches:
            keys, labels = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            rows += [(str(key), *features(text), label) for key, text, label in zip(keys, utf8(batch.column(1)), labels, strict=True)]
        rows.sort(key=lambda row: (zlib.crc32(row[0].encode()), row[0], len(row[1])))
        fitted = fit([row[1:] for row in rows])
        yield pa.RecordBatch.from_arrays([pa.array([fitted.astype(np.float64).tobytes()], pa.binary())], ["weights"])

    packed = sample.select("key", "text", "label").repartition(1).mapInArrow(run, "weights binary").first()
    return np.frombuffer(packed.weights, np.float64) if packed else np.zeros((1 << BITS) + 3)


def score(docs: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """(row, score): each row without its text as one struct, and the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    rest = [F.col(f"`{name}`") for name in docs.columns if name != text]
    frame = docs.select(F.struct(*rest).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([frame.schema["row"], T.StructField("score", T.DoubleType())])

    def make():
        model = shared.value

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            margins = np.array([model[at] @ x for at, x in map(features, utf8(batch.column(1)))])
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(1.0 / (1.0 + np.exp(-margins)))], ["row", "score"])

        return each

    return per_batch(frame, schema, make)
