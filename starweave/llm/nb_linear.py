"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct hashed byte n-grams of a text (A-Z in lower case). From labelled
texts come the naive Bayes ratio r of each feature (Wang and Manning, 2012); the ``FEATURES``
with the most weight of evidence are kept, and logistic regression is fitted on present(f) * r(f).
Its product with r is one weight per feature, so scoring is a sum over the n-grams of the whole text.

The fit sees at most ``PER_CLASS`` labelled texts of each class, those whose ids hash lowest; what the
driver collects is two counts per hash bin and, per text, one bit for each kept feature. The
intercept is moved from the sample's balance to that of all labelled rows.

Defined results: null and empty texts have no n-grams, their score is that of the intercept.
Rows without a label (or a null one) teach nothing; without any label of one class every score is
the share of the other. Rows that repeat an id are scored each. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep, small_batches
from .hashing import _LOWER, text_bytes

GRAMS = (3, 4, 5)
BIN_BITS = 18
FEATURES = 8192
PER_CLASS = 3000
SMOOTH = 1.0
_BINS = 1 << BIN_BITS


class Grams:
    """Distinct n-gram bins of one text after another."""

    def __init__(self):
        self.last = np.zeros(_BINS, np.int32)

    def of(self, data: np.ndarray) -> np.ndarray:
        byte = _LOWER[data].astype(np.uint32) + np.uint32(1)
        value, bins = np.zeros(len(byte), np.uint32), []
        for n in range(1, max(GRAMS) + 1):
            value = value[: len(byte) - n + 1] * np.uint32(0x01000193) + byte[n - 1 :] if len(byte) >= n else value[:0]
            if n in GRAMS:
                mixed = (value ^ (value >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * n)
                bins.append((mixed >> np.uint32(32 - BIN_BITS)).astype(np.int32))
        bins = np.concatenate(bins)
        place = np.arange(len(bins), dtype=np.int32)
        self.last[bins] = place
        return bins[self.last[bins] == place]


@dataclass
class Model:
    weights: np.ndarray  # one per bin
    intercept: float

    def score(self, bins: np.ndarray) -> float:
        total = float(self.weights[bins].sum(dtype=np.float64)) + self.intercept
        return float(1 / (1 + np.exp(-np.clip(total, -50, 50))))


def _texts(column: pa.Array) -> Iterator[np.ndarray]:
    data, offsets = text_bytes(column)
    for a, b in zip(offsets[:-1], offsets[1:]):
        yield data[a:b]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0 or 1)."""
    labels = labels.select("doc_id", F.col("label").cast("int").alias("label")).where("label in (0, 1)").dropDuplicates(["doc_id"])
    count = {row.label: row["count"] for row in labels.groupBy("label").count().collect()}
    if not count.get(0) or not count.get(1):
        share = np.clip(count.get(1, 0) / max(sum(count.values()), 1), 1e-6, 1 - 1e-6) if count else 0.5
        return Model(np.zeros(_BINS, np.float32), float(np.log(share / (1 - share))))
    drawn = [labels.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(PER_CLASS) for y in (0, 1)]
    # at most 2 * PER_CLASS rows of two numbers
    drawn = labels.sparkSession.createDataFrame([tuple(r) for d in drawn for r in d.collect()], "doc_id long, label int")
    sample = keep(docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("label", "text"), "sample").coalesce(6)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, seen = Grams(), np.zeros((2, _BINS), np.int32)
        texts = np.zeros(2, np.int64)
        for batch in batches:
            for label, data in zip(batch.column(0).to_pylist(), _texts(batch.column(1))):
                seen[label][grams.of(data)] += 1
                texts[label] += 1
        yield pa.RecordBatch.from_pylist([{"clean": int(texts[0]), "bad": int(texts[1]), "seen": seen.tobytes()}])

    parts = sample.mapInArrow(counted, "clean long, bad long, seen binary").collect()
    seen = sum(np.frombuffer(p.seen, np.int32).reshape(2, _BINS).astype(np.int64) for p in parts)
    texts = np.array([sum(p.clean for p in parts), sum(p.bad for p in parts)])
    share = (seen + SMOOTH) / (texts[:, None] + 2 * SMOOTH)
    ratio = np.log(share[1] / share[0])
    evidence = np.abs(ratio) * np.sqrt(seen.sum(axis=0)) * (seen.sum(axis=0) >= 3)
    chosen = np.sort(np.argsort(-evidence, kind="stable")[:FEATURES])
    place = np.full(_BINS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in batches:
            bits = []
            for data in _texts(batch.column(1)):
                row, at = np.zeros(len(chosen), np.uint8), place[grams.of(data)]
                row[at[at >= 0]] = 1
                bits.append(np.packbits(row).tobytes())
            yield pa.RecordBatch.from_pydict({"label": batch.column(0), "bits": pa.array(bits, pa.binary())})

    rows = sample.mapInArrow(marked, "label int, bits binary").collect()
    weights, intercept = _logistic(
        [np.flatnonzero(np.unpackbits(np.frombuffer(r.bits, np.uint8), count=len(chosen))) for r in rows],
        np.array([r.label for r in rows], np.float64),
        ratio[chosen],
    )
    folded = np.zeros(_BINS, np.float32)
    folded[chosen] = weights * ratio[chosen]
    intercept += np.log(count[1] / count[0]) - np.log(texts[1] / texts[0])
    return Model(folded, float(intercept))


def _logistic(present: list[np.ndarray], label: np.ndarray, scale: np.ndarray, rounds: int = 300, decay: float = 1e-4):
    """Weights and intercept of L2-regularised logistic regression, by full-batch Adam."""
    row = np.repeat(np.arange(len(present)), [len(p) for p in present])
    feature = np.concatenate(present)
    n, f = len(present), len(scale)
    w, first, second = np.zeros(f + 1), np.zeros(f + 1), np.zeros(f + 1)
    for step in range(1, rounds + 1):
        total = np.bincount(row, (w[:-1] * scale)[feature], n) + w[-1]
        error = (1 / (1 + np.exp(-np.clip(total, -50, 50))) - label) / n
        slope = np.append(np.bincount(feature, error[row], f) * scale + decay * w[:-1], error.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        w -= 0.02 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return w[:-1], w[-1]


def score(docs: DataFrame, model: Model, more: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *more, score) for every row of ``docs`` (doc_id, text)."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast((model.weights, model.intercept))  # one float per bin
    schema = docs.select("doc_id", *more).schema

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, own = Grams(), Model(*held.value)
        for batch in batches:
            scores = pa.array([own.score(grams.of(data)) for data in _texts(batch.column(batch.num_columns - 1))])
            kept = [batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, scores], [*schema.names, "score"])

    out = T.StructType([*schema.fields, T.StructField("score", T.DoubleType())])
    return docs.select("doc_id", *more, F.col("text").cast("string").alias("_scored")).mapInArrow(emit, out)


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels that may be learnt from: the rest are held out to measure accuracy."""
    return labels.where(~held_out()).select("doc_id", F.col("toxic").alias("label"))
